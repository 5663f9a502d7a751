"""WARC archives with a two-level capture index.

Writing: every task writes gzip-per-record archives to the shared folder and
returns a capture row (key, file, offset, length) per record.  Index: capture
lines sorted by reversed-host key are packed into compressed blocks, and each
index shard gets a sparse directory with the first and last key of every
block.  Lookup: a key is binary-searched among the shards' ranges, then in one
shard's directory, and only the blocks found are read, by byte range; records
are then read by byte range too.

File names carry a random part, and only what a successful task returned is
referenced, so a retried task leaves at most an unused file behind.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, partitions, read_table, scratch, ship_by_value, written
from tessera.llm.urlfilter import host_of

ship_by_value(__name__)

#: Payloads of at least so many bytes are stored once.
MIN_DEDUP_BYTES = 0
BLOCK_LINES = 1000
ARCHIVE_BYTES = 256 << 20
DATE = "1970-01-01T00:00:00Z"
# Fixed values of the format.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

CAPTURE = "key string, page_id long, file string, offset long, length long, record_type string, payload_digest string, payload_bytes long, refers_to long"
RECORD = "key string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
DIRECTORY = "shard string, block int, first_key string, last_key string, lines int"
BLOCK = "wanted string, file string, offset long, length long"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of bytes or text: 5 hex digits make 4 letters."""
    digits = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _CONV32, _BASE32)


def url_key(url: Column) -> Column:
    """The URL with its host's labels reversed: ``com,example,www)/path?query``; empty for a null URL."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:.*?://[^/?#]*)?(.*)$", 1)
    return F.when(url.isNull(), "").otherwise(F.concat(F.array_join(F.reverse(F.split(host_of(url), r"\.")), ","), F.lit(")"), rest))


def _file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _whole(value) -> int | None:
    return None if value is None or pd.isna(value) else int(value)


def target_uri(url: str) -> str:
    """A URL as archived: characters that no URI may hold, and line ends, are percent-encoded."""
    return quote(url, safe=":/?#[]@!$&()*+,;=%'~")


def _record(row) -> bytes:
    """One uncompressed WARC record."""
    refers = _whole(row.refers_to)
    kind = "response" if refers is None else "revisit"
    body = row.payload if kind == "response" else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row.payload_bytes}\r\n\r\n".encode()
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if _whole(row.page_id) is None else _whole(row.page_id)}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{row.payload_digest}"]
    if row.url is not None:
        head.append(f"WARC-Target-URI: {target_uri(row.url)}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {_PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(http) + len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def _write_archives(root: str, most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _file_system(root)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                rows = []
                for row in batch.itertuples(index=False):
                    if out is None or at >= most:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = files.open_output_stream(f"{folder}/{name}", compression=None)
                    member = _gzip(_record(row))
                    out.write(member)
                    refers = _whole(row.refers_to)
                    rows.append((row.key, _whole(row.page_id), name, at, len(member), "response" if refers is None else "revisit",
                                 row.payload_digest, row.payload_bytes, refers))
                    at += len(member)
                yield _frame(rows, CAPTURE)
        finally:
            if out is not None:
                out.close()

    return run


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    frame = pd.DataFrame(rows, columns=names, dtype=object)
    for c in schema.split(", "):
        if c.split()[1] in ("long", "int"):
            frame[c.split()[0]] = frame[c.split()[0]].astype("Int64")
    return frame


def _make_folder(spark: SparkSession, path: str) -> None:
    """Through Spark's own file system, so any store that Spark writes to will do."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)


def write_warc(pages: DataFrame, root: str, min_dedup_bytes: int = MIN_DEDUP_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record per page under ``root/archive``; returns the written capture table.

    Of equal payloads of at least ``min_dedup_bytes`` the page with the
    smallest id is a response and the others are revisits of it.  Null html:
    empty payload.  Repeated rows with the smallest id are each a response;
    so are rows without an id if none of their payload's pages has one.
    """
    spark = pages.sparkSession
    _make_folder(spark, f"{root}/archive")
    payload = F.coalesce(F.col("html"), F.lit(""))
    digest = base32_sha1(payload)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", url_key(F.col("url")).alias("key"),
                        payload.cast("binary").alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
                        digest.alias("payload_digest"))
    # written before it joins, so that Spark can split the join's hot payloads
    repeated = written(pages.select(F.col("page_id").cast("long").alias("page_id"), digest.alias("payload_digest"),
                                    F.octet_length(payload).alias("n")).filter(F.col("n") >= min_dedup_bytes)
                       .groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
                       .filter("copies > 1").select("payload_digest", "first_id"), "repeated")
    told = (rows.join(repeated, "payload_digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
            .select("key", "page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"))
    return written(told.mapInPandas(_write_archives(f"{root}/archive", archive_bytes), CAPTURE), "captures")


def _line(row) -> str:
    return row.key + "\t" + json.dumps([_whole(row.page_id), row.file, int(row.offset), int(row.length)])


def _escaped(key: Column) -> Column:
    """A key without line ends and tabs, which separate lines and fields."""
    return F.replace(F.replace(F.replace(F.replace(key, F.lit("%"), F.lit("%25")), F.lit("\t"), F.lit("%09")), F.lit("\n"), F.lit("%0A")), F.lit("\r"), F.lit("%0D"))


def _write_index(root: str, block_lines: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _file_system(root)
        shard, out, directory, lines, at = uuid.uuid4().hex, None, [], [], 0

        def flush() -> None:
            nonlocal out, at, lines
            if out is None:
                out = files.open_output_stream(f"{folder}/{shard}.cdx.gz", compression=None)
            block = _gzip("\n".join(lines).encode())
            out.write(block)
            directory.append((lines[0].partition("\t")[0], lines[-1].partition("\t")[0], at, len(block), len(lines)))
            at, lines = at + len(block), []

        for batch in batches:
            for row in batch.itertuples(index=False):
                lines.append(_line(row))
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with files.open_output_stream(f"{folder}/{shard}.dir", compression=None) as f:
                f.write(json.dumps(directory).encode())
        yield _frame([(shard, i, d[0], d[1], d[4]) for i, d in enumerate(directory)], DIRECTORY)

    return run


def write_index(captures: DataFrame, root: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the two-level index of the captures under ``root/index``; returns (shard, first_key, last_key), one row a shard."""
    spark = captures.sparkSession
    _make_folder(spark, f"{root}/index")
    # captures of one key may fill many shards: the range also goes by place
    lines = (captures.select(_escaped(F.col("key")).alias("key"), "page_id", "file", "offset", "length")
             .repartitionByRange(partitions(spark), "key", "file", "offset").sortWithinPartitions("key", "file", "offset"))
    blocks = written(lines.mapInPandas(_write_index(f"{root}/index", block_lines), DIRECTORY), "directory")
    return blocks.groupBy("shard").agg(F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))


def _find_blocks(root: str, shards):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _file_system(root)
        bounds = shards.value
        ends, starts = [x[2].encode() for x in bounds], [x[1].encode() for x in bounds]
        held: dict[str, tuple] = {}

        def directory(shard: str) -> tuple:
            if shard not in held:
                if len(held) > 3:  # keys come sorted, so an earlier directory isn't needed again
                    held.clear()
                with files.open_input_file(f"{folder}/{shard}.dir") as f:
                    entries = json.loads(f.read())
                held[shard] = entries, [e[0].encode() for e in entries], [e[1].encode() for e in entries]
            return held[shard]

        for batch in batches:
            rows = []
            for key in batch["key"]:
                wanted = key.encode()
                for shard, _, _ in bounds[bisect_left(ends, wanted):bisect_right(starts, wanted)]:
                    entries, first, last = directory(shard)
                    for e in entries[bisect_left(last, wanted):bisect_right(first, wanted)]:
                        rows.append((key, f"{shard}.cdx.gz", e[2], e[3]))
            yield _frame(rows, BLOCK)

    return run


def _read_blocks(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _file_system(root)
        place, lines, keys = None, [], []
        for batch in batches:
            rows = []
            for wanted, file, offset, length in batch.itertuples(index=False):
                if place != (file, offset):
                    with files.open_input_file(f"{folder}/{file}") as f:
                        lines = zlib.decompress(f.read_at(length, offset), 31).decode().split("\n")
                    place, keys = (file, offset), [x.partition("\t")[0].encode() for x in lines]
                key = wanted.encode()
                for line in lines[bisect_left(keys, key):bisect_right(keys, key)]:
                    rows.append((wanted, *json.loads(line.partition("\t")[2])))
            yield _frame(rows, "key string, page_id long, file string, offset long, length long")

    return run


def _find_in_shards(root: str):
    """Blocks for (key, shard) rows that come by shard."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _file_system(root)
        held, entries, first, last = None, [], [], []
        for batch in batches:
            rows = []
            for key, shard in batch[["key", "shard"]].itertuples(index=False):
                if held != shard:
                    with files.open_input_file(f"{folder}/{shard}.dir") as f:
                        entries = json.loads(f.read())
                    held, first, last = shard, [e[0].encode() for e in entries], [e[1].encode() for e in entries]
                wanted = key.encode()
                for e in entries[bisect_left(last, wanted):bisect_right(first, wanted)]:
                    rows.append((key, f"{shard}.cdx.gz", e[2], e[3]))
            yield _frame(rows, BLOCK)

    return run


def _route(bounds):
    """The stretches (number, first key, last key) of shards that may hold a key, for keys."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = bounds.value
        ends, starts = [x[2].encode() for x in known], [x[1].encode() for x in known]
        for batch in batches:
            rows = [(key, x[0]) for key in batch["key"]
                    for x in known[bisect_left(ends, key.encode()):bisect_right(starts, key.encode())]]
            yield _frame(rows, "key string, stretch long")

    return run


def _many_shards(wanted: DataFrame, ranges: DataFrame, count: int, root: str) -> DataFrame:
    """Blocks of keys where the shard table is too large for one task: the sorted table is cut into stretches of
    so many shards that the stretches are few; keys go to stretches, and join the shards of theirs."""
    spark, n = wanted.sparkSession, partitions(wanted.sparkSession)
    size = -(-count // max(1, BROADCAST_ROWS))
    line = (ranges.select("shard", "first_key", "last_key").repartitionByRange(n, "first_key", "last_key", "shard")
            .sortWithinPartitions("first_key", "last_key", "shard").withColumn("at", F.monotonically_increasing_id()))
    # within a partition consecutive numbers; a stretch never spans two partitions
    line = written(line.withColumn("stretch", F.shiftright("at", 33) * F.lit(1 << 33) + F.floor(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) / size)),
                   "stretches")
    bounds = [(r.stretch, r.a, r.b) for r in line.groupBy("stretch").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b")).collect()]
    bounds.sort(key=lambda r: (r[1].encode(), r[2].encode()))
    routed = written(wanted.mapInPandas(_route(spark.sparkContext.broadcast(bounds)), "key string, stretch long"), "routed")
    met = (routed.join(line, "stretch").filter((F.col("first_key") <= F.col("key")) & (F.col("key") <= F.col("last_key")))
           .select("key", "shard").repartitionByRange(n, "shard", "key").sortWithinPartitions("shard", "key"))
    return met.mapInPandas(_find_in_shards(f"{root}/index"), BLOCK)


def lookup(keys: DataFrame, shards: DataFrame, root: str) -> DataFrame:
    """(key, page_id, file, offset, length) of every capture of the distinct ``key`` values, found through the index."""
    spark = keys.sparkSession
    ranges = shards.filter("first_key is not null")
    n, count = partitions(spark), ranges.count()
    wanted = (keys.select(_escaped(F.col("key")).alias("key")).distinct()
              .repartitionByRange(n, "key").sortWithinPartitions("key"))
    if count > BROADCAST_ROWS:
        blocks = _many_shards(wanted, ranges, count, root)
    else:
        # sorted by UTF-8 bytes, as Spark sorts strings
        known = sorted(((r.shard, r.first_key, r.last_key) for r in ranges.collect()), key=lambda r: (r[1].encode(), r[2].encode()))
        blocks = wanted.mapInPandas(_find_blocks(f"{root}/index", spark.sparkContext.broadcast(known)), BLOCK)
    # dealt by block and key range, so that a key with many blocks is read by many tasks
    return (blocks.repartition(n, "file", "offset").sortWithinPartitions("file", "offset", "wanted")
            .mapInPandas(_read_blocks(f"{root}/index"), "key string, page_id long, file string, offset long, length long"))


def _read_records(root: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _file_system(root)
        name, source = "", None
        for batch in batches:
            rows = []
            for key, file, offset, length in batch[["key", "file", "offset", "length"]].itertuples(index=False):
                if name != file:
                    if source is not None:
                        source.close()
                    name, source = file, files.open_input_file(f"{folder}/{file}")
                rows.append((key, *_parsed(zlib.decompress(source.read_at(length, offset), 31))))
            yield _frame(rows, RECORD)
        if source is not None:
            source.close()

    return run


def _parsed(record: bytes) -> tuple:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload); a response's digest is computed anew."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, body = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    page = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
    url = fields.get("WARC-Target-URI")
    if fields["WARC-Type"] == "response":
        size, digest, refers, payload = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), None, body
        if digest != fields["WARC-Payload-Digest"].removeprefix("sha1:"):
            raise ValueError(f"the payload of page {page} doesn't have the digest of its record")
    else:
        size = int(http.decode().rpartition("Content-Length: ")[2])
        digest, payload = fields["WARC-Payload-Digest"].removeprefix("sha1:"), None
        refers = int(fields["WARC-Refers-To"].removeprefix("<urn:page:").removesuffix(">"))
    return int(page) if page else None, url, fields["WARC-Type"], size, digest, refers, payload


def read_records(captures: DataFrame, root: str) -> DataFrame:
    """The records at (file, offset, length), read by byte range; a revisit's payload is null."""
    n = partitions(captures.sparkSession)
    return (captures.select("key", "file", "offset", "length").repartition(n, "file", F.floor(F.col("offset") / (8 << 20)))
            .sortWithinPartitions("file", "offset").mapInPandas(_read_records(f"{root}/archive"), RECORD))


def archive_and_read(pages: DataFrame, min_dedup_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """Write all pages as WARC with index, look every URL key up and read its records back.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to,
    url, key), the URL as archived.  Null url: key is empty, no target URI.  Null html: empty
    payload.  Empty table: empty result.  Other columns are not read.
    """
    spark = pages.sparkSession
    root = scratch(spark, "warc")
    captures = write_warc(pages, root, min_dedup_bytes)
    shards = written(write_index(captures, root), "shards")
    found = lookup(pages.select(url_key(F.col("url")).alias("key")), shards, root)
    return read_records(found, root).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "key")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_and_read(read_table(spark, sf_dir, "pages")).drop("url", "key")


def _sql() -> str:
    value = lambda i: f"('0x' || substr(sha, {5 * i + 1}, 5))::BIGINT"
    letters = " || ".join(f"substr('{_BASE32}', ({value(i)} // {32 ** k}) % 32 + 1, 1)" for i in range(8) for k in (3, 2, 1, 0))
    return f"""
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
told AS (SELECT page_id, payload_bytes, {letters} AS payload_digest, min(page_id) OVER (PARTITION BY sha) AS first_id FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM told
"""


SQL = _sql()
