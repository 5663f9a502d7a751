"""Token ids packed into fixed-width matrices by best-fit decreasing.

Texts are tokenised with a given vocabulary and end with an end-of-text id.
A document longer than a row is split into pieces whose ids concatenate to the
document's, so nothing is lost.  Documents are dealt at random over packing
groups of a bounded number of bytes; within a group the pieces go, longest
first, into the row with the least room that still fits, found in a segment
tree over the rooms.
"""

from __future__ import annotations

import base64
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_slices, partitions, read_table, ship_by_value
from tessera.llm.warc import _file_system, _make_folder

ship_by_value(__name__)

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value of the vocabulary: how text is cut before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WIDTH = 2048
#: Bytes of text in a packing group; a task holds one group's ids.
GROUP_BYTES = 24 << 20
#: Below that many bytes no further group is opened for the sake of parallel work.
LEAST_GROUP_BYTES = 4 << 20
_ROWS = 2000

PIECES = "doc_id long, piece int, tokens int, ids binary"
PACKED = "pack int, row int, tokens int, doc_ids array<long>, pieces array<int>, cu_seqlens array<int>, position_resets array<int>, input_ids binary"


class Vocabulary:
    """Ranks of a byte-level vocabulary; the id after the last rank ends a text."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.data = f.read()
        self.end = len(self.data.split(b"\n")) - self.data.endswith(b"\n")
        self.kind = "<u2" if self.end < 1 << 16 else "<u4"

    def encoding(self):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.data.splitlines())}
        return tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _tokenize(shared, width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = shared.value
        encode, end, kind = vocabulary.encoding().encode_to_numpy, vocabulary.end, vocabulary.kind
        for batch in batches:
            rows = []
            for doc_id, text in batch.itertuples(index=False):
                found = encode(text or "", disallowed_special=())
                ids = np.empty(len(found) + 1, kind)
                ids[:-1], ids[-1] = found, end
                for i in range(0, len(ids), width):
                    part = ids[i:i + width]
                    rows.append((doc_id, i // width, len(part), part.tobytes()))
                if len(rows) >= _ROWS:
                    yield _pieces(rows)
                    rows = []
            yield _pieces(rows)

    return run


def _pieces(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["doc_id", "piece", "tokens", "ids"]).astype({"doc_id": "Int64"})


def tokenize(docs: DataFrame, vocabulary: str = VOCABULARY, width: int = WIDTH) -> DataFrame:
    """(doc_id, piece, tokens, ids) of every document; ids are little-endian, two bytes each if the vocabulary allows."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _tokenize(shared, width), PIECES)


def best_fit_decreasing(sizes: np.ndarray, width: int) -> list[list[int]]:
    """The pieces in each row: pieces from the longest on, each to the row with the least room that fits, else to a new row."""
    leaves = 1 << max(1, width).bit_length()
    tree = [0] * (2 * leaves)  # a node: how many open rows have a room below it
    open_rows: list[list[int]] = [[] for _ in range(width + 1)]
    rows: list[list[int]] = []

    def count(room: int, by: int) -> None:
        node = room + leaves
        while node:
            tree[node] += by
            node >>= 1

    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        node = size + leaves
        if not tree[node]:
            # up to the first right sibling with a row, then down its leftmost path
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            node = node + 1 if node > 1 else 0
            while 0 < node < leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        if node:
            room = node - leaves
            row = open_rows[room].pop()
            count(room, -1)
            rows[row].append(piece)
        else:
            room, row = width, len(rows)
            rows.append([piece])
        if room > size:
            open_rows[room - size].append(row)
            count(room - size, 1)
    return rows


def _pack(width: int, kind: str, end: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [b for b in batches if len(b)]  # a group of at most GROUP_BYTES of text, or one document
        if not frames:
            return
        group = pd.concat(frames, ignore_index=True)
        del frames
        pack, ids = int(group["pack"].iat[0]), group["ids"].to_numpy()
        doc_ids, pieces, sizes = group["doc_id"].tolist(), group["piece"].tolist(), group["tokens"].to_numpy()
        doc_ids = [None if d is None or d != d else int(d) for d in doc_ids]
        packed = best_fit_decreasing(sizes, width)
        out = []
        for row, own in enumerate(packed):
            ends = np.cumsum(sizes[own])
            bounds, used = [0, *ends.tolist()], int(ends[-1])
            line = b"".join([ids[i] for i in own]) + np.full(width - used, end, kind).tobytes()
            out.append((pack, row, used, [doc_ids[i] for i in own], [pieces[i] for i in own], bounds, bounds if used < width else bounds[:-1], line))
            if len(out) >= _ROWS:
                yield pd.DataFrame(out, columns=_NAMES)
                out = []
        yield pd.DataFrame(out, columns=_NAMES)

    return run


_NAMES = [c.split()[0] for c in PACKED.split(", ")]


def pack_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, width: int = WIDTH) -> DataFrame:
    """One row per matrix row: (pack, row, tokens, doc_ids, pieces, cu_seqlens, position_resets, input_ids).

    ``input_ids`` holds ``width`` ids; past ``tokens`` it is filled with the
    end id.  ``cu_seqlens`` are the segments' bounds from 0; positions restart
    from 0 at the columns ``position_resets``, the filling included.  ``doc_ids``
    and ``pieces`` name the segments in order.

    Null and empty texts: one end id.  Null ids stay null.  Repeated rows are
    packed each.  Empty table: empty result.  Other columns are not read.
    """
    spark = docs.sparkSession
    known = Vocabulary(vocabulary)
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES), min(partitions(spark), size // LEAST_GROUP_BYTES))
    # dealt by row, not by content: neither a source nor copies can crowd one group
    dealt = tokenize(docs, vocabulary, width).withColumn("pack", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    return dealt.repartitionById(groups, "pack").mapInPandas(_pack(width, known.kind, known.end), PACKED)


def write_matrices(packed: DataFrame, root: str, vocabulary: str = VOCABULARY, width: int = WIDTH) -> DataFrame:
    """Write .npy files under ``root``: ids and positions as matrices, segment bounds with row offsets; returns (file, rows).

    File names carry a random part; only what is returned counts.
    """
    import uuid

    _make_folder(packed.sparkSession, root)
    kind = Vocabulary(vocabulary).kind

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, folder = _file_system(root)
        for batch in batches:
            if not len(batch):
                continue
            name = uuid.uuid4().hex
            ids = np.frombuffer(b"".join(batch["input_ids"]), kind).reshape(len(batch), width)
            column = np.arange(width)
            positions = np.stack([column - np.maximum.accumulate(np.where(np.isin(column, r), column, 0)) for r in batch["position_resets"]])
            bounds = [np.asarray(x, np.int32) for x in batch["cu_seqlens"]]
            for part, array in (("ids", ids), ("positions", positions.astype(kind)), ("cu_seqlens", np.concatenate(bounds)),
                                ("offsets", np.cumsum([0, *map(len, bounds)]))):
                held = io.BytesIO()
                np.save(held, array)
                with files.open_output_stream(f"{folder}/{name}.{part}.npy", compression=None) as f:
                    f.write(held.getvalue())
            yield pd.DataFrame({"file": [name], "rows": [len(batch)]})

    return packed.select("input_ids", "position_resets", "cu_seqlens").mapInPandas(run, "file string, rows long")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(read_table(spark, sf_dir, "documents"))
