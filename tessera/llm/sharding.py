"""Shards of near equal size: minimax contiguous partition of ordered atomic groups.

Documents with equal texts form a group that is never split.  Groups lie on a
line in the order of their smallest id; a shard is a stretch of that line.
The smallest capacity for which greedy filling needs no more than the wanted
number of shards is found by search over the capacity, and the line is cut
there.  Where a single group sets the capacity, greedy filling would heap the rest into few
shards; the stretches before and after that group are then solved again for themselves.

All rows stay on Spark: the line is a table of (start, end) byte positions
made from per-partition sums, and a greedy step is a filtered maximum over it.
The driver sees only the cut positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, read_table, running_offsets, written

SHARDS = 8
#: Capacities tried in one pass over the line: each pass narrows the range by this factor plus one.
PROBES = 15
_ROW = (1 << 33) - 1


def _numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, with partition and row number within it, written."""
    sorted_ = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    at = sorted_.withColumn("at", F.monotonically_increasing_id())
    return written(at.select("*", F.shiftright("at", 33).cast("int").alias("part"),
                             F.col("at").bitwiseAND(F.lit(_ROW)).alias("row")).drop("at"), "numbered")


def group_line(items: DataFrame) -> DataFrame:
    """(digest, start, end) of every group, from items of (doc_id, size, digest)."""
    groups = items.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes"))
    placed = _numbered(groups, "first_id", "digest")
    before = running_offsets(placed.groupBy("part").agg(F.sum("bytes").alias("offset")), "part", "offset")
    within = Window.partitionBy("part").orderBy("row")
    # per-partition sums are one row per partition
    return written(placed.withColumn("upto", F.sum("bytes").over(within)).join(F.broadcast(before), "part")
                   .select("digest", (F.col("offset") + F.col("upto") - F.col("bytes")).alias("start"),
                           (F.col("offset") + F.col("upto")).alias("end")), "line")


def _greedy(line: DataFrame, capacities: list[int], shards: int, begin: int = 0) -> list[list[int]]:
    """For each capacity the cut positions that greedy filling reaches from ``begin``, all in one pass per shard."""
    cuts = [[] for _ in capacities]
    at = [begin] * len(capacities)
    for _ in range(shards):
        low, high = min(at), max(a + c for a, c in zip(at, capacities, strict=True))
        found = line.filter((F.col("end") > low) & (F.col("end") <= high)).agg(*[
            F.max(F.when(F.col("end") <= a + c, F.col("end"))).alias(f"c{i}")
            for i, (a, c) in enumerate(zip(at, capacities, strict=True))]).first()
        at = [max(a, found[i] or 0) for i, a in enumerate(at)]
        for own, a in zip(cuts, at, strict=True):
            own.append(a)
    return cuts


def smallest_capacity(line: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity with which greedy filling covers the line in ``shards`` stretches, and its cuts."""
    begin, largest, end = line.agg(F.min("start"), F.max(F.col("end") - F.col("start")), F.max("end")).first()
    total = (end or 0) - (begin or 0)
    if not total:
        return 0, [begin or 0] * shards
    # a capacity of the mean plus the largest group always suffices
    low, high = max(largest, -(-total // shards)), -(-total // shards) + largest
    best = None
    while best is None or low < high:
        step = max(1, (high - low) // PROBES)
        tried = sorted({min(high, low + i * step) for i in range(PROBES)} | ({high} if best is None else set()))
        cuts = _greedy(line, tried, shards, begin)
        fit = [i for i, c in enumerate(cuts) if c[-1] == end]
        if fit:
            high, best = tried[fit[0]], cuts[fit[0]]
            low = tried[fit[0] - 1] + 1 if fit[0] else high
        else:
            low = tried[-1] + 1
    return high, best


def balanced_cuts(line: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity and cuts that keep to it, with the other shards near equal beside a group that alone sets it.

    Such a group is a shard of its own under any cuts of that capacity; the stretches
    before and after it share the remaining shards by their bytes and are solved the same way.
    """
    capacity, cuts = smallest_capacity(line, shards)
    hot = line.filter(F.col("end") - F.col("start") == capacity).agg(F.min(F.struct("start", "end"))).first()[0]
    if hot is None or shards == 1:
        return capacity, cuts
    before, after = line.filter(F.col("end") <= hot.start), line.filter(F.col("start") >= hot.end)
    begin, end = line.agg(F.min("start"), F.max("end")).first()
    left, right = hot.start - begin, end - hot.end
    if not left + right:
        return capacity, cuts
    fair = (shards - 1) * left / (left + right)
    tries = []
    for own in sorted({int(fair), min(shards - 1, int(fair) + 1)}):
        if (left and not own) or (right and own == shards - 1):
            continue
        a, b = (balanced_cuts(before, own) if own else (0, [])), (balanced_cuts(after, shards - 1 - own) if own < shards - 1 else (0, []))
        tries.append((max(a[0], b[0]), own, [*(a[1] if left else [hot.start] * own), hot.end, *(b[1] if right else [hot.end] * (shards - 1 - own))]))
    fitting = [t for t in tries if t[0] <= capacity]
    return (capacity, min(fitting)[2]) if fitting else (capacity, cuts)


def _unsigned_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document.

    Size: UTF-8 bytes plus 1.  Law ``bytes``: the largest shard is as small as
    any contiguous partition of the groups allows, and where one group alone is that large,
    the others near equal beside it.  ``slot`` numbers a shard's
    documents from 0 in the order of group, then id.  ``grown_shard`` is null.

    Null texts: one group, size 1, CRC of no bytes.  Null ids come first.
    Rows equal in id and text keep one slot each.  Fewer groups than shards:
    the last shards stay empty.  Empty table: empty result.  Other input
    columns, whatever their names, are not read.
    """
    items = written(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        _unsigned_crc(F.col(text)).alias("text_crc32"),
        # equal digests and equal nullness: equal texts
        F.coalesce(F.sha2(text, 256), F.lit("null")).alias("digest"),
        # written once: deals rows equal in text and id, among which any order is the same
        F.monotonically_increasing_id().alias("tie")), "items")
    line = group_line(items)
    _, cuts = balanced_cuts(line, shards)
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts[:-1]]) if shards > 1 else F.array().cast("array<long>")
    shard = F.size(F.filter(bounds, lambda c: c <= F.col("start"))).cast("int")
    # a hot group's rows: the join's skew is split, and the numbering below deals by id too
    placed = _numbered(items.join(line.select("digest", "start"), "digest")
                       .select("doc_id", "size", "text_crc32", "start", "tie", shard.alias("shard")), "start", "doc_id", "tie")
    rows = placed.groupBy("part", "shard").agg(F.count("*").alias("rows"))
    offsets = running_offsets(rows.groupBy("part").agg(F.sum("rows").alias("offset")), "part", "offset")
    firsts = running_offsets(rows.groupBy("shard").agg(F.sum("rows").alias("first")), "shard", "first")
    # one row per partition, and one per shard
    return (placed.join(F.broadcast(offsets), "part").join(F.broadcast(firsts), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("offset") + F.col("row") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


_ROUND = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
_CUTS = "".join(f""", j{i} AS (SELECT c.*, coalesce(l.e, 0) AS a{i} FROM j{i - 1} c ASOF LEFT JOIN line l ON c.a{i - 1} + c.cap >= l.e)"""
                for i in range(1, SHARDS + 1))
SQL = f"""
WITH t0 AS (SELECT b, b AS c FROM range(0, 256) r(b)),
""" + ",\n".join(f"t{i} AS (SELECT b, {_ROUND} AS c FROM t{i - 1})" for i in range(1, 9)) + f""",
crc AS (SELECT string_agg(printf('%08x', c), '' ORDER BY b) AS crc_table FROM t8),
items AS MATERIALIZED (SELECT doc_id, text, coalesce(strlen(text), 0) + 1 AS size,
                 xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(
                     regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
                   lambda a, b: xor(a // 256, ('0x' || substr(crc_table, 8 * (xor(a, b) % 256) + 1, 8))::BIGINT))) AS text_crc32
          FROM documents, crc),
groups AS (SELECT text, min(doc_id) AS first_id, sum(size)::BIGINT AS bytes FROM items GROUP BY text),
line AS MATERIALIZED (SELECT text, first_id, sum(bytes) OVER (ORDER BY first_id)::BIGINT AS e, bytes FROM groups),
span AS (SELECT max(e) AS total, max(bytes) AS largest FROM line),
j0 AS (SELECT cap, 0::BIGINT AS a0
       FROM span, range(greatest(largest, (total + {SHARDS - 1}) // {SHARDS}),
                        (total + {SHARDS - 1}) // {SHARDS} + largest + 1) r(cap))
{_CUTS},
best AS (SELECT * FROM j{SHARDS}, span WHERE a{SHARDS} = total ORDER BY cap LIMIT 1),
sharded AS (SELECT i.doc_id, i.size, i.text_crc32, l.first_id,
                   ({' + '.join(f'(l.e - l.bytes >= b.a{i})::INT' for i in range(1, SHARDS))})::INT AS shard
            FROM items i JOIN line l ON i.text IS NOT DISTINCT FROM l.text, best b)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY first_id, doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM sharded
"""
