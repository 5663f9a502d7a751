"""Stored sparse indexes of the current state (PRJ-14, SRC-06, FIL-08..15): bucketed, sorted tables of entries.

An index holds one entry for every item that has its partition key: that key as
``part``, its sort key as ``sort``, the item's own key and the item.  A lookup
names a part and a range of the sort key.  Spark opens the buckets of that part
alone, and within them Parquet skips what lies outside the range.

* **Hot parts.** A part's entries are dealt over ``spread`` cells by the item's key, and tables are bucketed
  by cell: a part with a third of all items fills many buckets, and a lookup opens ``spread`` of them at most.
* **Upkeep.** A change of items appends entries, nothing is rewritten: a live one for each new image, a dead one where
  the old image had a key that the new one lacks.  Of equal entries the one of the highest version counts.
  ``compact`` writes the live ones as a new table.
* **Recovery.** An append is one Spark write, seen whole or not at all.  A version appended again changes no result.

Items without the partition key have no entry.  A null sort key is an entry that no range finds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import ITEM

ITEM_COLS = [f.name for f in ITEM.fields]


@dataclass(frozen=True)
class Index:
    """The columns of an index and how its table is cut.  ``buckets`` is fixed when the table is made; size it so
    that a bucket is one task's work.  ``spread`` bounds the buckets that one part fills and that a lookup opens."""

    part: str
    sort: str
    buckets: int = 64
    spread: int = 8

    def cell(self, part: Column, pk: Column, sk: Column) -> Column:
        return _cell(part, F.pmod(F.xxhash64(pk, sk), F.lit(self.spread)))

    def cells(self, part: Column) -> list[Column]:
        return [_cell(part, F.lit(i)) for i in range(self.spread)]


def _cell(part: Column, number: Column) -> Column:
    return F.concat_ws("|", part, number.cast("string"))


#: The item's own key and the four secondary keys.
PRIMARY = Index("PK", "SK")
BY_STATUS = Index("GSI1PK", "GSI1SK")
BY_DUE_DATE = Index("GSI2PK", "GSI2SK")
BY_PRIORITY = Index("GSI3PK", "GSI3SK")
BY_CATEGORY = Index("GSI4PK", "GSI4SK")

_ENTRY = ["part", "sort", "PK", "SK"]
_KEY = ["cell", *_ENTRY]


def _entries(items: DataFrame, index: Index, version: int, live: bool) -> DataFrame:
    part = F.col(index.part)
    item = F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ITEM.fields])
    # a dead entry needs no item
    kept = item if live else F.lit(None).cast(ITEM)
    return items.filter(part.isNotNull()).select(
        index.cell(part, F.col("PK"), F.col("SK")).alias("cell"), part.alias("part"), F.col(index.sort).alias("sort"), "PK", "SK",
        F.lit(version).cast("long").alias("version"), F.lit(live).alias("live"), kept.alias("item"))


def _append(entries: DataFrame, index: Index, table: str, path: str, mode: str) -> None:
    # dealt as the buckets are cut, so each bucket gets one sorted file an append
    (entries.repartition(index.buckets, "cell").sortWithinPartitions("cell", "sort").write.format("parquet")
     .bucketBy(index.buckets, "cell").sortBy("cell", "sort").option("path", path).mode(mode).saveAsTable(table))


def build(state: DataFrame, index: Index, table: str, path: str, version: int = 1) -> None:
    """Write the index of a whole ``state`` (item columns, one row a key) as ``table``, its files under ``path``."""
    _append(_entries(state, index, version, live=True), index, table, path, "overwrite")


def attach(spark: SparkSession, index: Index, table: str, path: str) -> None:
    """Name an index that another session wrote.  The catalog is given its buckets; files aren't opened."""
    columns = ", ".join(f"`{f}` {t}" for f, t in [*[(k, "string") for k in _KEY], ("version", "bigint"), ("live", "boolean"),
                                                ("item", ITEM.simpleString())])
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (cell) SORTED BY (cell, sort) "
              f"INTO {index.buckets} BUCKETS LOCATION '{path}'")


def apply_changes(before: DataFrame, after: DataFrame, index: Index, table: str, path: str, version: int) -> None:
    """Keep ``table`` up with a change of items: ``before`` and ``after`` are the changed keys' rows on either side of it.

    A key in ``before`` alone was deleted, one in ``after`` alone is new.  The work follows the change, not the index.
    """
    old, new = (_entries(df, index, version, live) for df, live in ((before, False), (after, True)))
    o, n = old.alias("o"), new.alias("n")
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in _ENTRY]
    _append(o.join(n, same, "left_anti").unionByName(new), index, table, path, "append")


def _standing(entries: DataFrame, *also: str) -> DataFrame:
    """The items of the entries that stand: the newest of each, unless it is dead.  The keys hold the bucket column, so no shuffle."""
    newest = entries.groupBy(*also, *_KEY).agg(F.max_by(F.struct("live", "item"), "version").alias("_e")).filter("_e.live")
    return newest.select(*also, *[F.col(f"_e.item.{c}").alias(c) for c in ITEM_COLS])


def prefix_range(prefix: str) -> tuple[str, str]:
    """The range of the texts that begin with ``prefix``."""
    return prefix, prefix + "\U0010ffff"


def lookup(spark: SparkSession, index: Index, table: str, part: str, low: str, high: str) -> DataFrame:
    """The items of ``part`` whose sort key lies in [low, high]; opens the buckets of that part's cells alone."""
    cells = F.col("cell").isin(*index.cells(F.lit(part)))
    return _standing(spark.table(table).filter(cells & (F.col("part") == part) & F.col("sort").between(low, high)))


def get_item(spark: SparkSession, index: Index, table: str, pk: str, sk: str) -> DataFrame:
    """The item of a full key, by an index of the item's own key; opens one bucket."""
    cell = F.col("cell") == index.cell(F.lit(pk), F.lit(pk), F.lit(sk))
    return _standing(spark.table(table).filter(cell & (F.col("part") == pk) & (F.col("sort") == sk)))


def lookup_many(index: Index, table: str, wanted: DataFrame) -> DataFrame:
    """Bulk lookup: ``wanted`` has (part, low, high); (low, high) come back with each item they find.

    The join is on the cell, so the index is read as it lies and only the
    wanted ranges are shuffled.  Equal ranges count once; nulls find nothing.
    """
    ranges = wanted.select("part", "low", "high").distinct()
    dealt = ranges.select(F.explode(F.array(*index.cells(F.col("part")))).alias("cell"), F.col("part").alias("_part"), "low", "high")
    found = wanted.sparkSession.table(table).join(dealt, "cell").filter(
        (F.col("part") == F.col("_part")) & F.col("sort").between(F.col("low"), F.col("high")))
    return _standing(found, "low", "high")


def get_items(index: Index, table: str, keys: DataFrame) -> DataFrame:
    """Bulk form of ``get_item``: the items of a batch of (PK, SK), each once."""
    cell = index.cell(F.col("PK"), F.col("PK"), F.col("SK"))
    wanted = keys.select("PK", "SK").distinct().select(cell.alias("cell"), "PK", "SK")
    return _standing(keys.sparkSession.table(table).join(wanted, ["cell", "PK", "SK"], "left_semi"))


def compact(spark: SparkSession, index: Index, table: str, into: str, path: str, version: int) -> None:
    """Write the standing entries of ``table`` as the table ``into``; readers change over when they choose."""
    build(_standing(spark.table(table)), index, into, path, version)
