"""Readers of the lake layers (SRC-01..03, SRC-05, SRC-07, SRC-08).

Every reader passes an explicit schema: an empty folder then reads as an
empty DataFrame instead of failing, and a field absent from one batch reads
as null instead of failing the plan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import APP_LOG, CDC_ENVELOPE, CHANGE_RECORD

#: Files of changes in a micro-batch at most (STR-02).
FILES_PER_TRIGGER = 100


def read_changes(spark: SparkSession, path: str | list[str], stream: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """SRC-01: change records (JSON lines, tagged images as variant).

    A line that is no JSON record keeps its text in ``_corrupt_record``.
    ``stream=True`` returns a streaming DataFrame; ``files_per_trigger``
    (``FILES_PER_TRIGGER`` unless given) bounds one micro-batch.
    """
    if stream:
        return spark.readStream.schema(CHANGE_RECORD).option("maxFilesPerTrigger", files_per_trigger or FILES_PER_TRIGGER).json(path)
    return spark.read.schema(CHANGE_RECORD).json(path)


def change_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a read of ``path`` would open, in order of their names; none is opened."""
    return sorted(spark.read.schema("value string").text(path).inputFiles())


def _partition_filter(df: DataFrame, dates: Iterable | None) -> DataFrame:
    if not dates:
        return df
    cond = None
    for d in dates:
        y, m, dd = (int(x) for x in str(d).split("-"))
        term = (F.col("year") == y) & (F.col("month") == m) & (F.col("day") == dd)
        cond = term if cond is None else (cond | term)
    return df.filter(cond)


def read_bronze(spark: SparkSession, path: str, dates: Iterable | None = None) -> DataFrame:
    """SRC-02: bronze envelopes (gzip JSON lines under year=/month=/day=).

    Read ONCE per job; ``dates`` ("YYYY-MM-DD") become partition filters,
    pruned at planning time.
    """
    df = spark.read.schema(_with_parts(CDC_ENVELOPE)).json(path)
    return _partition_filter(df, dates).drop("batch")


def read_bronze_batches(spark: SparkSession, path: str, batches: Iterable[str | int]) -> DataFrame:
    """SRC-02: the bronze envelopes that some batches landed; other folders aren't listed."""
    paths = [f"{path.rstrip('/')}/batch={b}" for b in batches]
    return spark.read.schema(_with_parts(CDC_ENVELOPE)).json(paths)


def read_bronze_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """SRC-02 as a file stream: every bronze file once, in bounded micro-batches."""
    return spark.readStream.schema(_with_parts(CDC_ENVELOPE)).option(
        "maxFilesPerTrigger", files_per_trigger or FILES_PER_TRIGGER).json(path).drop("batch")


def _with_parts(schema: StructType) -> StructType:
    from pyspark.sql.types import IntegerType, StructField
    return StructType(schema.fields + [StructField(p, IntegerType()) for p in ("year", "month", "day")])


def read_silver(spark: SparkSession, root: str, table: str, schema: StructType | None = None) -> DataFrame:
    """SRC-03: a silver/gold Parquet table (partition columns recovered)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{root.rstrip('/')}/{table}")


def read_logs(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """SRC-05: structured application log lines."""
    if stream:
        return spark.readStream.schema(APP_LOG).json(path)
    return spark.read.schema(APP_LOG).json(path)


def infer_catalog(spark: SparkSession, name: str, path: str, fmt: str = "json") -> StructType:
    """SRC-07: infer a folder's schema (like a crawler) and register it.

    Inference is kept to this catalog step; the jobs themselves never infer.
    """
    df = spark.read.format(fmt).load(path)
    spark.catalog.createTable(name, path=path, source=fmt, schema=df.schema)
    return df.schema


def layer_inventory(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """SRC-08: file count and total bytes per layer and top-level prefix.

    Lists files with the binaryFile source but selects only path and
    length, so file contents are never read.
    """
    frames = []
    for layer, root in roots.items():
        f = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
            .option("pathGlobFilter", "*").load(root).select("path", "length")
        base = root.rstrip("/") + "/"
        rel = F.regexp_replace(F.col("path"), "^(file:)?" + _re_escape(base.replace("file:", "")), "")
        frames.append(f.select(F.lit(layer).alias("layer"),
                               F.split(rel, "/").getItem(0).alias("prefix"), "length"))
    allf = frames[0]
    for f in frames[1:]:
        allf = allf.unionByName(f)
    return allf.groupBy("layer", "prefix").agg(F.count(F.lit(1)).alias("files"),
                                               F.sum("length").alias("bytes"))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


def inventory_snapshot(spark: SparkSession, roots: dict[str, str], snapshot_ts) -> DataFrame:
    """MON-07 input: one layer inventory stamped with its snapshot time;
    append successive snapshots and feed them to ``monitor.layer_growth``."""
    inv = layer_inventory(spark, roots).groupBy("layer").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    return inv.select(F.lit(snapshot_ts).cast("timestamp").alias("snapshot_ts"), "layer", "files", "bytes")
