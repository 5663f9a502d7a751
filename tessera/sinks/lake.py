"""Writers of the lake layers (SNK-01..12).

Silver and gold are rewritten as a whole (full recompute, overwrite) by
default: appending while re-reading all of bronze multiplies rows on every
run, and a dynamic partition overwrite would leave stale rows when a key
moves to another date partition.  ``mode="append"`` stays available to
reproduce the old behaviour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_parts

PARTS = ["year", "month", "day"]
#: Parts a batch's name from the piece of it that a folder holds.
PIECE = ".files-"


#: Rows of a bronze file at most: gzip JSON can't be split, so its size bounds a read task.
BRONZE_FILE_ROWS = 500_000


def write_bronze(df: DataFrame, path: str, batch: str | int) -> None:
    """SNK-01: gzip JSON lines by arrival date, in the folder of the batch.

    A batch's folder is overwritten, so a job run again replaces its own
    output.  Rows are clustered by date; AQE measures the dates and splits
    large ones over tasks and puts small ones together, which keeps files few.
    """
    out = df if "year" in df.columns else date_parts(df, "processed_at")
    out.hint("rebalance", *PARTS).write.mode("overwrite").option("compression", "gzip") \
        .option("maxRecordsPerFile", BRONZE_FILE_ROWS).partitionBy(*PARTS).json(f"{path.rstrip('/')}/batch={batch}")


def write_silver(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-02: Parquet partitioned by year/month/day, clustered first; a large day is split by its measured size."""
    df.hint("rebalance", *PARTS).write.mode(mode).partitionBy(*PARTS).parquet(path)


def write_gold(df: DataFrame, path: str) -> None:
    """SNK-03: full overwrite Parquet."""
    df.write.mode("overwrite").parquet(path)


def quarantine(bad: DataFrame, path: str, batch: str | int) -> None:
    """SNK-04: failed records with their error text, kept aside in the folder of the batch."""
    bad.write.mode("overwrite").json(f"{path.rstrip('/')}/batch={batch}")


def remove_batches(spark: SparkSession, path: str, batch: str) -> None:
    """Remove the folder of ``batch`` under ``path``, and those of its pieces."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if name == f"batch={batch}" or name.startswith(f"batch={batch}{PIECE}"):
            files.delete(status.getPath(), True)


def piece_name(batch: str, first: int, end: int) -> str:
    """The batch name of files ``first`` up to ``end`` of a batch."""
    return f"{batch}{PIECE}{first}-{end}"


def write_metrics(metrics: DataFrame, path: str) -> None:
    """SNK-05: metric points appended, grouped by namespace."""
    metrics.write.mode("append").partitionBy("namespace").parquet(path)


def register_database(spark: SparkSession, name: str, description: str = "", location: str | None = None) -> None:
    """SNK-07: database definition."""
    loc = f" LOCATION '{location}'" if location else ""
    desc = description.replace("'", "''")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{desc}'{loc}")


def register_table(spark: SparkSession, name: str, path: str, schema=None, partition_keys: list[str] | None = None) -> None:
    """SNK-06: external Parquet table over a folder (partitions recovered)."""
    spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    if partition_keys:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def run_sql_to(spark: SparkSession, sql: str, out: str, fmt: str = "parquet") -> DataFrame:
    """SNK-08: run SQL and materialize the result under a results prefix."""
    df = spark.sql(sql)
    df.write.mode("overwrite").format(fmt).save(out)
    return spark.read.format(fmt).load(out)


def ctas_gold(spark: SparkSession, name: str, sql: str) -> None:
    """SNK-09: create table as select, overwritten on rerun."""
    spark.sql(sql).write.mode("overwrite").saveAsTable(name)


def skip_if_empty(df: DataFrame) -> bool:
    """SNK-12: True when there is nothing to write (a limit-1 probe, not a count)."""
    return df.isEmpty()


def new_version_path(root: str, version: int) -> str:
    """Mutations write a new version directory instead of overwriting in place."""
    return f"{root.rstrip('/')}/v={version:06d}"
