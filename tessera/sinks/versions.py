"""Tables that change by bucket: a version rewrites the buckets it touches and points at the others.

A row lives in the bucket of its key's hash.  A version is the list of its
buckets, each with the version that wrote it; the list is one small Parquet
file and is written last, so a reader sees a whole version or the one before.  A
version written again replaces its own files, which no other version holds yet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: Buckets of a table: fixed when it is made, sized so that a bucket is one task's work.
BUCKETS = 64


def bucket_of(*keys: str, buckets: int = BUCKETS) -> Column:
    """The bucket of a key, null keys included."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def range_bounds(df: DataFrame, key: str, buckets: int = BUCKETS) -> list:
    """The least key of each of about ``buckets`` key ranges but the first: fixed when the table is made, kept by its owner."""
    parts = df.select(key).filter(F.col(key).isNotNull()).repartitionByRange(buckets, key).groupBy(F.spark_partition_id().alias("p"))
    return sorted(r.low for r in parts.agg(F.min(key).alias("low")).collect())[1:]


def range_bucket(key: str, bounds: list) -> Column:
    """The bucket of a key by range: neighbours lie together, so a change of a key range touches few buckets; null keys the first."""
    if not bounds:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(key))), F.lit(0))


def manifest(spark: SparkSession, root: str, version: int) -> dict[int, int]:
    """bucket -> the version that wrote it, as of ``version`` (at most ``BUCKETS`` entries); 0 is the empty table."""
    if version <= 0:
        return {}
    rows = spark.read.schema("bucket int, written int").parquet(f"{root}/manifest/version={version}").collect()
    return {r.bucket: r.written for r in rows}


def read_version(spark: SparkSession, root: str, schema: StructType, version: int, buckets: Iterable[int] | None = None) -> DataFrame:
    """The rows of ``version``, of some buckets only if given; other files aren't listed or opened."""
    listed = manifest(spark, root, version)
    wanted = sorted(listed) if buckets is None else sorted(set(buckets) & set(listed))
    paths = [f"{root}/data/version={listed[b]}/bucket={b}" for b in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def touched_buckets(df: DataFrame) -> list[int]:
    """The values of ``bucket`` that occur: at most ``BUCKETS``."""
    return sorted(r.bucket for r in df.select("bucket").distinct().collect())


def write_version(spark: SparkSession, root: str, rows: DataFrame, version: int, touched: Iterable[int]) -> dict[int, int]:
    """Write ``rows`` (with ``bucket``), the whole new content of the buckets ``touched``, as ``version``."""
    data = f"{root}/data/version={version}"
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(data)
    schema = StructType([f for f in rows.schema.fields if f.name != "bucket"])
    written = spark.read.schema(StructType([*schema.fields, StructField("bucket", IntegerType())])).parquet(data)
    now = {b: w for b, w in manifest(spark, root, version - 1).items() if b not in set(touched)}
    now |= {b: version for b in touched_buckets(written)}
    rows_of = spark.createDataFrame(sorted(now.items()), "bucket int, written int")
    rows_of.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")
    return now


def rewrite(spark: SparkSession, root: str, schema: StructType, version: int, bucket: Column, requests: DataFrame,
            change: Callable[[DataFrame, DataFrame], DataFrame]) -> dict:
    """Copy-on-write: ``version`` is version - 1 with ``change(rows, requests)`` in the buckets that a request addresses.

    ``requests`` has the columns of ``bucket``.  Rows of other buckets are neither read nor written; a rerun of
    the version starts from version - 1 again.
    """
    touched = touched_buckets(requests.select(bucket.alias("bucket")))
    rows = read_version(spark, root, schema, version - 1, touched)
    new = change(rows, requests).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    write_version(spark, root, new.withColumn("bucket", bucket), version, touched)
    return {"version": version, "touched": touched, "read": rows.inputFiles()}
