"""FIL-16: substring search through an inverted index of trigrams.

Every three characters of a row's lower-case text are a posting (gram, key),
stored by a hash bucket of the gram and sorted by it.  A pattern's grams name
the buckets to open; keys that have all of them are candidates, and the
pattern is looked for in their rows.  A row that contains the pattern has all its grams, so none is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
#: Folders of postings: a search opens at most one for each gram of the pattern.
BUCKETS = 64


def folded(*texts: str) -> Column:
    """The lower-case text that is searched; columns are kept apart by a line feed."""
    return F.lower(F.concat_ws("\n", *[F.coalesce(F.col(t), F.lit("")) for t in texts]))


def _bucket(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int")


def write_index(rows: DataFrame, root: str, key: str, *texts: str) -> None:
    """Write the postings of ``rows``; equal grams of a row are one posting."""
    text = folded(*texts)
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    grams = F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM)))))
    postings = rows.select(F.col(key).alias("key"), F.explode(grams).alias("gram"))
    # a frequent gram's postings are split by key, so no bucket's writer holds them alone
    (postings.withColumn("bucket", _bucket(F.col("gram"))).hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram", "key")
     .write.mode("overwrite").partitionBy("bucket").parquet(root))


def candidates(spark: SparkSession, root: str, pattern: str, key_type: str = "string") -> DataFrame | None:
    """Keys of rows that have all grams of the pattern; None for patterns shorter than a gram."""
    text = pattern.lower()
    grams = sorted({text[i:i + GRAM] for i in range(len(text) - GRAM + 1)})
    if not grams:
        return None
    buckets = [r[0] for r in spark.createDataFrame([(g,) for g in grams], "gram string").select(_bucket(F.col("gram"))).distinct().collect()]
    postings = spark.read.schema(f"key {key_type}, gram string, bucket int").parquet(root)
    return (postings.filter(F.col("bucket").isin(buckets) & F.col("gram").isin(grams)).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") == len(grams)).select("key"))


def search(rows: DataFrame, root: str, key: str, pattern: str, *texts: str) -> DataFrame:
    """The rows of which one of ``texts`` contains the pattern, whatever its case; those of short patterns by a scan."""
    hit = None
    for t in texts:
        one = F.lower(F.coalesce(F.col(t), F.lit(""))).contains(pattern.lower())
        hit = one if hit is None else hit | one
    found = candidates(rows.sparkSession, root, pattern, rows.schema[key].dataType.simpleString())
    if found is None:
        return rows.filter(hit)
    return rows.join(found.withColumnRenamed("key", key), key, "left_semi").filter(hit)
