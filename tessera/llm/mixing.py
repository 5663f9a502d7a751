"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate from its target share of the output
bytes.  A document's number of copies is the inverse of that Poisson
distribution at a uniform number hashed from the document, so a rerun, a retry
or another partitioning makes the same copies.  Copies are then spread over
the whole output in the order of a second hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, partitions, read_table, written

SEED = 20240131
#: Target shares of the output bytes; sources not named share the rest as they do in the input.  A named
#: source that the input lacks leaves its share to the others.
WEIGHTS = {"src0": 0.25, "src1": 0.2, "src2": 0.05, "src3": 0.01, "archive": 0.1}
#: Equal rows are dealt to tasks in lots of this many.
LOT = 1000
#: A rate above this is drawn as a sum of independent draws, so exp(-rate) never underflows.
RATE_STEP = 32
BITS = 52
DERIVED = ("copy_no", "shuffle_key")


def _bits(text: Column) -> Column:
    """The first 52 bits of a text's MD5 as a long."""
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: dict[str, float], scale: float = 1.0,
                 source: str = "source", text: str = "text") -> DataFrame:
    """Per source: its mean repetition rate, number of draws and the cumulative distribution of one draw.

    A document weighs its UTF-8 bytes plus one.  A null source is a source of its own.
    """
    if any(w < 0 for w in weights.values()) or sum(weights.values()) > 1 + 1e-9:
        raise ValueError("weights are shares of the output: none negative, at most 1 together")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("bytes"))
    named = F.lit(None).cast("double")
    for name, w in sorted(weights.items()):
        named = F.when(F.col("source") == name, F.lit(float(w))).otherwise(named)
    sizes = written(sizes.withColumn("named", named), "sizes")
    total = sizes.agg(F.sum("bytes").alias("all"), F.sum("named").alias("named"),
                      F.sum(F.when(F.col("named").isNull(), F.col("bytes"))).alias("other")).first()
    rest = max(0.0, 1 - (total.named or 0.0))
    # named sources that the input lacks leave their share to the others in proportion
    present = (total.named or 0.0) + (rest if total.other else 0.0)
    share = F.coalesce(F.col("named"), F.lit(rest) * F.col("bytes") / F.lit(total.other or 1))
    rate = share / F.lit(present) * F.lit(total.all) / F.col("bytes") * F.lit(float(scale)) if present else F.lit(0.0)
    draws = F.greatest(F.lit(1), F.ceil(F.col("rate") / RATE_STEP)).cast("int")
    one = F.col("rate") / F.col("draws")
    last = F.ceil(one + 10 * F.sqrt(one) + 20).cast("int")
    zero = F.exp(-one)
    steps = F.aggregate(
        F.sequence(F.lit(1), last), F.struct(zero.alias("p"), F.array(zero).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * one / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * one / k)).alias("cdf")))
    return (sizes.select("source", rate.alias("rate")).withColumn("draws", draws)
            .select("source", "rate", "draws", steps["cdf"].alias("cdf")))


def _single_rows(docs: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(row, key, of, nth): every row, the hash key of its columns and its number among the rows equal to it.

    Equal rows are counted per key first; only rows of a repeated key are
    grouped, and a group is dealt out again in lots, so a hot one stays spread.
    """
    spark = docs.sparkSession
    others = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00")) for c in docs.columns if c not in (doc_id, text)]
    key = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit(""))),
                      F.col(text).isNull().cast("int").cast("string"), F.md5(F.concat_ws("\x1f", *others)))
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(own, key.alias("key"), F.col(source).alias("of"))
    repeated = written(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "repeated")
    side = F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated
    once = rows.join(side, "key", "left_anti").select("row", "key", "of", F.lit(1).cast("long").alias("nth"))
    groups = rows.join(side, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row"), F.first("of").alias("of"), F.count("*").alias("n"))
    lots = (groups.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / LOT))))
            .repartition(partitions(spark), "key", "lot"))
    first = F.col("lot") * LOT + 1
    again = lots.select("row", "key", "of", F.explode(F.sequence(first, F.least(first + LOT - 1, F.col("n")))).alias("nth"))
    return once.unionByName(again)


def mix_sources(docs: DataFrame, weights: dict[str, float] = WEIGHTS, scale: float = 1.0, seed: int = SEED,
                doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Documents repeated to the target shares, in a global random order.

    Returns the input's columns and ``copy_no`` (from 1) and ``shuffle_key``;
    partitions follow each other by ``shuffle_key`` and are sorted by it.
    ``scale`` is the expected output size over the input size.

    Null source: a source of its own.  Null or empty text: a document of one
    byte.  Every row draws for itself, by a hash of all its columns and of its number among
    rows equal to it, so null and repeated ids and equal rows reach their source's share
    like others.  Empty table: empty result.  An input column named like a new one is replaced by it.
    """
    spark = docs.sparkSession
    rates = written(source_rates(docs, weights, scale, source, text), "rates")
    known = rates.count()
    docs = docs.drop(*DERIVED)
    rows = _single_rows(docs, doc_id, text, source).withColumn("key", F.concat_ws(":", "key", F.col("nth").cast("string")))
    if known <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(rates), rows["of"].eqNullSafe(rates["source"]))
    else:  # too many sources to broadcast: shuffle, a source's rows over 64 salts
        salted = rates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(63))))
        rows = rows.withColumn("salt_of", F.pmod(F.xxhash64("key"), F.lit(64)).cast("int"))
        joined = rows.join(salted, rows["of"].eqNullSafe(salted["source"]) & (rows["salt_of"] == salted["salt"]))
    uniform = lambda i: (_bits(F.concat_ws(":", F.lit(f"{seed}:n"), i.cast("string"), F.col("key"))) + F.lit(0.5)) / F.lit(float(2**BITS))
    copies = F.aggregate(F.transform(F.sequence(F.lit(0), F.col("draws") - 1), uniform), F.lit(0),
                         lambda acc, u: acc + F.size(F.filter("cdf", lambda c: c < u)))
    drawn = (joined.withColumn("copies", F.when(F.col("rate") > 0, copies).otherwise(0)).filter("copies > 0")
             .select("row", "key", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no")))
    order = _bits(F.concat_ws(":", F.lit(f"{seed}:o"), F.col("copy_no").cast("string"), F.col("key")))
    n = partitions(spark)
    keyed = drawn.withColumn("shuffle_key", order)
    # hashed keys are uniform, so equal slices of their range need no sampling pass
    place = F.floor(F.col("shuffle_key") * F.lit(float(n) / 2**BITS)).cast("int")
    return (keyed.repartitionById(n, place).sortWithinPartitions("shuffle_key", "key", "copy_no")
            .select("row.*", *DERIVED))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


_NAMED = " ".join(f"WHEN '{name}' THEN {share}" for name, share in sorted(WEIGHTS.items()))
SQL = f"""
WITH sizes AS (SELECT source, sum(coalesce(strlen(text), 0) + 1) AS bytes,
                      (CASE source {_NAMED} END)::DOUBLE AS named
               FROM documents GROUP BY source),
total AS (SELECT sum(bytes) AS all_bytes, coalesce(sum(named), 0) AS named_share,
                 sum(CASE WHEN named IS NULL THEN bytes END) AS other_bytes FROM sizes),
shares AS (SELECT source, bytes, all_bytes,
                  coalesce(named, (1 - named_share) * bytes / other_bytes)
                    / (named_share + CASE WHEN other_bytes IS NULL THEN 0 ELSE 1 - named_share END) AS share
           FROM sizes, total),
rates AS (SELECT source, share * all_bytes / bytes AS rate,
                 greatest(1, ceil(share * all_bytes / bytes / {RATE_STEP}))::INT AS draws FROM shares),
cdf AS (SELECT source, draws, k,
               sum(exp(-rate / draws + k * ln(rate / draws) - lgamma(k + 1)))
                 OVER (PARTITION BY source ORDER BY k) AS c
        FROM rates, range(0, 200) t(k) WHERE k <= ceil(rate / draws + 10 * sqrt(rate / draws) + 20)),
lists AS (SELECT source, draws, list(c ORDER BY k) AS cdf FROM cdf GROUP BY source, draws),
hashed AS (SELECT d.*, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':' || (text IS NULL)::INT || ':' ||
                       md5(concat_ws(chr(31), coalesce(lang, chr(0)), coalesce(source, chr(0)), coalesce(n_chars::VARCHAR, chr(0)))) AS whole
           FROM documents d),
keyed AS (SELECT *, whole || ':' || row_number() OVER (PARTITION BY whole) AS key FROM hashed),
drawn AS (SELECT k.*, i, (('0x' || substr(md5('{SEED}:n:' || i || ':' || key), 1, 13))::BIGINT + 0.5::DOUBLE)
                           / {float(2**BITS)}::DOUBLE AS u, cdf
          FROM keyed k JOIN lists l ON k.source IS NOT DISTINCT FROM l.source, range(0, draws) t(i)),
counted AS (SELECT doc_id, text, lang, source, n_chars, key, sum(len(list_filter(cdf, lambda x: x < u))) AS copies
            FROM drawn GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, c::INT AS copy_no,
       ('0x' || substr(md5('{SEED}:o:' || c || ':' || key), 1, 13))::BIGINT AS shuffle_key
FROM counted, range(1, copies::BIGINT + 1) t(c)
"""
