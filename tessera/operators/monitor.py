"""Monitoring analytics as windowed aggregates (MON-01..07, WIN-04/05).

The reference configures a metrics service; here the same roll-ups are
computed from the application log / metric stream with ``window()``
aggregates.  Alarms run on the per-period aggregate (one row per metric and
period), whose size depends on the time span, not on the data volume.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import APP_LOG
from ..session import work_path

# Fixed values of the app log view: event_type -> log level (default INFO)
# and -> http status (default 200)
LOG_LEVEL = {"error": "ERROR"}
HTTP_STATUS = {"error": 500, "signup": 201, "purchase": 201}


def _lookup(c, mapping: dict, default):
    out = F.lit(default)
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


def app_log_from_events(events: DataFrame) -> DataFrame:
    """APP_LOG rows from the events table (SURVEY 7.3: error -> status
    error, value -> duration_ms, x100 so sub-unit values keep precision)."""
    is_err = F.col("event_type") == "error"
    http = _lookup(F.col("event_type"), HTTP_STATUS, 200)
    return events.select(
        F.col("ts").alias("timestamp"),
        _lookup(F.col("event_type"), LOG_LEVEL, "INFO").alias("level"),
        F.concat(F.col("user_id").cast("string"), F.lit(":"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.lit("api").alias("component"),
        F.col("event_type").alias("operation"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration_ms"),
        F.when(is_err, "error").otherwise("ok").alias("status"),
        F.concat(F.col("event_type"), F.lit(" handled")).alias("message"),
        F.create_map(F.lit("http_status"), http.cast("string")).alias("metadata"),
    ).select(*[f.name for f in APP_LOG.fields])


def rollup(log: DataFrame, value_col: str, period: str = "5 minutes", by: list[str] | None = None) -> DataFrame:
    """MON-01: Sum / Average / Maximum / count per period (and dimensions)."""
    keys = [F.window("timestamp", period).alias("w")] + [F.col(b) for b in (by or [])]
    return log.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum(value_col).alias("sum"),
        F.avg(value_col).alias("average"),
        F.max(value_col).alias("maximum"),
    ).select(F.col("w.start").alias("period_start"), *(by or []), "samples", "sum", "average", "maximum")


PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latency_percentiles(log: DataFrame, period: str | None = None, exact: bool = True) -> DataFrame:
    """MON-03: P50 / P95 / P99 of duration_ms, exact with interpolation (``exact_percentiles``), or by the mergeable
    approximate sketch."""
    d = F.col("duration_ms").cast("double")
    if exact:
        if period is None:
            return exact_percentiles(log.select(d.alias("value")), "value", PERCENTILES)
        timed = log.select(F.window("timestamp", period).start.alias("period_start"), d.alias("value"))
        return exact_percentiles(timed, "value", PERCENTILES, "period_start")
    p = [F.percentile_approx(d, q, 10000).cast("double").alias(n) for n, q in PERCENTILES.items()]
    if period is None:
        return log.agg(*p)
    return log.groupBy(F.window("timestamp", period).start.alias("period_start")).agg(*p)


def exact_percentiles(df: DataFrame, value: str, wanted: dict[str, float], key: str | None = None) -> DataFrame:
    """Exact percentiles, interpolated between neighbours, of ``value`` per ``key`` or of all rows, by order statistics.

    Equal values are counted map-side; the (key, value, count) table is range
    partitioned and written by partition.  Running sums of the partitions say which one holds a
    rank, and only those partitions are read again: no task sees all
    distinct values of a key, however hot.  Null values count for nothing; a key with no
    value, or no row at all without a key, has null percentiles.
    """
    spark = df.sparkSession
    keyed = df.select((F.col(key) if key else F.lit(0)).alias("k"), F.col(value).cast("double").alias("v"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    line = (keyed.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).repartitionByRange(n, "k", "v")
            .withColumn("part", F.spark_partition_id()))
    root = work_path(spark, f"percentiles-{uuid.uuid4().hex}")
    line.write.partitionBy("part").parquet(root)
    line = spark.read.schema(line.schema).parquet(root)
    # one row per key and partition that holds some of it: keys + partitions in all
    sums = line.filter("v is not null").groupBy("k", "part").agg(F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("k").orderBy("part"))
    total = F.sum("n").over(Window.partitionBy("k"))
    placed = sums.select("k", "part", (upto - F.col("n")).alias("before"), upto.alias("upto"), total.alias("total"))
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(q)).alias("q")) for name, q in wanted.items()]))
    at = F.col("a.q") * (F.col("total") - 1)
    ranks = placed.withColumn("a", asked).select(
        "k", "part", "before", "upto", F.col("a.name").alias("name"), at.alias("at"),
        F.explode(F.array(F.floor(at), F.ceil(at))).alias("rank")).distinct().filter("rank >= before and rank < upto")
    ranks = _materialized(ranks.select("k", "part", "before", "name", "at", "rank"), "ranks")
    # at most one number a partition; a filter on the folders
    parts = [r.part for r in ranks.select("part").distinct().collect()]
    held = line.filter(F.col("part").isin(parts) & F.col("v").isNotNull())
    running = F.sum("n").over(Window.partitionBy("part", "k").orderBy("v"))
    held = held.select("k", "part", "v", "n", running.alias("run"))
    on = held["k"].eqNullSafe(ranks["k"]) & (held["part"] == ranks["part"])
    rank = F.col("rank") - F.col("before")
    found = ranks.join(held, on).filter((rank < F.col("run")) & (rank >= F.col("run") - F.col("n"))) \
        .select(ranks["k"], "name", "at", "rank", "v")
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    share = F.max(F.col("at") - F.floor("at"))
    each = found.groupBy("k", "name").agg((low + (high - low) * share).alias("p"))
    out = each.groupBy("k").agg(*[F.max(F.when(F.col("name") == name, F.col("p"))).alias(name) for name in wanted])
    if key is None:
        return spark.range(1).select(F.lit(0).alias("k")).join(out, "k", "left").select(*wanted)
    every = line.select("k").distinct().withColumnRenamed("k", key)
    out = out.withColumnRenamed("k", "_k")
    return every.join(out, every[key].eqNullSafe(out["_k"]), "left").select(key, *wanted)


def _materialized(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def error_rate(log: DataFrame, period: str = "5 minutes", threshold_pct: float = 5.0) -> DataFrame:
    """MON-04: share of 4XX/5XX responses per period, flagged above threshold."""
    code = F.col("metadata").getItem("http_status").try_cast("int")
    g = log.groupBy(F.window("timestamp", period).start.alias("period_start")).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(code >= 400).alias("errors"))
    rate = F.round(F.col("errors") * 100.0 / F.col("requests"), 4)
    return g.withColumn("error_rate_pct", rate).withColumn("alarm", F.col("error_rate_pct") > threshold_pct)


def request_volume(log: DataFrame, period: str = "1 minute") -> DataFrame:
    """MON-05: requests per period."""
    return log.groupBy(F.window("timestamp", period).start.alias("period_start")) \
        .agg(F.count(F.lit(1)).alias("requests"))


def top_errors(log: DataFrame, k: int = 5) -> DataFrame:
    """MON-05: top-k error operations (ties by name)."""
    return log.filter(F.col("status") == "error").groupBy("operation") \
        .agg(F.count(F.lit(1)).alias("errors")).orderBy(F.col("errors").desc(), F.col("operation")).limit(k)


def delivery_lag(bronze: DataFrame, max_seconds: int = 300) -> DataFrame:
    """MON-06: records whose processed_at - event_time exceeds the limit."""
    lag = F.unix_micros("processed_at") - F.unix_micros("event_time")
    return bronze.select("sequence_number", "event_time", "processed_at",
                         (lag / 1e6).alias("lag_seconds")).filter(F.col("lag_seconds") > max_seconds)


def delivery_lag_by_date(bronze: DataFrame, max_seconds: int = 300) -> DataFrame:
    """MON-06: per arrival date the records, the largest lag in seconds and the records above the limit."""
    lag = F.unix_seconds("processed_at") - F.unix_seconds("event_time")
    return bronze.groupBy(F.to_date("processed_at").alias("date")).agg(
        F.count(F.lit(1)).alias("records"), F.max(lag).alias("max_lag_seconds"), F.count_if(lag > max_seconds).alias("late"))


#: Periods of a slice in which runs are counted by one task.
SLICE_PERIODS = 1024


def threshold_alarm(per_period: DataFrame, value_col: str, threshold: float, periods: int,
                    period_seconds: int, key_cols: list[str] | None = None) -> DataFrame:
    """MON-02 + WIN-04: alarm when ``value > threshold`` in N consecutive
    periods; a period with no data is not a breach.

    Gaps and islands over the breaching periods alone: no grid is filled.  A key's
    time is cut into slices of ``SLICE_PERIODS`` periods; islands are found within a
    slice, and one that reaches the end of a slice goes on in the next, by one row a slice.
    Input is one row per (key, period_start), output the same with ``breach``, ``run``
    (breaching periods in a row up to this one) and ``alarm``.
    """
    keys = key_cols or []
    number = F.floor(F.unix_seconds(F.col("period_start").cast("timestamp")) / period_seconds)
    rows = per_period.withColumn("_p", number).withColumn("_s", F.floor(F.col("_p") / SLICE_PERIODS)) \
        .withColumn("breach", F.coalesce((F.col(value_col) > threshold).cast("int"), F.lit(0)))
    inside = Window.partitionBy(*keys, "_s").orderBy("_p")
    # consecutive periods keep their distance to their row number
    island = rows.filter("breach = 1").select(*keys, "_s", "_p").withColumn("_i", F.col("_p") - F.row_number().over(inside)) \
        .withColumn("_start", F.min("_p").over(Window.partitionBy(*keys, "_s", "_i")))
    ends = island.groupBy(*keys, "_s").agg(F.min("_p").alias("_first"), F.max("_p").alias("_last"),
                                          F.max("_start").alias("_tail"), F.count(F.lit(1)).alias("_n"))
    slices = Window.partitionBy(*keys).orderBy("_s") if keys else Window.orderBy("_s")
    joined = F.coalesce(F.lag("_last").over(slices) + 1 == F.col("_first"), F.lit(False))
    whole = F.col("_last") - F.col("_first") + 1 == F.col("_n")
    # where the island at a slice's end began: in the slice, or where the one before it that is whole did
    began = F.when(~(F.col("_joined") & F.col("_whole")), F.col("_tail"))
    before = slices.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_joined", joined).withColumn("_whole", whole).withColumn("_began", began) \
        .withColumn("_from", F.when(F.col("_joined"), F.last("_began", ignorenulls=True).over(before))) \
        .select(*keys, "_s", F.col("_first").alias("_head"), "_from")
    i, c = island.alias("i"), carried.alias("c")
    same = [F.col(f"i.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "_s"]]
    start = F.when((F.col("i._start") == F.col("c._head")) & F.col("c._from").isNotNull(), F.col("c._from")).otherwise(F.col("i._start"))
    runs = i.join(c, same).select(*[F.col(f"i.{k}") for k in keys], F.col("i._p"), (F.col("i._p") - start + 1).alias("run"))
    r, u = rows.alias("r"), runs.alias("u")
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"u.{k}")) for k in [*keys, "_p"]]
    return r.join(u, on, "left").select(*[F.col(f"r.{x}") for x in [*per_period.columns, "breach"]],
                                        F.coalesce(F.col("u.run"), F.lit(0)).alias("run")) \
        .withColumn("alarm", F.col("run") >= periods)


def sliding_active_users(activity: DataFrame, ts_col: str, user_col: str, days: int = 30) -> DataFrame:
    """STR-06, exact: active users of every window of ``days`` days that a day of activity falls into, advanced daily.

    A user seen on a day counts in the windows that end from that day on until
    the user's next day, or until the day leaves the window: one
    arrival and one leave per user and day, summed up along the days.  No row is copied per window.
    """
    seen = activity.select(F.col(user_col).alias("u"), F.to_date(ts_col).alias("d")).filter("u is not null and d is not null").distinct()
    gone = F.least(F.lead("d").over(Window.partitionBy("u").orderBy("d")), F.date_add("d", days))
    moves = seen.select("d", gone.alias("g")).select(F.explode(F.array(
        F.struct(F.col("d").alias("day"), F.lit(1).alias("change")), F.struct(F.col("g").alias("day"), F.lit(-1).alias("change")))).alias("m"))
    # one row a day from here on
    net = moves.groupBy("m.day").agg(F.sum("m.change").alias("change"))
    spans = net.withColumn("active_users", F.sum("change").over(Window.orderBy("day"))) \
        .withColumn("next", F.lead("day").over(Window.orderBy("day")))
    return spans.filter("active_users > 0").select(
        F.explode(F.sequence("day", F.date_sub("next", 1))).alias("last_day"), "active_users") \
        .select(F.date_sub("last_day", days - 1).alias("first_day"), "last_day", "active_users")


def slow_runs(runs: DataFrame, factor: float = 2.0, key_cols: list[str] | None = None) -> DataFrame:
    """WIN-05: a run slower than ``factor`` x the mean of the earlier runs.

    ``runs``: (key..., started_at, duration).  One row per job run - the
    window partitions by job, whose run count is small.
    """
    keys = key_cols or []
    w = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))).orderBy("started_at") \
        .rowsBetween(Window.unboundedPreceding, -1)
    prev = F.avg("duration").over(w)
    return runs.withColumn("prior_avg", prev) \
        .withColumn("slow", F.coalesce(F.col("duration") > F.col("prior_avg") * factor, F.lit(False)))


def layer_growth(inventories: DataFrame) -> DataFrame:
    """MON-07: bytes per layer over successive inventory snapshots
    (snapshot_ts, layer, bytes) with the change since the previous one."""
    w = Window.partitionBy("layer").orderBy("snapshot_ts")
    return inventories.withColumn("growth_bytes", F.col("bytes") - F.lag("bytes").over(w))
