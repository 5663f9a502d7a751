"""Silver -> gold serving tables (AGG-03..06) and the declared extensions
(AGG-15..23, WIN-01).

Every table is one grouped aggregate: partial aggregation runs map-side, so a
hot key (a user owning a third of all tasks) reaches the shuffle as one row
per map task.  Counters are ``count_if`` inside the same aggregate, never
separate scans or driver-side ``count()`` actions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _status_count(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def gold_user_analytics(silver_users: DataFrame) -> DataFrame:
    """AGG-03.  first email/name = those of the earliest silver row."""
    order = F.struct(F.col("created_at"), F.col("updated_at"), F.col("email"), F.col("name"))
    return silver_users.groupBy("user_id").agg(
        F.min_by(F.struct("email", "name"), order).alias("_first"),
        F.min("created_at").alias("first_seen"),
        F.max("updated_at").alias("last_updated"),
        F.sum("event_count").alias("total_events"),
        F.max("event_types").alias("max_event_types"),
    ).select("user_id", "_first.email", "_first.name", "first_seen", "last_updated",
             "total_events", "max_event_types")


def gold_user_metrics(silver_tasks: DataFrame) -> DataFrame:
    """AGG-04: task counts per user."""
    return silver_tasks.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_tasks"),
        _status_count("completed").alias("completed_tasks"),
        _status_count("pending").alias("pending_tasks"),
        _status_count("in_progress").alias("in_progress_tasks"),
        F.min("created_at").alias("first_task_date"),
        F.max("updated_at").alias("last_task_date"),
    )


def gold_category_trends(silver_tasks: DataFrame) -> DataFrame:
    """AGG-05: per category; a null category is its own group."""
    return silver_tasks.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_tasks"),
        _status_count("completed").alias("completed_tasks"),
    )


def gold_kpis(silver_users: DataFrame, silver_tasks: DataFrame) -> DataFrame:
    """AGG-06 as a long (metric, value) table, two aggregates + unpivot.

    total_users counts distinct user ids the way ``distinct().count()`` does:
    a null id counts as one more value.
    """
    u = silver_users.agg(
        (F.count_distinct("user_id") + F.coalesce(F.max(F.col("user_id").isNull().cast("int")), F.lit(0)))
        .cast("bigint").alias("total_users"))
    t = silver_tasks.agg(F.count(F.lit(1)).alias("total_tasks"),
                         _status_count("completed").alias("completed_tasks"))
    users_long = u.select(F.lit("total_users").alias("metric"), F.col("total_users").alias("value"))
    tasks_long = t.select(F.col("total_tasks").cast("bigint"), F.col("completed_tasks").cast("bigint")) \
        .unpivot([], ["total_tasks", "completed_tasks"], "metric", "value")
    return users_long.unionByName(tasks_long)


# ---------------------------------------------------- declared extensions ---

def kpi_overview(user_metrics: DataFrame) -> DataFrame:
    """AGG-15: averages of the per-user counts and the overall completion percent."""
    return user_metrics.agg(
        F.avg("total_tasks").alias("avg_tasks_per_user"),
        F.avg("completed_tasks").alias("avg_completed_per_user"),
        F.round(F.try_divide(F.sum("completed_tasks") * 100.0, F.sum("total_tasks")), 2).alias("completion_percent"),
    )


def extended_user_metrics(silver_tasks: DataFrame) -> DataFrame:
    """AGG-16: per user, counts by status and priority, categories used, rate, score.

    completion_rate = completed / total * 100; productivity_score =
    rate * ln(1 + total).  categories_used counts distinct non-null
    categories exactly (two-level aggregation, no per-user set held).
    """
    per_cat = silver_tasks.groupBy("user_id", "category").agg(
        F.count(F.lit(1)).alias("n"),
        _status_count("completed").alias("c"),
        _status_count("pending").alias("p"),
        _status_count("in_progress").alias("i"),
        F.count_if(F.col("priority") == "high").alias("hi"),
        F.count_if(F.col("priority") == "medium").alias("me"),
        F.count_if(F.col("priority") == "low").alias("lo"),
    )
    out = per_cat.groupBy("user_id").agg(
        F.sum("n").alias("total_tasks"), F.sum("c").alias("completed_tasks"),
        F.sum("p").alias("pending_tasks"), F.sum("i").alias("in_progress_tasks"),
        F.sum("hi").alias("high_priority_tasks"), F.sum("me").alias("medium_priority_tasks"),
        F.sum("lo").alias("low_priority_tasks"),
        F.count("category").alias("categories_used"),
    )
    rate = F.round(F.col("completed_tasks") * 100.0 / F.col("total_tasks"), 4)
    return out.withColumn("completion_rate", rate) \
        .withColumn("productivity_score", F.round(F.col("completion_rate") * F.log1p(F.col("total_tasks")), 4))


def category_trends_by_user(user_metrics: DataFrame, segments: DataFrame) -> DataFrame:
    """AGG-05 where the category is an attribute of the user: the users' task counts (AGG-04) join ``segments``
    (user_id, category), one row a user on both sides, and are summed per category.  No task row is joined."""
    own = user_metrics.select("user_id", "total_tasks", "completed_tasks")
    return own.join(segments, "user_id", "left").groupBy("category").agg(
        F.sum("total_tasks").alias("total_tasks"), F.sum("completed_tasks").alias("completed_tasks"))


def extended_category_trends(tasks_with_completion: DataFrame, segments: DataFrame | None = None) -> DataFrame:
    """AGG-17: per category, + high priority count, avg days to complete, rate.

    Input: task rows with ``status``, ``priority``, ``category``,
    ``created_at`` and ``completed_at`` (epoch seconds).  With ``segments`` (user_id, category) the
    category is the user's: tasks have ``user_id`` and are summed up per user before the join.
    """
    days = F.when(F.col("completed_at").isNotNull(), (F.col("completed_at") - F.col("created_at")) / 86400.0)
    own = tasks_with_completion.groupBy("category" if segments is None else "user_id").agg(
        F.count(F.lit(1)).alias("total"), _status_count("completed").alias("completed"),
        F.count_if(F.col("priority") == "high").alias("high"), F.sum(days).alias("days"), F.count(days).alias("timed"))
    if segments is not None:
        own = own.join(segments, "user_id", "left")
    done = F.sum("completed")
    return own.groupBy("category").agg(
        F.sum("total").alias("total_tasks"), done.alias("completed_tasks"), F.sum("high").alias("high_priority_tasks"),
        F.round(F.try_divide(F.sum("days"), F.sum("timed")), 4).alias("avg_completion_days"),
        F.round(done * 100.0 / F.sum("total"), 4).alias("completion_rate"))


def extended_user_analytics(user_analytics: DataFrame, logins: DataFrame, as_of: str) -> DataFrame:
    """AGG-18: logins, days since last login, engagement level, segment.

    ``logins``: (user_id, login_ts).  engagement: high <= 7 days, medium
    <= 30, low otherwise (and when never seen).  segment by terciles of
    total_events: a user is ``low`` when fewer than a third of all users have
    fewer events, ``medium`` below two thirds, else ``high`` (ties share a
    segment).  The rank runs over the distinct total_events values - one
    row per value, not per user - so no task ever holds all users.
    """
    lg = logins.groupBy("user_id").agg(F.count(F.lit(1)).alias("total_logins"),
                                       F.max("login_ts").alias("last_login"))
    j = user_analytics.join(lg, "user_id", "left")
    days = F.datediff(F.lit(as_of).cast("date"), F.col("last_login").cast("date"))
    level = F.when(days <= 7, "high").when(days <= 30, "medium").otherwise("low")
    per_value = user_analytics.groupBy("total_events").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("total_events").rowsBetween(Window.unboundedPreceding, -1)
    ranks = per_value.select(
        "total_events",
        F.coalesce(F.sum("n").over(w), F.lit(0)).alias("below"),
        F.sum("n").over(Window.partitionBy(F.lit(1))).alias("users"),
    )
    seg = (F.when(F.col("below") * 3 < F.col("users"), "low")
           .when(F.col("below") * 3 < F.col("users") * 2, "medium").otherwise("high"))
    segments = ranks.select("total_events", seg.alias("user_segment"))
    return j.join(segments, "total_events", "left").select(
        "user_id", "total_events",
        F.coalesce(F.col("total_logins"), F.lit(0)).alias("total_logins"),
        days.alias("days_since_last_login"),
        level.alias("engagement_level"),
        "user_segment",
    )


def daily_active_users(activity: DataFrame, ts_col: str = "ts", user_col: str = "user_id",
                       approximate: bool = False) -> DataFrame:
    """AGG-19: distinct users per date (exact by default)."""
    d = F.to_date(F.col(ts_col)).alias("date")
    if approximate:
        return activity.groupBy(d).agg(F.approx_count_distinct(user_col).alias("active_users"))
    # exact distinct per date: dedupe (date, user) first - a two-level
    # aggregation that partial-aggregates and never holds a set per date.
    pairs = activity.select(d, F.col(user_col).alias("u")).filter(F.col("u").isNotNull()).distinct()
    return pairs.groupBy("date").agg(F.count(F.lit(1)).alias("active_users"))


def completion_trend(tasks: DataFrame) -> DataFrame:
    """AGG-20: completed tasks per completion date (epoch completed_at)."""
    d = F.timestamp_seconds(F.col("completed_at")).cast("date").alias("date")
    return tasks.filter(F.col("completed_at").isNotNull()).groupBy(d) \
        .agg(F.count(F.lit(1)).alias("completed_tasks"))


def tasks_per_user_day(tasks: DataFrame) -> DataFrame:
    """AGG-21: tasks created per (user, date)."""
    d = F.timestamp_seconds(F.col("created_at")).cast("date").alias("date")
    return tasks.groupBy("user_id", d).agg(F.count(F.lit(1)).alias("tasks"))


def count_by(tasks: DataFrame, column: str) -> DataFrame:
    """AGG-22: per-value count of one column (status, priority, ...)."""
    return tasks.groupBy(column).agg(F.count(F.lit(1)).alias("tasks"))


def entity_census(state: DataFrame, pk_col: str = "PK") -> DataFrame:
    """AGG-23: item count per entity type (key prefix)."""
    from ..functions.keys import entity_type
    return state.groupBy(entity_type(F.col(pk_col)).alias("entity_type")).agg(F.count(F.lit(1)).alias("items"))


def user_growth(silver_users: DataFrame) -> DataFrame:
    """WIN-01: new users per date and the running total.

    The running window has no partition key, but it runs on the daily
    aggregate (one row per date), which stays tiny at any data size.
    """
    daily = silver_users.groupBy(F.col("created_date").alias("date")).agg(
        F.count(F.lit(1)).alias("new_users"))
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("total_users", F.sum("new_users").over(w))
