"""Business metrics over the current-state table (SRC-04, FIL-06/07,
AGG-10..12, JOIN-08, SET-02, SNK-05 shape).

The collector ran ten separate count scans; here every count is a
``count_if`` arm of ONE aggregate over one scan, and the ratios are computed
from that single row.  The result is the long metric table
(namespace, metric, value, unit, ts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.dates import iso_ts

NAMESPACE = "App/CustomMetrics"
ACTIVE_DAYS = 30

# Metric names and units as emitted, in emission order.
USER_METRICS = [("TotalUsers", "Count"), ("ActiveUsers", "Count"), ("VerifiedUsers", "Count"),
                ("UserVerificationRate", "Percent")]
TASK_METRICS = [("TotalTasks", "Count"), ("CompletedTasks", "Count"), ("PendingTasks", "Count"),
                ("InProgressTasks", "Count"), ("HighPriorityTasks", "Count"), ("TaskCompletionRate", "Percent")]
SYSTEM_METRICS = [("TableSizeBytes", "Bytes"), ("TotalItems", "Count"), ("AverageTasksPerUser", "Count")]


def _pct(num: Column, den: Column) -> Column:
    # guarded division: 0 when there is no denominator (FIL-17 style)
    return F.when(den > 0, num.cast("double") / den * 100).otherwise(F.lit(0.0))


def metric_counts(state: DataFrame, now: Column) -> DataFrame:
    """One aggregate row with every count the three collectors need.

    FIL-07 equality flags are ``count_if`` arms.  FIL-06 active users:
    last_login > (now - 30 days), compared as ISO text the way
    the store compares strings; a missing last_login is not active.
    """
    is_user = F.col("PK").startswith(K.USER_PREFIX)
    is_task = F.col("PK").startswith(K.TASK_PREFIX)
    cutoff = iso_ts(now - F.expr(f"INTERVAL {ACTIVE_DAYS} DAYS"))
    return state.agg(
        F.count_if(is_user).alias("users"),
        F.count_if(is_user & (F.col("last_login") > cutoff)).alias("active_users"),
        F.count_if(is_user & (F.col("verification_status") == "verified")).alias("verified_users"),
        F.count_if(is_task).alias("tasks"),
        F.count_if(is_task & (F.col("status") == "completed")).alias("completed"),
        F.count_if(is_task & (F.col("status") == "pending")).alias("pending"),
        F.count_if(is_task & (F.col("status") == "in_progress")).alias("in_progress"),
        F.count_if(is_task & (F.col("priority") == "high")).alias("high_priority"),
        F.count(F.lit(1)).alias("items"),
    )


def collect_metrics(state: DataFrame, now: Column, table_size_bytes: Column | None = None,
                    namespace: str = NAMESPACE) -> DataFrame:
    """AGG-10 + AGG-11 + AGG-12 as one long table (SET-02: the three lists
    concatenated), from one scan.  TableSizeBytes comes from a layer
    inventory (SRC-08); without one there is no such metric."""
    c = metric_counts(state, now)
    values = {
        "TotalUsers": F.col("users"),
        "ActiveUsers": F.col("active_users"),
        "VerifiedUsers": F.col("verified_users"),
        "UserVerificationRate": _pct(F.col("verified_users"), F.col("users")),
        "TotalTasks": F.col("tasks"),
        "CompletedTasks": F.col("completed"),
        "PendingTasks": F.col("pending"),
        "InProgressTasks": F.col("in_progress"),
        "HighPriorityTasks": F.col("high_priority"),
        "TaskCompletionRate": _pct(F.col("completed"), F.col("tasks")),
        "TotalItems": F.col("items"),
        # JOIN-08: scalar combine of two counts inside the same row
        "AverageTasksPerUser": F.when(F.col("users") > 0, F.col("tasks") / F.col("users")).otherwise(F.lit(0.0)),
    }
    if table_size_bytes is not None:
        values["TableSizeBytes"] = table_size_bytes
    units = dict(USER_METRICS + TASK_METRICS + SYSTEM_METRICS)
    order = [m for m, _ in USER_METRICS + TASK_METRICS + SYSTEM_METRICS if m in values]
    wide = c.select(*[values[m].cast("double").alias(m) for m in order])
    long = wide.unpivot([], order, "metric", "value")
    unit = F.element_at(F.create_map(*[x for m in order for x in (F.lit(m), F.lit(units[m]))]), F.col("metric"))
    return long.select(F.lit(namespace).alias("namespace"), "metric",
                       F.round("value", 6).alias("value"), unit.alias("unit"),
                       now.cast("timestamp").alias("ts"))
