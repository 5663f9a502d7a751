"""Typed views and keyed lookups over the current-state table
(SRC-06, PRJ-11..13, FIL-05, FIL-08..16, PAG-01, SRT-04).

An index of the key-value store is a filter plus a column here, never a
copy.  Single-key lookups are filters that reach the Parquet scan as pushed
predicates; bulk lookups are semi joins against a key list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.dates import epoch_to_ts, parse_iso_date


def get_item(state: DataFrame, pk: str, sk: str) -> DataFrame:
    """SRC-06: point lookup by full key (pushed to the scan)."""
    return state.filter((F.col("PK") == pk) & (F.col("SK") == sk))


def get_items(state: DataFrame, keys: DataFrame) -> DataFrame:
    """SRC-06 bulk form: every item whose (PK, SK) is in ``keys``."""
    return state.join(keys.select("PK", "SK"), ["PK", "SK"], "left_semi")


def with_prefix(state: DataFrame, prefix: str) -> DataFrame:
    """FIL-05: ``begins_with(PK, p)`` (Parquet StringStartsWith pushdown)."""
    return state.filter(F.col("PK").startswith(prefix))


def task_view(state: DataFrame) -> DataFrame:
    """PRJ-11: task response rows.

    id = 2nd part of SK; a missing status reads as pending and a missing
    priority as medium; due_date ISO -> date; epochs -> UTC
    timestamps; completed_at 0/missing -> null.
    """
    t = state.filter(F.col("PK").startswith(K.TASK_PREFIX))
    prio = F.coalesce(F.col("priority"), F.lit("medium")) if "priority" in t.columns else F.lit("medium")
    return t.select(
        K.key_part(F.col("SK"), 1).alias("id"),
        K.strip_prefix(F.col("PK"), K.TASK_PREFIX, anchored=True).alias("user_id"),
        "title", "description",
        F.coalesce(F.col("status"), F.lit("pending")).alias("status"),
        prio.alias("priority"),
        "category",
        parse_iso_date(F.col("due_date")).alias("due_date"),
        epoch_to_ts(F.col("created_at")).alias("created_at"),
        epoch_to_ts(F.col("updated_at")).alias("updated_at"),
        F.when(F.coalesce(F.col("completed_at"), F.lit(0)) != 0, epoch_to_ts(F.col("completed_at")))
         .alias("completed_at"),
        "SK",
    )


def user_view(state: DataFrame) -> DataFrame:
    """PRJ-12: user response rows (id = 2nd part of PK)."""
    u = state.filter(F.col("PK").startswith(K.USER_PREFIX))
    return u.select(K.key_part(F.col("PK"), 1).alias("id"), "email", "name",
                    epoch_to_ts(F.col("created_at")).alias("created_at"),
                    epoch_to_ts(F.col("updated_at")).alias("updated_at"))


def idempotency_view(items: DataFrame) -> DataFrame:
    """PRJ-13: idempotency rows (id = 2nd part of PK), typed."""
    i = items.filter(F.col("PK").startswith(K.IDEMPOTENCY_PREFIX))
    return i.select(K.key_part(F.col("PK"), 1).alias("request_id"), "response_data",
                    "target_task_pk", "target_task_sk",
                    F.col("http_status_code").try_cast("int").alias("http_status_code"),
                    F.col("expiration_timestamp").try_cast("bigint").alias("expiration_timestamp"),
                    epoch_to_ts(F.col("created_at")).alias("created_at"))


# -------------------------------------------------- index lookups ---

def _by_index(state: DataFrame, gsi: str, user_id: str | Column, label: str, value: str) -> DataFrame:
    uid = user_id if isinstance(user_id, Column) else F.lit(user_id)
    return state.filter((F.col(f"{gsi}PK") == F.concat(F.lit(K.USER_PREFIX), uid)) &
                        F.col(f"{gsi}SK").startswith(f"{label}#{value}#"))


def tasks_by_status(state: DataFrame, user_id, status: str) -> DataFrame:
    """FIL-08: GSI1 ``STATUS#s#``."""
    return _by_index(state, "GSI1", user_id, "STATUS", status)


def tasks_by_due_date(state: DataFrame, user_id, due_date: str) -> DataFrame:
    """FIL-09: GSI2 ``DUEDATE#d#``."""
    return _by_index(state, "GSI2", user_id, "DUEDATE", due_date)


def tasks_by_priority(state: DataFrame, user_id, priority: str) -> DataFrame:
    """FIL-10: GSI3 ``PRIORITY#p#``."""
    return _by_index(state, "GSI3", user_id, "PRIORITY", priority)


def tasks_by_category(state: DataFrame, user_id, category: str) -> DataFrame:
    """FIL-11: GSI4 ``CATEGORY#c#``."""
    return _by_index(state, "GSI4", user_id, "CATEGORY", category)


def overdue_tasks(tasks: DataFrame, today: str) -> DataFrame:
    """FIL-12 (the intent): due date before today and not completed."""
    return tasks.filter((F.col("due_date") < F.lit(today).cast("date")) & (F.col("status") != "completed"))


def due_between(tasks: DataFrame, start: str, end: str) -> DataFrame:
    """FIL-13: due date in [start, end], both inclusive."""
    return tasks.filter(F.col("due_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def tasks_of_user(state: DataFrame, user_id: str) -> DataFrame:
    """FIL-14: all tasks of a user, in sort-key order (SRT-04)."""
    return state.filter(F.col("PK") == f"{K.TASK_PREFIX}{user_id}").orderBy("SK")


def with_due_date(tasks: DataFrame) -> DataFrame:
    return tasks.filter(F.col("due_date").isNotNull())


def all_users(state: DataFrame) -> DataFrame:
    """FIL-15: every user item (SK = METADATA under a USER# key)."""
    return state.filter(F.col("PK").startswith(K.USER_PREFIX) & (F.col("SK") == K.METADATA_SK))


def search_tasks(tasks: DataFrame, query: str) -> DataFrame:
    """FIL-16: case-insensitive substring over title and description."""
    q = F.lit(query.lower())
    return tasks.filter(F.lower(F.coalesce(F.col("title"), F.lit(""))).contains(q) |
                        F.lower(F.coalesce(F.col("description"), F.lit(""))).contains(q))


def page(df: DataFrame, key_cols: list[str], size: int, after: tuple | None = None) -> DataFrame:
    """PAG-01: keyset page - rows after the last key, in key order, ``size`` rows.

    The limit is the feature; the plan is a TakeOrderedAndProject (top-k
    per partition, then merge), never a global sort of the table.
    """
    out = df
    if after is not None:
        cond = None
        for i in range(len(key_cols)):
            eq = [F.col(key_cols[j]) == F.lit(after[j]) for j in range(i)]
            term = F.col(key_cols[i]) > F.lit(after[i])
            for e in eq:
                term = term & e
            cond = term if cond is None else (cond | term)
        out = out.filter(cond)
    return out.orderBy(*[F.col(c).asc() for c in key_cols]).limit(size)
