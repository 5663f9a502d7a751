"""Bronze envelopes -> silver tables (PRJ-04..10, FIL-03..04, AGG-01..02).

The raw layer is read once; the three silver outputs are derived from that
one DataFrame.  "first" is made deterministic: the value of the earliest
change by (processed_at, numeric sequence number); ``latest=True`` takes the
last change instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.dates import change_order, date_parts, date_parts_epoch
from ..schemas import INDEX_KEYS


def with_entity_type(bronze: DataFrame) -> DataFrame:
    return bronze.withColumn("entity_type", K.entity_type(F.col("data.PK")))


def silver_cdc(bronze: DataFrame) -> DataFrame:
    """Flat change rows for INSERT/MODIFY (PRJ-05/06/09, FIL-03)."""
    df = with_entity_type(bronze.filter(F.col("event_name").isin("INSERT", "MODIFY")))
    user_id, task_id = K.derive_ids(F.col("data.PK"), F.col("data.SK"), F.col("entity_type"))
    out = df.select(
        "event_name", "event_time", "sequence_number", "table_name", "processed_at", "partition_key",
        F.col("data.PK").alias("primary_key"),
        F.col("data.SK").alias("sort_key"),
        *[F.col(f"data.{k}").alias(k[:4].lower() + "_" + k[4:].lower()) for k in INDEX_KEYS],
        "entity_type",
        user_id.alias("user_id"),
        task_id.alias("task_id"),
        *[F.col(f"data.{c}").alias(c) for c in
          ["title", "description", "status", "priority", "category", "created_at", "updated_at", "email", "name"]],
    )
    return date_parts(out, "processed_at")


def _pick(cols: list[str], latest: bool) -> list:
    order = change_order(F.col("processed_at"), F.col("sequence_number"))
    packed = F.struct(*[F.col(c) for c in cols])
    chosen = F.max_by(packed, order) if latest else F.min_by(packed, order)
    return [chosen.alias("_first")]


def _distinct_events() -> F.Column:
    # Change kinds are a closed domain (INSERT/MODIFY/REMOVE), so the set per
    # key holds at most a few values however large the group is; it is built
    # map-side and merged, one shuffle, no second distinct stage.
    return F.size(F.collect_set("event_name")).cast("bigint")


TASK_ATTRS = ["user_id", "title", "description", "status", "priority", "category"]
_FIRST = ["user_id", "email", "name", "title", "description", "status", "priority", "category"]


def _entity_rows(bronze: DataFrame) -> DataFrame:
    """User and task rows of the raw layer with their key and the attributes that silver keeps."""
    et = K.entity_type(F.col("data.PK"))
    return bronze.select(
        et.alias("entity_type"),
        F.when(et == "USER", K.strip_prefix(F.col("data.PK"), K.USER_PREFIX))
         .otherwise(K.strip_prefix(F.col("data.SK"), K.TASK_PREFIX)).alias("entity_id"),
        F.when(et == "TASK", K.strip_prefix(F.col("data.PK"), K.TASK_PREFIX))
         .otherwise(K.strip_prefix(F.col("data.PK"), K.USER_PREFIX)).alias("user_id"),
        *[F.col(f"data.{c}").alias(c) for c in _FIRST[1:]],
        F.col("data.created_at").alias("created_at"),
        F.col("data.updated_at").alias("updated_at"),
        "processed_at", "sequence_number", "event_name",
    ).filter(F.col("entity_type").isin("USER", "TASK"))


def silver_entities(bronze: DataFrame, latest: bool = False) -> DataFrame:
    """Users and tasks aggregated in ONE pass over the raw layer.

    Key = (entity_type, id): id is the user id for USER rows (PK without
    ``USER#``) and the task id for TASK rows (SK without ``TASK#``).  Both
    silver tables are views of this one aggregate, so a query that needs
    both shares a single scan and a single shuffle (the exchange is reused).
    """
    return _entity_rows(bronze).groupBy("entity_type", "entity_id").agg(
        *_pick(_FIRST, latest),
        F.min("created_at").alias("created_at"),
        F.max("updated_at").alias("updated_at"),
        F.count(F.lit(1)).alias("event_count"),
        _distinct_events().alias("event_types"),
    )


# ------------------------------------------------ mergeable state (SNK-11) ---
ENTITY_KEYS = ["entity_type", "entity_id"]


def entity_partials(bronze: DataFrame) -> DataFrame:
    """What silver must know of each entity to take further changes without its old ones.

    The earliest and the latest attributes with their order keys, the bounds of
    the times, the number of changes and the kinds of changes met.  Partials
    of any split of the changes, in any order, merge to the partials of all.
    """
    order = change_order(F.col("processed_at"), F.col("sequence_number"))
    held = F.struct(order.alias("at"), F.struct(*[F.col(c) for c in _FIRST]).alias("attrs"))
    return _entity_rows(bronze).groupBy(*ENTITY_KEYS).agg(
        F.min(held).alias("earliest"), F.max(held).alias("latest"),
        F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"),
        F.count(F.lit(1)).alias("event_count"), F.array_sort(F.collect_set("event_name")).alias("event_names"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """One partial per entity out of several: the same aggregates over the aggregates."""
    return partials.groupBy(*ENTITY_KEYS).agg(
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"),
        F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"),
        F.sum("event_count").alias("event_count"),
        # a list a delivery, of at most the few kinds of changes
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("event_names")))).alias("event_names"))


def entities_of_partials(partials: DataFrame, latest: bool = False) -> DataFrame:
    """The shape of ``silver_entities`` from merged partials: a projection, no shuffle."""
    return partials.select(*ENTITY_KEYS, F.col("latest.attrs" if latest else "earliest.attrs").alias("_first"),
                           "created_at", "updated_at", "event_count", F.size("event_names").cast("bigint").alias("event_types"))


def _entity(entities: DataFrame, kind: str) -> DataFrame:
    # a plain filter on the grouping key: it is pushed below the aggregate, so
    # a plan of one entity never shuffles the other's rows; a plan of both
    # reads the aggregate from a table (model.gold_from_bronze)
    return entities.filter(F.col("entity_type") == kind)


def users_of(entities: DataFrame) -> DataFrame:
    u = _entity(entities, "USER").select(
        F.col("entity_id").alias("user_id"), "_first.email", "_first.name",
        "created_at", "updated_at", "event_count", "event_types")
    return date_parts_epoch(u, "created_at")


def tasks_of(entities: DataFrame) -> DataFrame:
    t = _entity(entities, "TASK").select(
        F.col("entity_id").alias("task_id"), *[f"_first.{c}" for c in TASK_ATTRS],
        "created_at", "updated_at", "event_count", "event_types")
    return date_parts_epoch(t, "created_at")


def silver_users(bronze: DataFrame, latest: bool = False) -> DataFrame:
    """One row per user_id (AGG-01) with created_date / year / month / day."""
    return users_of(silver_entities(bronze, latest))


def silver_tasks(bronze: DataFrame, latest: bool = False) -> DataFrame:
    """One row per task_id (AGG-02) with created_date / year / month / day."""
    return tasks_of(silver_entities(bronze, latest))


def silver_from_state(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Silver users / tasks straight from a current-state table (one row per key).

    Equivalent to replaying the state as one INSERT per item, without the
    aggregation: each key already has exactly one row.
    """
    et = K.entity_type(F.col("PK"))
    users = state.filter(et == "USER").select(
        K.strip_prefix(F.col("PK"), K.USER_PREFIX).alias("user_id"), "email", "name",
        "created_at", "updated_at",
        F.lit(1).cast("bigint").alias("event_count"), F.lit(1).cast("bigint").alias("event_types"))
    tasks = state.filter(et == "TASK").select(
        K.strip_prefix(F.col("SK"), K.TASK_PREFIX).alias("task_id"),
        K.strip_prefix(F.col("PK"), K.TASK_PREFIX).alias("user_id"),
        *TASK_ATTRS[1:], "created_at", "updated_at",
        F.lit(1).cast("bigint").alias("event_count"), F.lit(1).cast("bigint").alias("event_types"))
    return date_parts_epoch(users, "created_at"), date_parts_epoch(tasks, "created_at")
