"""Lazy bronze -> silver -> gold plans over the given tables.

``event_model`` runs the full change path (tagged change records decoded
into envelopes, then silver and gold); ``state_model`` starts from the
customer/orders current-state table, the at-scale model.  Nothing is
materialized here: callers either run a query on the gold frames or hand
them to the writers in ``tessera.sinks``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc, gold, silver
from ..sources import fixtures


@dataclass
class Gold:
    bronze: DataFrame | None
    silver_users: DataFrame
    silver_tasks: DataFrame
    user_analytics: DataFrame
    user_metrics: DataFrame
    category_trends: DataFrame
    kpis: DataFrame
    # task rows carrying their category, for consumers that read it (when
    # the plain task table leaves category out to skip a join)
    silver_tasks_with_category: DataFrame | None = None

    def tasks_with_category(self) -> DataFrame:
        return self.silver_tasks_with_category if self.silver_tasks_with_category is not None else self.silver_tasks


def gold_from_silver(bronze, silver_users: DataFrame, silver_tasks: DataFrame) -> Gold:
    return Gold(
        bronze=bronze,
        silver_users=silver_users,
        silver_tasks=silver_tasks,
        user_analytics=gold.gold_user_analytics(silver_users),
        user_metrics=gold.gold_user_metrics(silver_tasks),
        category_trends=gold.gold_category_trends(silver_tasks),
        kpis=gold.gold_kpis(silver_users, silver_tasks),
    )


def gold_from_bronze(bronze: DataFrame, latest: bool = False, shared: bool = False) -> Gold:
    """Gold frames over one users+tasks aggregate of ``bronze``.

    ``shared=True`` is for queries that read BOTH users and tasks: the
    optimizer prunes each branch's unused aggregate columns, which makes the
    two branches different plans (two scans, two shuffles).  The aggregate
    is then written once as a Parquet table under the shared checkpoint
    folder (``spark.checkpoint.dir``) and both branches read it back: one
    computation, durable across executor loss, lineage cut.
    """
    ent = silver.silver_entities(bronze, latest)
    if shared:
        ent = materialize(ent, "silver-entities")
    return gold_from_silver(bronze, silver.users_of(ent), silver.tasks_of(ent))


def event_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    # arrival pinned to the event time, so that results don't depend on the clock
    return cdc.changes_to_bronze(fixtures.event_changes(spark, sf_dir), now=F.col("eventTime"))


def event_model(spark: SparkSession, sf_dir: str, latest: bool = False, shared: bool = False) -> Gold:
    return gold_from_bronze(event_bronze(spark, sf_dir), latest, shared)


def state_model(spark: SparkSession, sf_dir: str) -> Gold:
    """Gold over the customer/orders current state.

    Users come from ``customer`` alone and tasks from ``orders`` alone; the
    customer segment (the task category) meets the task counts per user in
    category trends; only the table of tasks with their category pays an
    orders x customer shuffle join, and only for the query that reads it.
    """
    customer = fixtures.read_table(spark, sf_dir, "customer")
    orders = fixtures.read_table(spark, sf_dir, "orders")
    users, _ = silver.silver_from_state(_as_state(fixtures.customer_users(customer)))
    _, tasks = silver.silver_from_state(_as_state(fixtures.order_tasks(orders, None)))
    _, tasks_cat = silver.silver_from_state(_as_state(fixtures.order_tasks(orders, customer)))
    g = gold_from_silver(None, users, tasks)
    g.category_trends = gold.category_trends_by_user(g.user_metrics, customer.select(
        F.col("c_custkey").cast("string").alias("user_id"), F.col("c_mktsegment").alias("category")))
    g.silver_tasks_with_category = tasks_cat
    return g


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back."""
    import uuid
    from ..session import work_path
    path = work_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _as_state(items: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F
    from ..schemas import ITEM
    return items.select(*[F.col(f.name).cast(f.dataType) if f.name in items.columns
                          else F.lit(None).cast(f.dataType).alias(f.name) for f in ITEM.fields])
