"""Map the given test tables onto the change-data model.

* ``events`` becomes a change stream: signup -> user INSERT; view -> task
  INSERT (pending); click -> task MODIFY (in_progress); purchase -> task
  MODIFY (completed); error -> task REMOVE.  sequence = event_id,
  eventTime = ts.
* ``customer`` / ``orders`` become a current-state table at scale: one user
  item per customer, one task item per order; they can also be replayed as
  INSERT changes.

All of it is column expressions over the scans, so it grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ..functions import keys as K
from ..functions.dates import iso_date, iso_ts, ts_to_epoch
from ..functions.decode import encode_item, tag_n, tag_s
from ..schemas import ITEM

# ------------------------------------------------------------ fixed values ---
# event_type -> (change kind, entity, task status written by the change)
EVENT_KIND = {
    "signup": ("INSERT", "USER", None),
    "view": ("INSERT", "TASK", "pending"),
    "click": ("MODIFY", "TASK", "in_progress"),
    "purchase": ("MODIFY", "TASK", "completed"),
    "error": ("REMOVE", "TASK", None),
}
# k % 4 -> priority; k % 3 -> verification status (users)
PRIORITIES = ["low", "medium", "high", "urgent"]
VERIFICATION = ["verified", "pending", "rejected"]
# tasks per user in the event model: task_id = user_id * 100 + k % 20
TASKS_PER_USER = 20
# order status -> task status; order priority -> task priority (4 -> null)
ORDER_STATUS = {"F": "completed", "O": "pending", "P": "in_progress"}
ORDER_PRIORITY = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}
# first due date of the event model; due dates step 3 days with k % 20
DUE_BASE = "2024-01-01"
# base of user created_at in the customer model (epoch of 1995-01-01)
CUSTOMER_EPOCH_BASE = 788918400
TABLE_NAME = "app-data"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one given table; wall-clock (NTZ) timestamps are read as UTC."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    ntz = {f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)}
    if ntz:
        df = df.select(*[F.col(c).cast("timestamp").alias(c) if c in ntz else F.col(c) for c in df.columns])
    return df


_table = read_table


def _case(c: Column, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def _pick(idx: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def event_items(events: DataFrame) -> DataFrame:
    """Typed item per event (ITEM columns) plus change kind, order and time.

    Built in stages so each derived value is computed once per row (the
    optimizer keeps a projection boundary for non-trivial expressions that
    are used more than once).
    """
    e = events.select(
        "event_id", "ts", "user_id", "event_type",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
    )
    e = e.select(
        "*",
        _case(F.col("event_type"), {t: v[0] for t, v in EVENT_KIND.items()}).alias("eventName"),
        _case(F.col("event_type"), {t: v[1] for t, v in EVENT_KIND.items()}).alias("entity"),
        _case(F.col("event_type"), {t: v[2] for t, v in EVENT_KIND.items() if v[2]}).alias("_status"),
        F.pmod(F.col("k"), F.lit(TASKS_PER_USER)).alias("_slot"),
        ts_to_epoch(F.col("ts")).alias("_epoch"),
        F.col("user_id").cast("string").alias("_uid"),
    )
    e = e.select(
        "*",
        (F.col("user_id") * 100 + F.col("_slot")).alias("_task_id"),
        _pick(F.pmod(F.col("k"), F.lit(4)), PRIORITIES).alias("_priority"),
        F.when(F.pmod(F.col("k"), F.lit(5)) != 4,
               F.concat(F.lit("cat"), F.pmod(F.col("k"), F.lit(5)).cast("string"))).alias("_category"),
        iso_date(F.date_add(F.lit(DUE_BASE).cast("date"), (F.col("_slot") * 3).cast("int"))).alias("_due"),
    )
    is_user = F.col("entity") == "USER"
    is_task = ~is_user
    tk = K.task_keys(F.col("user_id"), F.col("_task_id"), F.col("_status"), F.col("_priority"),
                     F.col("_category"), F.col("_due"))
    slot = F.col("_slot").cast("string")
    uid = F.col("_uid")
    cols = {
        "PK": F.when(is_user, F.concat(F.lit(K.USER_PREFIX), uid)).otherwise(tk["PK"]),
        "SK": F.when(is_user, F.lit(K.METADATA_SK)).otherwise(tk["SK"]),
    }
    for gk in ["GSI1PK", "GSI1SK", "GSI2PK", "GSI2SK", "GSI3PK", "GSI3SK", "GSI4PK", "GSI4SK"]:
        cols[gk] = F.when(is_task, tk[gk])
    cols.update({
        "title": F.when(is_task, F.concat(F.lit("Task "), slot)),
        "description": F.when(is_task, F.concat(F.lit("Task "), slot, F.lit(" of user "), uid)),
        "status": F.when(is_task, F.col("_status")),
        "priority": F.when(is_task, F.col("_priority")),
        "category": F.when(is_task, F.col("_category")),
        "due_date": F.when(is_task, F.col("_due")),
        "created_at": F.col("_epoch"),
        "updated_at": F.col("_epoch"),
        "completed_at": F.when(F.col("event_type") == "purchase", F.col("_epoch")),
        "email": F.when(is_user, F.concat(F.lit("user"), uid, F.lit("@example.com"))),
        "name": F.when(is_user, F.concat(F.lit("User "), uid)),
        "last_login": F.when(is_user, iso_ts(F.col("ts"))),
        "verification_status": F.when(is_user, _pick(F.pmod(F.col("k"), F.lit(3)), VERIFICATION)),
    })
    return e.select(
        "eventName", "entity",
        F.col("event_id").cast("string").alias("SequenceNumber"),
        F.col("ts").alias("eventTime"),
        *[c.cast(ITEM[n].dataType).alias(n) for n, c in cols.items()],
    )


_NUMERIC = {"created_at", "updated_at", "completed_at"}
_USER_ATTRS = {"PK", "SK", "email", "name", "created_at", "updated_at", "last_login", "verification_status"}
_TASK_ATTRS = {f.name for f in ITEM.fields} - {"email", "name", "last_login", "verification_status"}


def items_to_changes(items: DataFrame) -> DataFrame:
    """CHANGE_RECORD rows for typed items, behaving like a file source."""
    return as_source(_changes_of(items))


def _changes_of(items: DataFrame) -> DataFrame:
    """Typed items (+ eventName, entity, SequenceNumber, eventTime) -> CHANGE_RECORD rows.

    Users carry only user attributes and tasks only task attributes, as the
    repositories write them (an attribute that does not apply is absent, an
    applicable one that is None is stored as NULL); REMOVE carries only the
    old image.  One image expression per row: inapplicable attributes are
    null structs, which the JSON writer drops.
    """
    is_user = F.col("entity") == "USER"
    parts = {}
    for f in ITEM.fields:
        tagged = tag_n(F.col(f.name)) if f.name in _NUMERIC else tag_s(F.col(f.name))
        in_user, in_task = f.name in _USER_ATTRS, f.name in _TASK_ATTRS
        if in_user and in_task:
            parts[f.name] = tagged
        elif in_user:
            parts[f.name] = F.when(is_user, tagged)
        else:
            parts[f.name] = F.when(~is_user, tagged)
    staged = items.select(
        "eventName", "eventTime", "SequenceNumber",
        encode_item(parts).alias("_img"),
        encode_item({"PK": tag_s(F.col("PK")), "SK": tag_s(F.col("SK"))}).alias("_keys"),
    )
    removed = F.col("eventName") == "REMOVE"
    return staged.select(
        F.col("eventName"),
        F.col("eventTime"),
        F.struct(
            F.col("SequenceNumber"),
            F.col("_keys").alias("Keys"),
            F.when(~removed, F.col("_img")).alias("NewImage"),
            F.when(removed, F.col("_img")).alias("OldImage"),
        ).alias("dynamodb"),
    )


def as_source(df: DataFrame) -> DataFrame:
    """Make generated change records behave like records read from files.

    The images here are expressions, not columns; a filter pushed below
    them would re-expand the whole image construction once per reference.
    A 1-row generator per record is a boundary the optimizer does not push
    filters through, so downstream operators see the images as plain input
    columns - exactly what a JSON change source gives them.
    """
    packed = F.array(F.struct(*[F.col(c) for c in df.columns]))
    return df.select(F.explode(packed).alias("_rec")).select("_rec.*")


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change stream derived from ``events`` (CHANGE_RECORD shape)."""
    events = _table(spark, sf_dir, "events")
    # dealt by id into a stated number of partitions, which AQE doesn't merge: the images are built on all cores
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return items_to_changes(event_items(events.repartition(n, "event_id")))


# ------------------------------------------------------------ scale model ---

def customer_users(customer: DataFrame) -> DataFrame:
    uid = F.col("c_custkey").cast("string")
    created = F.lit(CUSTOMER_EPOCH_BASE).cast("bigint") + F.col("c_custkey")
    return customer.select(
        F.concat(F.lit(K.USER_PREFIX), uid).alias("PK"),
        F.lit(K.METADATA_SK).alias("SK"),
        F.concat(F.lit("customer"), uid, F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("name"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.when(F.col("c_acctbal") >= 0, F.lit("verified")).otherwise(F.lit("pending")).alias("verification_status"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_custkey").alias("user_key"),
    )


def order_tasks(orders: DataFrame, customer: DataFrame | None) -> DataFrame:
    """One task item per order; category = the customer's market segment.

    The segment comes from an equi-join on custkey.  Both sides grow with
    the data, so no broadcast is forced: AQE turns it into a broadcast only
    when the customer side is measured small at runtime.  ``customer=None``
    leaves the category null and skips the join (for consumers that do not
    read it).
    """
    if customer is None:
        o = orders.withColumn("c_mktsegment", F.lit(None).cast("string"))
    else:
        seg = customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment"))
        o = orders.join(seg, "o_custkey", "left")
    status = _case(F.col("o_orderstatus"), ORDER_STATUS)
    priority = _case(F.col("o_orderpriority"), ORDER_PRIORITY)
    created = ts_to_epoch(F.col("o_orderdate"))
    completed = F.when(status == "completed", created + (F.pmod(F.col("o_orderkey"), F.lit(14)) + 1) * 86400)
    tk = K.task_keys(F.col("o_custkey"), F.col("o_orderkey"), status, priority, F.col("c_mktsegment"), F.lit(None).cast("string"))
    return o.select(
        *[tk[n].alias(n) for n in ["PK", "SK", "GSI1PK", "GSI1SK", "GSI2PK", "GSI2SK", "GSI3PK", "GSI3SK", "GSI4PK", "GSI4SK"]],
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("description"),
        status.alias("status"),
        priority.alias("priority"),
        F.col("c_mktsegment").alias("category"),
        F.lit(None).cast("string").alias("due_date"),
        created.alias("created_at"),
        created.alias("updated_at"),
        completed.cast("bigint").alias("completed_at"),
        F.col("o_orderkey").alias("task_key"),
        F.col("o_custkey").alias("user_key"),
        F.col("o_orderdate").alias("event_time"),
    )


def state_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of the single table (ITEM columns) from customer + orders."""
    customer = _table(spark, sf_dir, "customer")
    orders = _table(spark, sf_dir, "orders")
    users = customer_users(customer)
    tasks = order_tasks(orders, customer)
    both = users.unionByName(tasks, allowMissingColumns=True)
    return both.select(*[F.col(f.name).cast(f.dataType) if f.name in both.columns
                         else F.lit(None).cast(f.dataType).alias(f.name) for f in ITEM.fields])
