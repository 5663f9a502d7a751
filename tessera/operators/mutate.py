"""Table mutations as set-based batch operators (MUT-01..10, JOIN-04..07,
WIN-02/03).

The reference applies one request at a time against a key-value store; here
a whole batch of requests is applied with joins and aggregates.  Plain
Parquet has no MERGE, so every mutation returns the new version of the
table (old rows anti-joined away + new rows), written to a new version
directory by the caller.

Skew: "latest per key" uses ``max_by`` (partial aggregation) instead of a
``row_number`` window, so a key holding a third of all rows is folded
map-side and never sorted inside one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import keys as K
from ..functions.dates import change_order
from ..schemas import ITEM
from ..session import work_path

ITEM_COLS = [f.name for f in ITEM.fields]
TERMINAL_STATUS = "completed"
IDEMPOTENCY_TTL_SECONDS = 86400


# ------------------------------------------------------------ state ---

def current_state(bronze_all: DataFrame) -> DataFrame:
    """Apply a change log to state (WIN-02 / MUT-08).

    Input: envelopes including REMOVE rows (``event_name``, ``data``,
    ``processed_at``, ``sequence_number``).  Output: the last image per
    (PK, SK), with keys whose last change is a REMOVE dropped.  Order is by
    (processed_at, numeric sequence), never by arrival in the file.
    """
    order = change_order(F.col("processed_at"), F.col("sequence_number"))
    last = bronze_all.groupBy(F.col("data.PK").alias("_pk"), F.col("data.SK").alias("_sk")).agg(
        F.max_by(F.struct(F.col("event_name").alias("event_name"), F.col("data").alias("data")), order).alias("_last"))
    alive = last.filter(~F.col("_last.event_name").eqNullSafe("REMOVE"))
    return alive.select(*[F.col(f"_last.data.{c}").alias(c) for c in ITEM_COLS])


def changes_with_removes(changes: DataFrame, now: Column | None = None) -> DataFrame:
    """Envelopes for every change that doesn't fail, REMOVE included (its image is the old one)."""
    from .cdc import classify, to_envelope
    c = classify(changes)
    return to_envelope(c.filter(F.col("_image").isNotNull() & F.col("_error").isNull()), now=now)


# ------------------------------------------------------------- puts ---

def put_items(state: DataFrame, items: DataFrame, now_epoch: Column | None = None) -> DataFrame:
    """MUT-01: put full items; the last put of a key wins; created_at =
    updated_at = now when ``now_epoch`` is given.  ``items`` carries ITEM
    columns plus ``seq`` (order of the puts within the batch)."""
    if now_epoch is not None:
        items = items.withColumn("created_at", now_epoch).withColumn("updated_at", now_epoch)
    latest = items.groupBy("PK", "SK").agg(
        F.max_by(F.struct(*[F.col(c) for c in ITEM_COLS]), F.col("seq")).alias("_i")) \
        .select(*[F.col(f"_i.{c}").alias(c) for c in ITEM_COLS])
    kept = state.join(latest.select("PK", "SK"), ["PK", "SK"], "left_anti")
    return kept.unionByName(latest)


def create_users_if_absent(users: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MUT-02 / JOIN-05: ``seen`` (user_id, email, name, ts_epoch) from
    requests; users not yet present are created (first sighting wins).
    Returns (new user table, created rows)."""
    first = seen.groupBy("user_id").agg(
        F.min_by(F.struct("email", "name", "ts_epoch"), F.struct("ts_epoch", "email")).alias("_f"))
    fresh = first.join(users.select("user_id"), "user_id", "left_anti").select(
        "user_id", F.col("_f.email").alias("email"), F.col("_f.name").alias("name"),
        F.col("_f.ts_epoch").alias("created_at"), F.col("_f.ts_epoch").alias("updated_at"))
    return users.unionByName(fresh, allowMissingColumns=True), fresh


def reject_duplicate_users(users: DataFrame, creates: DataFrame) -> DataFrame:
    """MUT-02 explicit create: requests for an id that already exists."""
    return creates.join(users.select("user_id"), "user_id", "left_semi")


# ---------------------------------------------------------- updates ---

UPDATABLE = ["title", "description", "status", "priority", "category", "due_date"]


def update_tasks(tasks: DataFrame, updates: DataFrame, now_epoch: Column,
                 key: tuple[str, str] = ("user_id", "task_id")) -> tuple[DataFrame, DataFrame, DataFrame]:
    """MUT-03 + MUT-05: partial task updates.

    Only non-null fields change; updated_at = now.  An update of a missing
    key is reported (not found); an update that moves a task away from
    ``completed`` is rejected whole, also if an earlier update of the batch
    completed it.  Several updates of one key apply in ``seq`` order: fields
    coalesce from the latest non-null value.  Returns (new table, not found,
    rejected).
    """
    k = list(key)
    current = tasks.select(*k, F.col("status").alias("_cur_status"), F.lit(True).alias("_found"))
    # setting ``completed`` is always allowed, so from the first such update of
    # a key on, as from a completed start, every other status is illegal
    done = updates.filter(F.col("status") == TERMINAL_STATUS).groupBy(*k).agg(F.min("seq").alias("_done_seq"))
    u = updates.join(current, k, "left").join(done, k, "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    terminal = F.coalesce(F.col("_cur_status") == TERMINAL_STATUS, F.lit(False)) | \
        F.coalesce(F.col("seq") > F.col("_done_seq"), F.lit(False))
    illegal = terminal & F.coalesce(F.col("status") != TERMINAL_STATUS, F.lit(False))
    helpers = ["_cur_status", "_found", "_done_seq"]
    not_found = u.filter(~found).drop(*helpers)
    rejected = u.filter(found & illegal).drop(*helpers)
    ok = u.filter(found & ~illegal)
    # latest non-null value per field across the accepted updates of a key
    folded = ok.groupBy(*k).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in UPDATABLE if c in ok.columns
    ])
    present = [c for c in UPDATABLE if c in folded.columns]
    joined = tasks.join(folded.select(*k, *[F.col(c).alias(f"_u_{c}") for c in present],
                                      F.lit(True).alias("_hit")), k, "left")
    out = joined.select(*[
        F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in present else
        (F.when(F.col("_hit"), now_epoch).otherwise(F.col(c)).alias(c) if c == "updated_at" else F.col(c))
        for c in tasks.columns])
    return out, not_found, rejected


def update_users(users: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """MUT-04: set the given user fields; updated_at is NOT touched; a
    missing user is reported.  Returns (new table, not found)."""
    fields = [c for c in ["email", "name"] if c in updates.columns]
    folded = updates.groupBy("user_id").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in fields])
    not_found = folded.join(users.select("user_id"), "user_id", "left_anti")
    j = users.join(folded.select("user_id", *[F.col(c).alias(f"_u_{c}") for c in fields]), "user_id", "left")
    out = j.select(*[F.coalesce(F.col(f"_u_{c}"), F.col(c)).alias(c) if c in fields else F.col(c)
                     for c in users.columns])
    return out, not_found


def delete_tasks(tasks: DataFrame, deletes: DataFrame, key=("user_id", "task_id")) -> tuple[DataFrame, DataFrame]:
    """MUT-06 tasks: delete by key; deletes of missing tasks are reported."""
    k = list(key)
    missing = deletes.join(tasks.select(*k), k, "left_anti")
    return tasks.join(deletes.select(*k), k, "left_anti"), missing


def delete_users(users: DataFrame, deletes: DataFrame) -> DataFrame:
    """MUT-06 users: silent when absent."""
    return users.join(deletes.select("user_id"), "user_id", "left_anti")


def bulk_set_status(tasks: DataFrame, user_col: Column, new_status: str, now_epoch: Column,
                    only_status: str | None = None) -> DataFrame:
    """MUT-07: set the status of all tasks matching a predicate (terminal guard kept)."""
    hit = user_col if only_status is None else (user_col & (F.col("status") == only_status))
    guard = (F.col("status") == TERMINAL_STATUS) & F.lit(new_status != TERMINAL_STATUS)
    do = hit & ~guard
    return tasks.withColumn("updated_at", F.when(do, now_epoch).otherwise(F.col("updated_at"))) \
        .withColumn("status", F.when(do, F.lit(new_status)).otherwise(F.col("status")))


def delete_completed(tasks: DataFrame, user_col: Column | None = None) -> DataFrame:
    """MUT-07: bulk delete of completed tasks (optionally of matching users)."""
    cond = F.col("status") == TERMINAL_STATUS
    if user_col is not None:
        cond = cond & user_col
    return tasks.filter(~F.coalesce(cond, F.lit(False)))


# ------------------------------------------------------- idempotency ---

def store_idempotency(requests: DataFrame) -> DataFrame:
    """MUT-09: one key per request: expiry = created + 86400 s; response
    kept as JSON text; target task keys derived from the user and task."""
    return requests.select(
        "request_id",
        F.to_json(F.col("response")).alias("response_data"),
        F.concat(F.lit(K.TASK_PREFIX), F.col("user_id")).alias("target_task_pk"),
        F.concat(F.lit(K.TASK_PREFIX), F.col("task_id")).alias("target_task_sk"),
        F.col("http_status_code").cast("int"),
        (F.col("ts_epoch") + IDEMPOTENCY_TTL_SECONDS).alias("expiration_timestamp"),
        F.col("ts_epoch").alias("created_at"),
    )


def expire_keys(keys: DataFrame, now_epoch: Column) -> DataFrame:
    """MUT-10: TTL - drop keys whose expiry is strictly before now."""
    return keys.filter(F.col("expiration_timestamp") >= now_epoch)


def replay_split(requests: DataFrame, keys: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """JOIN-04: (replays, fresh) - a request replays a stored key with the
    same id whose expiry is at or after the request time (FIL-19).

    Equi part on request_id, theta part on time; semi/anti joins never
    emit pairs, so a hot request id does not multiply rows.  ``strict``:
    the key must have been created strictly before the request (the
    request that created a key is not its own replay).
    """
    created = (keys["created_at"] < requests["ts_epoch"]) if strict else (keys["created_at"] <= requests["ts_epoch"])
    cond = (requests["request_id"] == keys["request_id"]) & \
        (keys["expiration_timestamp"] >= requests["ts_epoch"]) & created
    return requests.join(keys, cond, "left_semi"), requests.join(keys, cond, "left_anti")


#: Requests of an id up to which its times are folded in one array; ids with more are chained by jumps.
FOLD_REQUESTS = 10_000


def chained_keys(requests: DataFrame) -> DataFrame:
    """The keys that the requests of each id create, one after another.

    A key lives 24 h from the request that created it; the first request past
    its expiry creates the next.  An id of at most ``FOLD_REQUESTS`` requests is
    folded over its distinct times in order; the others, however hot, are chained by ``chained_by_jumps``.
    """
    hot = requests.groupBy("request_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FOLD_REQUESTS).select("request_id")
    if hot.isEmpty():
        return _folded_keys(requests)
    hot = _materialized(hot, "hot-ids")
    return _folded_keys(requests.join(hot, "request_id", "left_anti")) \
        .unionByName(chained_by_jumps(requests.join(hot, "request_id", "left_semi")))


def _folded_keys(requests: DataFrame) -> DataFrame:
    times = requests.groupBy("request_id").agg(F.array_sort(F.collect_set("ts_epoch")).alias("_t"))
    none = F.array().cast("array<bigint>")
    starts = F.aggregate("_t", none, lambda acc, t: F.when(
        (F.size(acc) == 0) | (t > F.element_at(acc, -1) + IDEMPOTENCY_TTL_SECONDS), F.concat(acc, F.array(t))).otherwise(acc))
    return _keys(times.select("request_id", F.explode(starts).alias("created_at")))


def _keys(starts: DataFrame) -> DataFrame:
    return starts.withColumn("expiration_timestamp", F.col("created_at") + IDEMPOTENCY_TTL_SECONDS)


def chained_by_jumps(requests: DataFrame) -> DataFrame:
    """``chained_keys`` for ids of any number of requests.

    Each distinct time points at the first one past its key's life.  Time is
    cut into buckets one second longer than a life, so that time lies in the next bucket,
    at the same place or behind it, or is the first of a later one: a window over one
    bucket's seconds, and one over an id's buckets.  From each id's first time the
    chain is then followed by pointer doubling: after k rounds the first 2^k
    keys are known and a pointer spans 2^k lives.
    """
    life = IDEMPOTENCY_TTL_SECONDS + 1
    bucket = F.floor(F.col("t") / life).cast("bigint")
    times = _materialized(requests.select("request_id", F.col("ts_epoch").alias("t")).distinct(), "times")
    # of each time the place right past its key's life, among the times of that bucket
    marks = times.select("request_id", "t", F.lit(None).cast("bigint").alias("of")).unionByName(
        times.select("request_id", (F.col("t") + life).alias("t"), F.col("t").alias("of"))).withColumn("b", bucket)
    # at most two rows a second of the bucket; a time before the mark of the same second, when read from behind
    ahead = Window.partitionBy("request_id", "b").orderBy(F.col("t").desc(), F.col("of").isNotNull())
    real = F.when(F.col("of").isNull(), F.col("t"))
    found = marks.withColumn("next", F.last(real, ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    # one row a bucket: the first time of any later one
    later = Window.partitionBy("request_id").orderBy("b").rowsBetween(1, Window.unboundedFollowing)
    firsts = marks.groupBy("request_id", "b").agg(F.min(real).alias("first")).withColumn("later", F.first("first", ignorenulls=True).over(later))
    # one pointer a time
    jumps = _materialized(found.filter("of is not null").join(firsts.select("request_id", "b", "later"), ["request_id", "b"])
                          .select("request_id", F.col("of").alias("t"), F.coalesce("next", "later").alias("to")).filter("to is not null"), "jumps")
    chain = times.groupBy("request_id").agg(F.min("t").alias("t"))
    while not jumps.isEmpty():    # one round more for each doubling of the longest chain
        chain = _materialized(chain.unionByName(chain.join(jumps, ["request_id", "t"]).select("request_id", F.col("to").alias("t"))), "chain")
        onward = jumps.select("request_id", F.col("t").alias("to"), F.col("to").alias("beyond"))
        jumps = _materialized(jumps.join(onward, ["request_id", "to"]).select("request_id", "t", F.col("beyond").alias("to")), "jumps")
    return _keys(chain.select("request_id", F.col("t").alias("created_at")))


def _materialized(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def request_replays(requests: DataFrame, order: str) -> DataFrame:
    """STR-04 batch form: every request (request_id, ts_epoch, ``order``) with ``replay``: whether a live key answers it.

    The first request, by ``order``, of the second in which a key was made
    made it; all others within its life replay it.
    """
    keys = chained_keys(requests).select("request_id", F.col("created_at").alias("ts_epoch"), F.lit(True).alias("_starts"))
    first = requests.groupBy("request_id", "ts_epoch").agg(F.min(order).alias("_first"))
    made = keys.join(first, ["request_id", "ts_epoch"]).select("request_id", "ts_epoch", F.col("_first").alias(order), F.lit(True).alias("_made"))
    return requests.join(made, ["request_id", "ts_epoch", order], "left").withColumn("replay", F.col("_made").isNull()).drop("_made")


def keys_with_targets(keys: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JOIN-06: stored keys joined to their target task; plus dangling keys."""
    tasks = state.select(F.col("PK").alias("target_task_pk"), F.col("SK").alias("target_task_sk"),
                         "title", "status")
    on = ["target_task_pk", "target_task_sk"]
    return keys.join(tasks, on, "inner"), keys.join(tasks, on, "left_anti")


def isolation_violations(accesses: DataFrame, tasks: DataFrame) -> DataFrame:
    """JOIN-07: accesses (user_id, task_id) to tasks the user does not own."""
    owned = tasks.select("user_id", "task_id")
    known = accesses.join(tasks.select("task_id").distinct(), "task_id", "left_semi")
    return known.join(owned, ["user_id", "task_id"], "left_anti")


# ----------------------------------------------------- transitions ---

def previous_status(task_changes: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """``lag(status)`` per task in (processed_at, sequence) order, skew-safe.

    A plain ``Window.partitionBy(task)`` sorts all changes of one task in
    one task slot; a task holding a third of all changes would stall the
    job.  Here the window is partitioned by (task, time bucket), so a hot
    task spreads over many buckets.  The first change of a bucket takes the
    last status of the task's previous non-empty bucket: one row per
    (task, bucket) from a partial aggregate, ranked by a window over
    bucket rows only (the bucket count per task is bounded by the time
    span, not the data volume), then joined back.  Exactly equal to
    ``lag`` over the whole task.
    """
    order = change_order(F.col("processed_at"), F.col("sequence_number"))
    b = F.floor(F.unix_seconds(F.col("processed_at")) / F.lit(bucket_seconds)).cast("bigint")
    tc = task_changes.withColumn("_o", order).withColumn("_b", b)
    inner = tc.withColumn("_prev_in", F.lag("status").over(Window.partitionBy("task_id", "_b").orderBy("_o"))) \
        .withColumn("_first", F.row_number().over(Window.partitionBy("task_id", "_b").orderBy("_o")) == 1)
    last_per_bucket = tc.groupBy("task_id", "_b").agg(F.max_by("status", "_o").alias("_last"))
    carried = last_per_bucket.withColumn(
        "_carry", F.lag("_last").over(Window.partitionBy("task_id").orderBy("_b"))).select("task_id", "_b", "_carry")
    j = inner.join(carried, ["task_id", "_b"], "left")
    return j.withColumn("prev_status", F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev_in"))) \
        .drop("_o", "_b", "_prev_in", "_first", "_carry")


def lag_transitions(task_changes: DataFrame, bucket_seconds: int = 3600) -> DataFrame:
    """WIN-03: completed followed by another status (``lag`` semantics),
    computed with the skew-safe :func:`previous_status`."""
    return previous_status(task_changes, bucket_seconds).filter(
        (F.col("prev_status") == TERMINAL_STATUS) & F.col("status").isNotNull() & (F.col("status") != TERMINAL_STATUS))
