"""Structured Streaming forms of the change path and the monitors
(STR-01..08).

* Sinks are idempotent per micro-batch: ``foreachBatch`` writes batch ``n``
  to its own folder with overwrite, so a retried batch replaces its own
  output instead of appending twice (STR-03).
* Aggregations carry a watermark so their state is bounded.
* The per-task state machine keeps a task's last change and those that the
  watermark hasn't passed yet, never the task's history.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators import cdc
from ..session import work_path
from ..sinks import lake as sink

FLUSH_INTERVAL = "60 seconds"     # delivery buffer: 60 s (STR-02)
#: The state store that list state and timers need, as against the default one.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
#: Log of the sketch's slots: relative error 1.04 / sqrt(2 ** SKETCH_LG_K).
SKETCH_LG_K = 14


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """One of the given parquet tables as a file stream (for replays/tests)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    df = r.parquet(sf_dir)
    ntz = [f.name for f in schema.fields if f.dataType.simpleString() == "timestamp_ntz"]
    for c in ntz:
        df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


def _start(df_writer, checkpoint: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    w = df_writer.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


# ----------------------------------------------------------- STR-01 ---

def changes_to_bronze_stream(changes: DataFrame, bronze_path: str, quarantine_path: str, checkpoint: str,
                             available_now: bool = True, processing_time: str = FLUSH_INTERVAL,
                             on_batch: Callable[[int, dict], None] | None = None,
                             now: Column | None = None, dedupe: bool = True, keep_days: int | None = None) -> StreamingQuery:
    """STR-01: change stream -> bronze (gzip JSON by date) + quarantine.

    The batch counters (AGG-13) are observed on the write of bronze, as in the batch job; only
    if some record failed the micro-batch is read again for the quarantine.  Output of batch ``n`` goes to ``batch=n`` folders
    with overwrite, so a replayed batch is not duplicated, and a change that
    the source delivers again is dropped and counted as ``redelivered`` (STR-03)
    unless ``dedupe`` is off.  No change is dropped for being late.  Keys of event days
    more than ``keep_days`` behind the newest are forgotten.  The
    arrival time is the clock, one value per micro-batch; ``now`` pins it.
    """
    landed = f"{checkpoint.rstrip('/')}/landed"

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen, outcomes, new = Observation(), Observation(), batch
        if dedupe:
            # the keys and the changes are read one after the other: the records are parsed once, and wait on disk
            batch.persist(StorageLevel.DISK_ONLY)
        try:
            if dedupe:
                new = not_landed(batch, batch_id, landed, seen)
            c = cdc.classify(new)
            sink.write_bronze(cdc.to_envelope(cdc.observe_outcomes(c, outcomes).filter(F.col("_outcome") == "processed"), now=now),
                              bronze_path, batch_id)
            counts, failed = cdc.observed_outcomes(c, outcomes), cdc.failed_records(c)
            sink.quarantine(failed if counts["failed"] else failed.limit(0), quarantine_path, batch_id)
            if on_batch is not None:
                on_batch(batch_id, counts | ({"redelivered": seen.get["records"] - counts["records"]} if dedupe else {}))
        finally:
            batch.unpersist()
        if dedupe and keep_days is not None:
            forget_landed(batch.sparkSession, landed, keep_days)

    return _start(changes.writeStream.foreachBatch(handle), checkpoint, available_now, processing_time)


# ----------------------------------------------------------- STR-03/04 ---

_LANDED = "_seq string, _at timestamp"
#: Folder of changes without an event time.
NO_DAY = "none"


def not_landed(batch: DataFrame, batch_id: int, landed: str, seen: Observation | None = None) -> DataFrame:
    """The changes of micro-batch ``batch_id``, each once, that no batch before it held.

    A change delivered again has the same sequence number and event time.  A record
    without a number can't be told from another, so each of them is kept: two equal broken lines are two.
    The numbers lie under ``landed`` by event day, then batch; a batch replaces its own
    folders when it runs again, and is compared with the folders of its own days alone (of no day: with that
    of no day).  ``seen`` gets the number of ``records`` that came.
    """
    spark = batch.sparkSession
    seen = Observation() if seen is None else seen
    seq = F.col("dynamodb.SequenceNumber")
    day = F.coalesce(F.to_date("eventTime").cast("string"), F.lit(NO_DAY))
    keyed = batch.select(seq.alias("_seq"), F.col("eventTime").cast("timestamp").alias("_at"), day.alias("day"), F.monotonically_increasing_id().alias("_row"),
                         F.struct(*[F.col(c) for c in batch.columns]).alias("_rec"))
    keyed.observe(seen, F.count(F.lit(1)).alias("records")).select("_seq", "_at", "day", F.lit(batch_id).cast("long").alias("batch")) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(landed)
    # a row without a number is a group of its own
    rows = keyed.select("_seq", "_at", F.when(F.col("_seq").isNull(), F.col("_row")).alias("_own"), "_row", "_rec", F.lit(False).alias("_known"))
    if seen.get["records"]:
        landing = spark.read.schema(_LANDED + ", day string, batch long").option("basePath", landed)
        # the days of one micro-batch: few, however many records
        mine = landing.parquet(f"{landed}/day=*/batch={batch_id}").filter("_seq is not null")
        days = [r.day for r in mine.select("day").distinct().collect()]
        if days:
            known = landing.parquet(*[f"{landed}/day={d}" for d in days]).filter((F.col("batch") < batch_id) & F.col("_seq").isNotNull())
            rows = rows.unionByName(known.select("_seq", "_at", F.lit(True).alias("_known")), allowMissingColumns=True)
    # dealt by key once, then the first delivery of each; one shuffle carries the records
    own = ["_seq", "_at", "_own"]
    first = rows.repartition(*own).groupBy(*own).agg(F.min_by("_rec", "_row").alias("_rec"), F.max("_known").alias("_known"))
    return first.filter(~F.col("_known")).select("_rec.*")


def forget_landed(spark: SparkSession, landed: str, keep_days: int) -> list[str]:
    """Remove the keys of event days more than ``keep_days`` behind the newest; those days' names.

    A source keeps its changes for a bounded time, so older ones can't come again.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(landed)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [f.getPath().getName().removeprefix("day=") for f in files.listStatus(root) if f.getPath().getName().startswith("day=")]
    dated = sorted(d for d in days if d != NO_DAY)
    old = [d for d in dated if (date.fromisoformat(dated[-1]) - date.fromisoformat(d)).days > keep_days]
    for d in old:
        files.delete(jvm.org.apache.hadoop.fs.Path(f"{landed}/day={d}"), True)
    return old


REPLAY_SCHEMA = "request_id string, ts_epoch long, replay boolean, key_created_at long, key_expires_at long, late boolean"
#: Groups that many ids or tasks are dealt into by hash; a group is one call and one state list a micro-batch.
#: A running stream keeps its number: its state lies by group.
GROUPS = 1024


def _group(key: str, groups: int | None) -> Column:
    return F.col(key) if groups is None else F.pmod(F.xxhash64(key), F.lit(groups))


def idempotency_stream(requests: DataFrame, delay_seconds: int = 3600, groups: int | None = GROUPS) -> DataFrame:
    """STR-04 exact: classify each request (request_id, ts_epoch) as a replay
    of a live key or as a new key, with windows chained per id.

    One state row per request id whose key may still be asked for: a timer
    removes it when the watermark, ``delay_seconds`` behind the newest request, has
    passed the key's expiry.  A request that comes later than the delay makes no key;
    it is returned with ``late``: a replay if the key of its id held then lived at its time, else of
    unknown answer (null).  Ids are dealt into ``groups``, so that a call and its state access serve many ids (None: each
    id by itself).  The rows handled per call are one group's requests
    of one micro-batch (bounded by the trigger size).  Needs the RocksDB state store (``ROCKSDB``).
    """
    step = _make_idempotency_keys()
    # the time goes on as a plain number: late requests are to be answered, not filtered away
    timed = requests.select("request_id", "ts_epoch", F.timestamp_seconds("ts_epoch").alias("_at")) \
        .withWatermark("_at", f"{delay_seconds} seconds").select(_group("request_id", groups).alias("group"), "request_id", "ts_epoch")
    return timed.groupBy("group").transformWithStateInPandas(step, REPLAY_SCHEMA, "Append", "eventTime")


def _make_idempotency_keys():
    # shipped by value, like the task machine
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    columns = ["request_id", "ts_epoch", "replay", "key_created_at", "key_expires_at", "late"]

    class IdempotencyKeys(StatefulProcessor):
        """State per group: the live key (created_at, expires_at) of each of its ids, and the one timer set.

        A request at or before the expiry replays the key; a later one creates
        a new key valid for 24 h from that request (expired only when strictly
        past the expiry), exactly as the service's check-then-store does.
        """

        def init(self, handle) -> None:
            self.handle = handle
            self.keys = handle.getListState("keys", "request_id string, created long, expires long")
            self.timer = handle.getValueState("timer", "at long")

        def _load(self) -> dict:
            return {rid: (created, expires) for rid, created, expires in self.keys.get()}

        def _save(self, held: dict, watermark: int, timer: int | None) -> None:
            """Keep the keys that the watermark has not passed, and look again when it passes the first of them; ``timer`` is still to fire."""
            live = [(rid, *key) for rid, key in held.items() if key[1] * 1000 >= watermark]
            to = min(key[2] for key in live) * 1000 + 1 if live else None
            if timer is not None and timer != to:
                self.handle.deleteTimer(timer)
            if to is None:
                self.keys.clear()
                self.timer.clear()
                return
            self.keys.put(live)
            if timer != to:
                self.handle.registerTimer(to)
                self.timer.update((to,))

        def handleInputRows(self, key, rows, timerValues):
            watermark = timerValues.getCurrentWatermarkInMs()
            held, timer = self._load(), self.timer.get()
            asked: dict = {}
            for frame in rows:
                for rid, ts in zip(frame["request_id"], frame["ts_epoch"]):
                    asked.setdefault(rid, []).append(int(ts))
            out = []
            for rid, times in asked.items():
                created, expires = held.get(rid, (None, None))
                for ts in sorted(times):
                    late = ts * 1000 < watermark
                    if expires is not None and ts <= expires and (not late or ts >= created):
                        out.append((rid, ts, True, created, expires, late))
                    elif late:
                        out.append((rid, ts, None, None, None, True))
                    else:
                        created, expires = ts, ts + 86400
                        out.append((rid, ts, False, created, expires, False))
                if expires is not None:
                    held[rid] = (created, expires)
            # a key that the watermark has passed answered the late requests of this micro-batch, then goes
            self._save(held, watermark, timer and timer[0])
            yield pd.DataFrame(out, columns=columns, dtype=object)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self._save(self._load(), timerValues.getCurrentWatermarkInMs(), None)
            yield from ()

        def close(self) -> None:
            pass

    return IdempotencyKeys()


# ----------------------------------------------------------- STR-05/06 ---

def tumbling_rollup(log: DataFrame, value_col: str = "duration_ms", period: str = "5 minutes",
                    delay: str = "10 minutes") -> DataFrame:
    """STR-05: per-period count / sum / avg / max with a watermark (append mode)."""
    return log.withWatermark("timestamp", delay).groupBy(F.window("timestamp", period).alias("w")).agg(
        F.count(F.lit(1)).alias("samples"), F.sum(value_col).alias("sum"),
        F.avg(value_col).alias("average"), F.max(value_col).alias("maximum"),
    ).select(F.col("w.start").alias("period_start"), "samples", "sum", "average", "maximum")


def daily_active_sketches(activity: DataFrame, ts_col: str = "ts", user_col: str = "user_id", delay: str = "1 day",
                          lg_k: int = SKETCH_LG_K) -> DataFrame:
    """STR-06, panes: per day one mergeable distinct-user sketch.

    A row goes to its day's pane alone, whatever the length of the windows over
    it; the state of a pane is one sketch of at most a few kilobytes.  For update or append mode.
    """
    timed = activity.withWatermark(ts_col, delay)
    return timed.groupBy(F.window(ts_col, "1 day").alias("w")).agg(
        F.hll_sketch_agg(F.col(user_col).cast("string"), lg_k).alias("sketch")).select(F.to_date("w.start").alias("day"), "sketch")


def sliding_active_users(panes: DataFrame, days: int = 30) -> DataFrame:
    """STR-06: active users of every window of ``days`` days, advanced daily, from daily panes (day, sketch).

    Windows end on each day from the first pane's to the last one's last window; windows without any pane don't
    occur.  Each pane is copied to the windows that hold it: ``days`` small rows a day, never rows of users.
    ``panes`` with exact ``users`` sets instead of sketches are not needed: the sketch's relative error is
    about 1.04 / sqrt(2 ** lg_k), 0.8 % at the default.
    """
    ends = panes.select("sketch", F.explode(F.sequence("day", F.date_add("day", days - 1))).alias("last_day"))
    return ends.groupBy("last_day").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("active_users")).select(
        F.date_sub("last_day", days - 1).alias("first_day"), "last_day", "active_users")


# ----------------------------------------------------------- STR-07 ---

TRANSITION_SCHEMA = "task_id string, sequence_number string, prev_status string, status string, accepted boolean, late boolean"
_CHANGE = "status string, seq string, ms long"


def task_state_machine(task_changes: DataFrame, delay: str = "10 minutes", keep_days: int = 400, groups: int | None = None) -> DataFrame:
    """STR-07: per-task status machine over a change stream, in event order whatever the order of arrival.

    ``task_changes``: (task_id, status, sequence_number, event_time).  A change
    waits in list state until the watermark, ``delay`` behind the
    newest event, has passed it; a timer then applies what waits in the
    order of event time, then numeric sequence.  A change that moves a completed task to another status is
    rejected (not applied); a REMOVE (status null) resets the task; the same change again counts once.  One that arrives
    behind the watermark, or has no event time, is reported as ``late`` and not applied.  Of a task
    the last applied change is kept, until ``keep_days`` without another one.

    Each task has a state of its own, or ``groups`` of tasks share one, so that a call and its state access serve many
    tasks (``GROUPS`` for many tasks with few changes each); the rows are the same.  Needs the RocksDB state store (``ROCKSDB``).
    """
    step = _make_task_machine(keep_days * 86_400_000)
    # the event time goes on as a plain number: late changes are to be reported, not filtered away before the machine
    timed = task_changes.withWatermark("event_time", delay).select(
        _group("task_id", groups).alias("group"), "task_id", "status", F.col("sequence_number").alias("seq"), F.unix_millis("event_time").alias("ms"))
    return timed.groupBy("group").transformWithStateInPandas(step, TRANSITION_SCHEMA, "Append", "eventTime")


def _make_task_machine(keep_ms: int):
    # Defined inside a function so it is shipped by value: Python workers
    # need pandas and pyspark only, not this package.
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    columns = ["task_id", "sequence_number", "prev_status", "status", "accepted", "late"]
    nothing = (None, None, None)

    def text(value):
        return None if value is None or pd.isna(value) else str(value)

    def place(change) -> tuple[int, int]:
        seq = change[1]
        return change[2], int(seq) if seq is not None and seq.isdigit() else -1

    class TaskMachine(StatefulProcessor):
        """State per group: ``own``, the last applied change of each of its tasks; the waiting changes; and the one timer set."""

        def init(self, handle) -> None:
            self.handle = handle
            self.waiting = handle.getListState("waiting", "task_id string, " + _CHANGE)
            self.own = handle.getListState("own", "task_id string, " + _CHANGE)
            self.timer = handle.getValueState("timer", "at long")

        def _load(self) -> dict:
            return {row[0]: tuple(row[1:]) for row in self.own.get()}

        def _move_timer(self, timer: int | None, to: int | None, watermark: int) -> None:
            if timer == to:
                return
            if timer is not None and timer > watermark:    # one behind it has fired
                self.handle.deleteTimer(timer)
            if to is None:
                self.timer.clear()
            else:
                self.handle.registerTimer(to)
                self.timer.update((to,))

        def _put(self, state, rows: list) -> None:
            state.put(rows) if rows else state.clear()

        def _apply(self, now: dict, watermark: int) -> tuple[list[tuple], int | None]:
            """Apply what waits and the watermark has passed: rows put out, and when to look again (None: nothing is kept); ``now`` is changed."""
            rest, due = [], {}
            for row in self.waiting.get():
                if row[3] < watermark:
                    due.setdefault(row[0], []).append(tuple(row[1:]))
                else:
                    rest.append(tuple(row))
            out = []
            for task, changes in due.items():
                last = now.get(task, nothing)
                for change in sorted(changes, key=place):
                    if change[1] is not None and change[1:] == last[1:]:
                        continue    # the same change again
                    status, found = change[0], last[0]
                    accepted = not (found == "completed" and status is not None and status != "completed")
                    out.append((task, change[1], found, status, accepted, False))
                    last = (status if accepted else found, *change[1:])
                now[task] = last
            if due:
                self._put(self.waiting, rest)
            waits = {row[0] for row in rest}
            old = [task for task, last in now.items() if last[2] + keep_ms <= watermark and task not in waits]
            for task in old:
                del now[task]
            if due or old:
                self._put(self.own, [(task, *last) for task, last in now.items()])
            # a task with changes that wait is kept until they are applied
            ahead = [row[3] + 1 for row in rest] + [last[2] + keep_ms for task, last in now.items() if task not in waits]
            return out, min(ahead, default=None)

        def handleInputRows(self, key, rows, timerValues):
            watermark = timerValues.getCurrentWatermarkInMs()
            held = self.timer.get()
            timer = to = held[0] if held else None
            now, out = self._load(), []
            if timer is not None and timer <= watermark:
                # Spark hands over new rows before it fires timers: what the watermark has passed comes before them
                out, to = self._apply(now, watermark)
            for frame in rows:
                fresh = []
                for task, status, seq, ms in zip(frame["task_id"], frame["status"], frame["seq"], frame["ms"]):
                    task, change = text(task), (text(status), text(seq), None if pd.isna(ms) else int(ms))
                    if change[2] is not None and change[2] >= watermark:
                        fresh.append((task, *change))
                        to = change[2] + 1 if to is None else min(to, change[2] + 1)
                    else:
                        last = now.get(task, nothing)
                        if change != last:
                            out.append((task, change[1], last[0], change[0], False, True))
                if fresh:
                    self.waiting.appendList(fresh)
            self._move_timer(timer, to, watermark)
            if out:
                yield pd.DataFrame(out, columns=columns)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            watermark = timerValues.getCurrentWatermarkInMs()
            held = self.timer.get()
            if not held or held[0] > watermark:
                return    # its work was done when rows came in
            out, to = self._apply(self._load(), watermark)
            self._move_timer(held[0], to, watermark)
            if out:
                yield pd.DataFrame(out, columns=columns)

        def close(self) -> None:
            pass

    return TaskMachine()


# ----------------------------------------------------------- STR-08 ---

def incremental(stream: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str,
                available_now: bool = True) -> StreamingQuery:
    """SNK-11 / STR-08: process only input that arrived since the last run
    (the checkpoint remembers which files were seen); ``process`` gets each
    new batch and its id."""
    return _start(stream.writeStream.foreachBatch(process), checkpoint, available_now, None)


def replay_to_table(spark: SparkSession, stream: DataFrame, name: str, output_mode: str = "append",
                    key: str | None = None, rocksdb: bool = False) -> DataFrame:
    """Run a streaming aggregate to completion (availableNow) into a Parquet
    folder under the shared checkpoint directory, and read the result.

    In ``update`` mode with a ``key`` the last row written for a key counts.
    Used by tests and registered replays: the batch twin must equal it.
    """
    import uuid
    base = work_path(spark, f"replay-{name}-{uuid.uuid4().hex[:8]}")
    out, ck = f"{base}/out", f"{base}/ck"

    def write(batch: DataFrame, batch_id: int) -> None:
        if output_mode == "complete":
            # each batch holds the whole result: overwrite it
            batch.write.mode("overwrite").parquet(out)
        else:
            # batch n owns its folder: a retried batch replaces its own rows
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    kept = spark.conf.get(*STATE_STORE)
    spark.conf.set(STATE_STORE[0], ROCKSDB if rocksdb else kept)
    try:    # a query takes the setting along when it starts
        q = _start(stream.writeStream.outputMode(output_mode).foreachBatch(write), ck, True, None)
    finally:
        spark.conf.set(STATE_STORE[0], kept)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    df = spark.read.parquet(out)
    if key:
        last = df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c not in (key, "batch")]), "batch").alias("_l"))
        return last.select(key, "_l.*")
    return df.drop("batch") if output_mode != "complete" else df
