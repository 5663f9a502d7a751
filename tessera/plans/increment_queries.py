"""Queries of the incremental and streaming operators over several deliveries: results must not depend on the split."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitor, mutate, silver, textindex
from ..schemas import ITEM
from ..session import work_path
from ..sinks import indexes, versions
from ..sources import fixtures
from ..streaming import streams
from . import medallion, model, operator_queries, oracle
from .catalog import register

#: The events come in this many deliveries, interleaved, so keys are touched by all of them and times go back.
DELIVERIES = 3
#: Files of a delivery at least, and rows of a file at most: the tasks that read a delivery grow with it.
FILES, FILE_ROWS = 4, 50_000


def _increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities after all deliveries, each merged into the kept state as a version of its own."""
    root = work_path(spark, f"increment-{uuid.uuid4().hex}")
    bronze = model.event_bronze(spark, sf_dir)
    delivery = F.pmod(F.xxhash64("sequence_number"), F.lit(DELIVERIES))
    bronze.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(f"{root}/bronze")
    for n in range(1, DELIVERIES + 1):
        new = spark.read.schema(bronze.schema).parquet(f"{root}/bronze/delivery={n - 1}")
        medallion.silver_increment(spark, new, f"{root}/state", n)
    return silver.entities_of_partials(medallion.partials_of_version(spark, f"{root}/state", DELIVERIES))


def _files(rows: int) -> int:
    """Files of a delivery of about ``rows`` rows."""
    return max(FILES, -(-rows // FILE_ROWS))


def delivered_stream(spark: SparkSession, rows: DataFrame, arrival_seconds, time_col: str | None) -> DataFrame:
    """``rows`` as a file stream of several deliveries by arrival, one a micro-batch, and with a ``time_col`` a closing one.

    The closing row has nulls but for a time far ahead, so that the watermark passes all others.
    """
    folder = work_path(spark, f"deliveries-{uuid.uuid4().hex}")
    timed = rows.withColumn("_arrival", arrival_seconds)
    first, last, newest, count = timed.agg(F.min("_arrival"), F.max("_arrival"), F.max(F.unix_seconds(time_col) if time_col else F.lit(0)),
                                           F.count("_arrival")).first()
    if first is None:
        first, last, newest = 0, 0, 0
    width = (last - first) // DELIVERIES + 1
    files = _files(count // DELIVERIES)
    for n in range(DELIVERIES):
        part = timed.filter((F.col("_arrival") >= first + n * width) & (F.col("_arrival") < first + (n + 1) * width)).drop("_arrival")
        part.repartition(files).write.parquet(f"{folder}/delivery={n}")
    if time_col:
        _close(spark, rows, time_col, newest, f"{folder}/delivery={DELIVERIES}")
    return (spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true")
            .parquet(folder))


def _close(spark: SparkSession, rows: DataFrame, time_col: str, newest: int, folder: str) -> None:
    closing = rows.limit(0).unionByName(spark.range(1).select(F.timestamp_seconds(F.lit(newest + 400 * 86400)).alias(time_col)),
                                        allowMissingColumns=True)
    closing.coalesce(1).write.parquet(folder)


_WITH = f"WITH {oracle.EVENT_GOLD.rstrip().rstrip(',')}"
_DATES = """CAST(to_timestamp(created_at) AT TIME ZONE 'UTC' AS DATE) AS created_date,
  CAST(year(to_timestamp(created_at) AT TIME ZONE 'UTC') AS INTEGER) AS year,
  CAST(month(to_timestamp(created_at) AT TIME ZONE 'UTC') AS INTEGER) AS month,
  CAST(day(to_timestamp(created_at) AT TIME ZONE 'UTC') AS INTEGER) AS day"""


@register("silver_increment_users", f"{_WITH} SELECT *, {_DATES} FROM silver_users")
def silver_increment_users(spark, sf_dir):
    """SNK-11 / STR-08: users after three interleaved deliveries merged one by one."""
    return silver.users_of(_increments(spark, sf_dir))


@register("silver_increment_tasks", f"{_WITH} SELECT *, {_DATES} FROM silver_tasks")
def silver_increment_tasks(spark, sf_dir):
    """SNK-11 / STR-08: tasks after three interleaved deliveries merged one by one."""
    return silver.tasks_of(_increments(spark, sf_dir))


_EV = operator_queries.EV


@register("stream_bronze_redelivered", f"""WITH {_EV} SELECT CAST(ts AS DATE) AS date, COUNT(*) AS records FROM ev WHERE event_type <> 'error' GROUP BY 1
  UNION ALL SELECT NULL, COUNT(*) FILTER (WHERE event_id % 5 = 0) + COUNT(*) FILTER (WHERE event_id % 11 = 0) FROM ev""")
def stream_bronze_redelivered(spark, sf_dir):
    """STR-03: bronze rows per date of a stream that delivers every fifth change again in the same micro-batch and every
    eleventh in a later one; the row without a date is the number of changes dropped for it."""
    base = work_path(spark, f"redelivered-{uuid.uuid4().hex}")
    # images are built after the stream is read, so that the deliveries are plain rows
    ev = fixtures.read_table(spark, sf_dir, "events")
    again = ev.withColumn("late", F.lit(0)).unionByName(ev.filter(F.col("event_id") % 5 == 0).withColumn("late", F.lit(0))) \
        .unionByName(ev.filter(F.col("event_id") % 11 == 0).withColumn("late", F.lit(1)))
    files = _files(again.filter(F.col("late") == 0).count())
    for late in (0, 1):
        again.filter(F.col("late") == late).drop("late").repartition(files).write.parquet(f"{base}/in/{late}")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", "true").parquet(f"{base}/in")
    dropped: list[int] = []
    q = streams.changes_to_bronze_stream(
        fixtures.items_to_changes(fixtures.event_items(stream)), f"{base}/bronze", f"{base}/quarantine", f"{base}/ck",
        now=F.col("eventTime"), on_batch=lambda _, counts: dropped.append(counts["redelivered"]))
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    from ..sources.lake import read_bronze
    per_date = read_bronze(spark, f"{base}/bronze").groupBy(F.to_date("processed_at").alias("date")).agg(F.count(F.lit(1)).alias("records"))
    return per_date.unionByName(spark.range(1).select(F.lit(None).cast("date").alias("date"), F.lit(sum(dropped)).cast("bigint").alias("records")))


_ACTIVE = f"""WITH {_EV}, days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM ev),
ends AS (SELECT DISTINCT CAST(day + INTERVAL (i) DAY AS DATE) AS last_day FROM (SELECT DISTINCT day FROM days), range(0, 30) t(i))
SELECT CAST(last_day - INTERVAL 29 DAY AS DATE) AS first_day, last_day, COUNT(DISTINCT user_id) AS active_users
FROM ends JOIN days ON day BETWEEN last_day - INTERVAL 29 DAY AND last_day GROUP BY ALL"""


@register("active_users_30d", _ACTIVE)
def active_users_30d(spark, sf_dir):
    """STR-06, exact batch form: active users of every 30-day window."""
    ev = fixtures.read_table(spark, sf_dir, "events")
    return monitor.sliding_active_users(ev, "ts", "user_id", 30)


@register("stream_active_users_30d", _ACTIVE)
def stream_active_users_30d(spark, sf_dir):
    """STR-06: the same from the event stream by daily panes of mergeable sketches.  A sketch of 2 ** 14 slots is exact
    up to about 1,500 users a window; beyond that its relative error is about 0.8 %."""
    panes = streams.daily_active_sketches(streams.table_stream(spark, sf_dir, "events"))
    done = streams.replay_to_table(spark, panes, "panes", output_mode="update", key="day")
    return streams.sliding_active_users(done, 30)


# ------------------------------------------------- copy-on-write, keys, text index ---

@register("mut_versioned_updates", f"""WITH {operator_queries.FOLD_SQL} SELECT t.task_id, COALESCE(f.title, t.title) AS title, COALESCE(f.status, t.status) AS status,
  CAST(CASE WHEN f.task_id IS NOT NULL THEN {operator_queries.NOW_EPOCH} ELSE 0 END AS BIGINT) AS updated_at FROM tasks t LEFT JOIN folded f ON t.task_id = f.task_id""")
def mut_versioned_updates(spark, sf_dir):
    """MUT-03 / MUT-08 as copy-on-write: the task table kept in key ranges, and the version after a batch of updates."""
    tasks, updates = operator_queries._order_requests(spark, sf_dir)
    root = work_path(spark, f"tasks-{uuid.uuid4().hex}")
    bucket = versions.range_bucket("task_id", versions.range_bounds(tasks, "task_id", 16))
    versions.write_version(spark, root, tasks.withColumn("bucket", bucket), 1, ())
    change = lambda rows, requests: mutate.update_tasks(
        rows, requests, F.lit(operator_queries.NOW_EPOCH).cast("bigint"), key=("task_id",))[0]
    versions.rewrite(spark, root, tasks.schema, 2, bucket, updates, change)
    return versions.read_version(spark, root, tasks.schema, 2)


@register("mut_put_items", f"""WITH {operator_queries.STATE}, puts AS (
  SELECT 'TASK#' || user_id AS pk, 'TASK#' || (user_id * 100 + slot) AS sk, MAX(event_id) AS last FROM ev WHERE event_type = 'purchase' GROUP BY ALL
) SELECT "PK", "SK", status, CAST(NULL AS BIGINT) AS updated_at FROM state s WHERE NOT EXISTS (SELECT 1 FROM puts p WHERE p.pk = s."PK" AND p.sk = s."SK")
  UNION ALL SELECT pk, sk, 'archived ' || last, {operator_queries.NOW_EPOCH} FROM puts""")
def mut_put_items(spark, sf_dir):
    """MUT-01: the state after full items were put over it, the last put of a key winning; new keys are added."""
    state = operator_queries.event_state(spark, sf_dir).withColumn("updated_at", F.lit(None).cast("bigint"))
    bought = fixtures.event_items(fixtures.read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase"))
    seq = F.col("SequenceNumber").cast("bigint")
    own = {"PK": F.col("PK"), "SK": F.col("SK"), "status": F.concat(F.lit("archived "), seq.cast("string"))}
    items = bought.select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in ITEM.fields], seq.alias("seq"))
    return mutate.put_items(state, items, F.lit(operator_queries.NOW_EPOCH).cast("bigint")).select("PK", "SK", "status", "updated_at")


_KEYS_SQL = f"""WITH {_EV}, keys AS (
  SELECT user_id || ':' || event_id AS request_id, to_json({{'task': CAST(user_id * 100 + slot AS VARCHAR), 'status': 'completed'}}) AS response_data,
         'TASK#' || user_id AS target_task_pk, 'TASK#' || (user_id * 100 + slot) AS target_task_sk, CAST(200 AS INTEGER) AS http_status_code,
         CAST(ep + 86400 AS BIGINT) AS expiration_timestamp, CAST(ep AS BIGINT) AS created_at FROM ev WHERE event_type = 'purchase')"""


def _purchase_keys(spark, sf_dir):
    ev = fixtures.read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    slot = F.pmod(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(fixtures.TASKS_PER_USER))
    task = (F.col("user_id") * 100 + slot).cast("string")
    return mutate.store_idempotency(ev.select(
        F.concat_ws(":", F.col("user_id").cast("string"), F.col("event_id").cast("string")).alias("request_id"),
        F.struct(task.alias("task"), F.lit("completed").alias("status")).alias("response"), F.col("user_id").cast("string").alias("user_id"),
        task.alias("task_id"), F.lit(200).alias("http_status_code"), F.unix_seconds("ts").alias("ts_epoch")))


@register("idempotency_store", f"{_KEYS_SQL} SELECT CAST(response_data AS VARCHAR) AS response_data, * EXCLUDE (response_data) FROM keys")
def idempotency_store(spark, sf_dir):
    """MUT-09: the idempotency keys that the purchase requests store."""
    return _purchase_keys(spark, sf_dir)


@register("idempotency_live_keys", f"{_KEYS_SQL} SELECT request_id, expiration_timestamp FROM keys WHERE expiration_timestamp >= 1705363200")
def idempotency_live_keys(spark, sf_dir):
    """MUT-10: the keys left on 2024-01-16 00:00 UTC, when those past their life are removed."""
    return mutate.expire_keys(_purchase_keys(spark, sf_dir), F.lit(1705363200).cast("bigint")).select("request_id", "expiration_timestamp")


@register("search_tasks_indexed", f"WITH {operator_queries.TASK_VIEW} SELECT id, user_id, title FROM tv WHERE lower(coalesce(title, '')) LIKE '%task 1%'"
          " OR lower(coalesce(description, '')) LIKE '%task 1%'")
def search_tasks_indexed(spark, sf_dir):
    """FIL-16: text search through a trigram index of the task view."""
    tasks = model.materialize(operator_queries._task_view(spark, sf_dir).select("id", "user_id", "title", "description"), "task-view")
    root = work_path(spark, f"trigrams-{uuid.uuid4().hex}")
    textindex.write_index(tasks, root, "id", "title", "description")
    return textindex.search(tasks, root, "id", "task 1", "title", "description").select("id", "user_id", "title")


# ------------------------------------------------------------- stored indexes ---
#: The index is built of the state before this moment and kept up with the changes from it on.
_SPLIT = "2024-01-16 00:00:00"


def _kept_index(spark, sf_dir, index: indexes.Index) -> str:
    """The name of an index built of the state at ``_SPLIT`` and kept up to the last change."""
    envelopes = model.materialize(mutate.changes_with_removes(fixtures.event_changes(spark, sf_dir), F.col("eventTime")), "envelopes")
    early = F.col("processed_at") < F.lit(_SPLIT).cast("timestamp")
    name = f"index_{uuid.uuid4().hex}"
    path = work_path(spark, name)
    before = model.materialize(mutate.current_state(envelopes.filter(early)), "state")
    indexes.build(before, index, name, path, 1)
    touched = envelopes.filter(~early).select("data.PK", "data.SK").distinct()
    after = mutate.current_state(envelopes).join(touched, ["PK", "SK"], "left_semi")
    indexes.apply_changes(before.join(touched, ["PK", "SK"], "left_semi"), after, index, name, path, 2)
    return name


def _ranges(spark, sf_dir, prefix: str, low: str, high: str) -> DataFrame:
    """One range of an index for every user of the events."""
    users = fixtures.read_table(spark, sf_dir, "events").select("user_id").filter("user_id is not null").distinct()
    return users.select(F.concat(F.lit(prefix), F.col("user_id").cast("string")).alias("part"), F.lit(low).alias("low"), F.lit(high).alias("high"))


def _indexed_sql(condition: str) -> str:
    return f"WITH {operator_queries.STATE} SELECT \"PK\", \"SK\", status, due_date FROM state WHERE \"PK\" LIKE 'TASK#%' AND {condition}"


@register("indexed_tasks_in_progress", _indexed_sql("status = 'in_progress'"))
def indexed_tasks_in_progress(spark, sf_dir):
    """FIL-08 / PRJ-14: every user's tasks in progress by the stored status index, after it was kept up with later changes."""
    name = _kept_index(spark, sf_dir, indexes.BY_STATUS)
    wanted = _ranges(spark, sf_dir, "USER#", *indexes.prefix_range("STATUS#in_progress#"))
    return indexes.lookup_many(indexes.BY_STATUS, name, wanted).select("PK", "SK", "status", "due_date")


@register("indexed_due_range", _indexed_sql("due_date BETWEEN '2024-01-10' AND '2024-01-20'"))
def indexed_due_range(spark, sf_dir):
    """FIL-09 / FIL-13: every user's tasks due in a range of dates by the stored due date index."""
    name = _kept_index(spark, sf_dir, indexes.BY_DUE_DATE)
    wanted = _ranges(spark, sf_dir, "USER#", "DUEDATE#2024-01-10#", indexes.prefix_range("DUEDATE#2024-01-20#")[1])
    return indexes.lookup_many(indexes.BY_DUE_DATE, name, wanted).select("PK", "SK", "status", "due_date")


@register("indexed_items", f"""WITH {operator_queries.STATE}, wanted AS (SELECT DISTINCT 'TASK#' || user_id AS pk, 'TASK#' || (user_id * 100 + slot) AS sk
  FROM ev WHERE event_type = 'click') SELECT s."PK", s."SK", s.status, s.due_date FROM state s JOIN wanted w ON s."PK" = w.pk AND s."SK" = w.sk""")
def indexed_items(spark, sf_dir):
    """SRC-06: the items of a batch of keys by the stored index of the items' own keys."""
    name = _kept_index(spark, sf_dir, indexes.PRIMARY)
    wanted = operator_queries.clicked_keys(spark, sf_dir)
    return indexes.get_items(indexes.PRIMARY, name, wanted).select("PK", "SK", "status", "due_date")


# ------------------------------------------------------------- files set aside ---
#: The changes come in this many files; those of one are damaged.
_CHANGE_FILES, _DAMAGED = 8, 3


@register("bronze_files_set_aside", f"""WITH {_EV} SELECT CAST(ts AS DATE) AS date, COUNT(*) AS records FROM ev
  WHERE event_type <> 'error' AND event_id % {_CHANGE_FILES} <> {_DAMAGED} GROUP BY 1
  UNION ALL SELECT NULL, COUNT(DISTINCT event_id % {_CHANGE_FILES}) FROM ev WHERE event_id % {_CHANGE_FILES} = {_DAMAGED}""")
def bronze_files_set_aside(spark, sf_dir):
    """SRC-01: bronze rows per date of change files of which one can't be read; the row without a date counts the files set aside."""
    from ..sources import lake as src
    base = work_path(spark, f"change-files-{uuid.uuid4().hex}")
    changes = fixtures.event_changes(spark, sf_dir)
    number = F.col("dynamodb.SequenceNumber").cast("bigint") % _CHANGE_FILES
    lines = changes.select(number.alias("n"), F.to_json(F.struct("eventName", "eventTime", "dynamodb")).alias("line"))
    # a file is the lines of one task as they come: no folders by number, for which a task sorts its lines
    whole = lines.filter(F.col("n") != _DAMAGED).repartitionById(_CHANGE_FILES, F.abs("n").cast("int"))
    whole.select("line").write.text(f"{base}/whole")
    lines.filter(F.col("n") == _DAMAGED).select("line").repartition(1).write.text(f"{base}/damaged")
    # lines under the name of a compressed file: the reader fails on them
    _name_compressed(spark, f"{base}/damaged")
    files = [f for part in ("whole", "damaged") for f in src.change_files(spark, f"{base}/{part}")]
    done = medallion.bronze_files_job(spark, files, f"{base}/bronze", f"{base}/quarantine", "b1", attempts=1, now=F.col("eventTime"))
    landed = src.read_bronze(spark, done["bronze"]).groupBy(F.to_date("processed_at").alias("date")).agg(F.count(F.lit(1)).alias("records"))
    aside = spark.read.schema("file string, error string").json(f"{base}/quarantine/files")
    return landed.unionByName(aside.select(F.lit(None).cast("date").alias("date"), "file").groupBy("date").agg(F.countDistinct("file").alias("records")))


def _name_compressed(spark, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for path in [status.getPath() for status in files.listStatus(root) if status.getLen()]:
        files.rename(path, jvm.org.apache.hadoop.fs.Path(root, path.getName().removesuffix(".txt") + ".json.gz"))
