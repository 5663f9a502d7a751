"""The batch jobs: changes -> bronze, bronze -> silver, silver -> gold.

Each job reads its input once and writes with the layer writers.  Silver
is written before gold reads it back, which also cuts the lineage between
the two jobs; within a job nothing is cached on the driver.
"""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import cdc, gold, silver
from ..schemas import PARTIALS, SILVER_TASKS, SILVER_USERS
from ..sinks import lake as sink, versions
from ..sources import lake as src
from ..streaming import streams
from .model import Gold, materialize


def bronze_job(changes: DataFrame, bronze_root: str, quarantine_root: str, batch: str | int, now: Column | None = None) -> dict:
    """STR-01 batch twin: decode changes, write bronze, quarantine failures, count both.

    The counters (AGG-13) are observed on the write of bronze itself: no
    count and no cached copy beside it.  Failed records are few, and none as a rule;
    only if there are some the input is read again for them.  ``batch`` names the batch: run again, the job
    replaces what it wrote before.
    """
    bronze = f"{bronze_root.rstrip('/')}/cdc"
    seen = Observation()
    classified = cdc.classify(changes)
    sink.write_bronze(cdc.to_envelope(cdc.observe_outcomes(classified, seen).filter(F.col("_outcome") == "processed"), now=now), bronze, batch)
    counts = cdc.observed_outcomes(classified, seen)
    failed = cdc.failed_records(classified)
    sink.quarantine(failed if counts["failed"] else failed.limit(0), quarantine_root, batch)
    return {"bronze": bronze} | counts


#: Tries of a batch, or of a piece of it, before it is halved.
ATTEMPTS = 3
#: What a failing Spark job raises.
JOB_ERRORS = (PySparkException, Py4JError)


def bronze_files_job(spark: SparkSession, files: list[str], bronze_root: str, quarantine_root: str, batch: str,
                     attempts: int = ATTEMPTS, now: Column | None = None) -> dict:
    """SRC-01: ``bronze_job`` over a batch of change files, of which some may not be readable at all.

    A batch that fails is tried again, ``attempts`` times in all, then halved, and so are its halves, until a
    file that fails stands alone.  That file is set aside: its name and the error go to the folder ``files`` of the quarantine,
    and the rest of the batch lands.  One bad file among n costs about 2 log2(n) more jobs.  If no file of several can be handled the
    fault isn't a file's, and the last error is raised.  The driver holds file names, never records.

    Run again, the job replaces all that it wrote before, in whatever pieces.  No files: nothing is written.
    """
    folders = (f"{bronze_root.rstrip('/')}/cdc", quarantine_root, f"{quarantine_root.rstrip('/')}/files")
    for folder in folders:
        sink.remove_batches(spark, folder, batch)
    counts = dict.fromkeys(("processed", "failed", "skipped", "records"), 0)
    bad: list[tuple[str, str]] = []
    pieces = [(0, len(files))] if files else []
    while pieces:
        first, end = pieces.pop()
        name = sink.piece_name(batch, first, end)
        error = None
        for _ in range(attempts):
            try:
                done = bronze_job(src.read_changes(spark, files[first:end]), bronze_root, quarantine_root, name, now)
                counts = {c: n + done[c] for c, n in counts.items()}
                break
            except JOB_ERRORS as e:
                error = e
        else:
            for folder in folders[:2]:
                sink.remove_batches(spark, folder, name)  # of a try that failed between its outputs
            if end - first > 1:
                middle = (first + end) // 2
                pieces += [(middle, end), (first, middle)]
                continue
            bad.append((files[first], str(error)))
            if len(bad) == len(files) > 1:
                raise error
    if bad:
        sink.quarantine(spark.createDataFrame(bad, "file string, error string").coalesce(1), folders[2],
                        sink.piece_name(batch, 0, len(files)))
    return {"bronze": folders[0], "set_aside": [f for f, _ in bad]} | counts


def silver_job(spark: SparkSession, bronze_root: str, silver_root: str, mode: str = "overwrite",
               latest: bool = False) -> dict:
    """Silver: cdc (flat changes), users and tasks from ONE bronze read.

    Returns the written paths, or an empty dict when bronze is empty
    (SNK-12: checked with a limit-1 probe).
    """
    bronze = src.read_bronze(spark, f"{bronze_root.rstrip('/')}/cdc")
    if sink.skip_if_empty(bronze):
        return {}
    root = silver_root.rstrip("/")
    # the JSON is parsed once, into a Parquet table that the three writes read
    bronze = materialize(bronze, "bronze")
    ent = materialize(silver.silver_entities(bronze, latest), "silver-entities")
    sink.write_silver(silver.silver_cdc(bronze), f"{root}/cdc", mode="append" if mode == "append" else "overwrite")
    sink.write_silver(silver.users_of(ent), f"{root}/users", mode=mode)
    sink.write_silver(silver.tasks_of(ent), f"{root}/tasks", mode=mode)
    return {"cdc": f"{root}/cdc", "users": f"{root}/users", "tasks": f"{root}/tasks"}


def gold_job(spark: SparkSession, silver_root: str, gold_root: str) -> dict:
    """Gold: user analytics, task user metrics, category trends, KPIs."""
    users = src.read_silver(spark, silver_root, "users", SILVER_USERS)
    tasks = src.read_silver(spark, silver_root, "tasks", SILVER_TASKS)
    if sink.skip_if_empty(users) and sink.skip_if_empty(tasks):
        return {}
    root = gold_root.rstrip("/")
    out = {
        "user_analytics": f"{root}/user_analytics",
        "task_analytics/user_metrics": f"{root}/task_analytics/user_metrics",
        "task_analytics/category_trends": f"{root}/task_analytics/category_trends",
        "business_metrics/kpis": f"{root}/business_metrics/kpis",
    }
    sink.write_gold(gold.gold_user_analytics(users), out["user_analytics"])
    sink.write_gold(gold.gold_user_metrics(tasks), out["task_analytics/user_metrics"])
    sink.write_gold(gold.gold_category_trends(tasks), out["task_analytics/category_trends"])
    sink.write_gold(gold.gold_kpis(users, tasks), out["business_metrics/kpis"])
    return out


def read_gold(spark: SparkSession, gold_root: str) -> Gold:
    """The gold frames from the folders that ``gold_job`` wrote."""
    root = gold_root.rstrip("/")
    return Gold(None, None, None,
                user_analytics=spark.read.parquet(f"{root}/user_analytics"),
                user_metrics=spark.read.parquet(f"{root}/task_analytics/user_metrics"),
                category_trends=spark.read.parquet(f"{root}/task_analytics/category_trends"),
                kpis=spark.read.parquet(f"{root}/business_metrics/kpis"))


def register_gold(spark: SparkSession, gold_root: str, database: str | None = None) -> None:
    """Expose the gold folders under the catalog names the SQL uses."""
    from .queries import register_gold_views
    register_gold_views(read_gold(spark, gold_root))


def silver_increment(spark: SparkSession, bronze_new: DataFrame, state_root: str, version: int) -> dict:
    """SNK-11: merge newly arrived bronze rows into the kept state of the entities, as ``version``.

    Reads the new rows and, of version - 1, the buckets that hold a key of theirs;
    no bronze row of an earlier delivery is opened.  The touched buckets are
    rewritten, the others are pointed at.  Run again for the same version it
    replaces what it wrote.  ``silver_of_version`` gives the silver tables.
    """
    partials = materialize(silver.entity_partials(bronze_new).withColumn("bucket", versions.bucket_of(*silver.ENTITY_KEYS)), "partials")
    touched = versions.touched_buckets(partials)
    new = partials.drop("bucket")
    before = versions.read_version(spark, state_root, new.schema, version - 1, touched)
    # entities of touched buckets without a new change pass through the merge unchanged
    merged = silver.merge_partials(before.unionByName(new)).select(*[F.col(f.name).cast(f.dataType) for f in new.schema.fields])
    versions.write_version(spark, state_root, merged.withColumn("bucket", versions.bucket_of(*silver.ENTITY_KEYS)), version, touched)
    return {"version": version, "touched": len(touched), "new_files": bronze_new.inputFiles(), "old_files": before.inputFiles()}


def silver_increment_job(spark: SparkSession, bronze_root: str, batches: list[str | int], state_root: str, version: int) -> dict:
    """SNK-11: ``silver_increment`` of the bronze folders of ``batches`` alone."""
    new = src.read_bronze_batches(spark, f"{bronze_root.rstrip('/')}/cdc", batches)
    if sink.skip_if_empty(new):
        return {}
    return silver_increment(spark, new, state_root.rstrip("/"), version)


def partials_of_version(spark: SparkSession, state_root: str, version: int) -> DataFrame:
    return versions.read_version(spark, state_root.rstrip("/"), PARTIALS, version)


def silver_of_version(spark: SparkSession, state_root: str, version: int, latest: bool = False) -> tuple[DataFrame, DataFrame]:
    """Silver users and tasks as of ``version``: a projection of the kept state."""
    ent = silver.entities_of_partials(partials_of_version(spark, state_root, version), latest)
    return silver.users_of(ent), silver.tasks_of(ent)


def silver_stream(bronze_stream: DataFrame, state_root: str, checkpoint: str, available_now: bool = True):
    """STR-08: each micro-batch of a bronze file stream becomes the next version of the kept state.

    The checkpoint remembers which files were seen; a micro-batch run again writes the same version again.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        silver_increment(batch.sparkSession, batch, state_root.rstrip("/"), batch_id + 1)

    return streams.incremental(bronze_stream, merge, checkpoint, available_now)
