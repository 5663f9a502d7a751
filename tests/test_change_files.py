"""Change files that can't be read are set aside; the others of their batch land."""

import gzip
import json
import os

import pytest
from conftest import change, task_image, user_image

from tessera.plans import cli, medallion
from tessera.sources import lake as src


def _files(folder, n, bad=()):
    os.makedirs(folder)
    for i in range(n):
        lines = "\n".join(json.dumps(change("INSERT", 10 * i + k, new=image)) for k, image in enumerate([user_image(uid=str(i)), task_image(uid=str(i))]))
        path = f"{folder}/part-{i:02d}.json.gz"
        with (open if i in bad else gzip.open)(path, "wb") as f:
            f.write(lines.encode())
    return folder


def _run(spark, root, files, **kw):
    return medallion.bronze_files_job(spark, files, f"{root}/bronze", f"{root}/q", "b", **kw)


def _landed(spark, root):
    return sorted(int(r.sequence_number) for r in src.read_bronze(spark, f"{root}/bronze/cdc").collect())


def _numbers(files):
    return sorted(10 * i + k for i in files for k in (0, 1))


def test_bad_files_are_set_aside_and_a_rerun_replaces_all(spark, tmpdir_path):
    files = src.change_files(spark, _files(f"{tmpdir_path}/in", 7, bad=(2, 5)))
    done = _run(spark, tmpdir_path, files, attempts=1)
    assert [os.path.basename(f) for f in done["set_aside"]] == ["part-02.json.gz", "part-05.json.gz"]
    assert done["processed"] == done["records"] == 10 and _landed(spark, tmpdir_path) == _numbers((0, 1, 3, 4, 6))
    aside = spark.read.json(f"{tmpdir_path}/q/files").collect()
    assert len(aside) == 2 and all(r.error for r in aside)
    # mended files: the batch lands whole, nothing of the pieces stays
    mended = src.change_files(spark, _files(f"{tmpdir_path}/mended", 7))
    assert _run(spark, tmpdir_path, mended)["set_aside"] == []
    assert _landed(spark, tmpdir_path) == _numbers(range(7))
    assert not any(n.startswith("batch=") for n in os.listdir(f"{tmpdir_path}/q/files"))


def test_passing_faults_are_tried_again(spark, tmpdir_path, monkeypatch):
    from pyspark.errors import PySparkRuntimeError
    files = src.change_files(spark, _files(f"{tmpdir_path}/in", 3))
    real, calls = medallion.bronze_job, []

    def flaky(changes, *a):
        calls.append(a[2])
        if len(calls) < 3:
            raise PySparkRuntimeError("executors lost")
        return real(changes, *a)
    monkeypatch.setattr(medallion, "bronze_job", flaky)
    done = _run(spark, tmpdir_path, files)
    assert calls == ["b.files-0-3"] * 3 and done["set_aside"] == [] and _landed(spark, tmpdir_path) == _numbers(range(3))


def test_a_fault_of_every_file_is_raised(spark, tmpdir_path):
    files = src.change_files(spark, _files(f"{tmpdir_path}/in", 2, bad=(0, 1)))
    with pytest.raises(medallion.JOB_ERRORS):
        _run(spark, tmpdir_path, files, attempts=1)


def test_a_single_bad_file_no_files_and_the_command(spark, tmpdir_path):
    one = src.change_files(spark, _files(f"{tmpdir_path}/one", 1, bad=(0,)))
    done = _run(spark, f"{tmpdir_path}/a", one, attempts=1)
    assert done["set_aside"] == one and done["records"] == 0
    assert _run(spark, f"{tmpdir_path}/b", [])["records"] == 0
    folder = _files(f"{tmpdir_path}/in", 3, bad=(1,))
    out = cli.run(["bronze", "--changes", folder, "--bronze", f"{tmpdir_path}/c/bronze", "--quarantine", f"{tmpdir_path}/c/q",
                   "--batch", "b", "--set-aside"], spark)
    assert len(out["set_aside"]) == 1 and _landed(spark, f"{tmpdir_path}/c") == _numbers((0, 2))


def test_an_empty_file_is_no_fault(spark, tmpdir_path):
    files = src.change_files(spark, _files(f"{tmpdir_path}/in", 2, bad=(1,)))
    open(f"{tmpdir_path}/in/part-00.json", "w").close()
    done = _run(spark, tmpdir_path, [f"{tmpdir_path}/in/part-00.json", *files], attempts=1)
    assert [os.path.basename(f) for f in done["set_aside"]] == ["part-01.json.gz"] and done["records"] == 2


def test_change_files_are_written_without_sorting_their_lines(spark, tmpdir_path):
    """Each of the query's files is one task's lines as they come, not a folder by number for which the task sorts them."""
    import glob
    from pyspark.sql import functions as F
    from tessera.plans import increment_queries
    from tessera.session import ensure_checkpoint_dir
    spark.range(64).select(F.col("id").alias("event_id"), F.lit("2024-01-02 03:04:05").cast("timestamp").alias("ts"), (F.col("id") % 5).alias("user_id"),
                           F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 3}').alias("props")).write.parquet(f"{tmpdir_path}/events.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/change-files-*"
    before = set(glob.glob(folder))
    got = {str(r.date): r.records for r in increment_queries.bronze_files_set_aside(spark, tmpdir_path).collect()}
    assert got == {"2024-01-02": 56, "None": 1}
    made, = set(glob.glob(folder)) - before
    names = [os.path.relpath(f, made) for f in glob.glob(f"{made}/[wd]*/**", recursive=True) if os.path.basename(f).startswith("part-")]
    assert sorted(os.path.dirname(n) for n in names) == ["damaged"] + ["whole"] * 7
