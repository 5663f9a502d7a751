"""Monitoring windows, streaming twins and the batch jobs writing real layers."""

import os

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL, change, task_image, user_image, write_jsonl
from tessera.operators import cdc, monitor
from tessera.plans import medallion, model, queries as Q
from tessera.sinks import lake as sink
from tessera.sources import fixtures, lake as src
from tessera.streaming import streams


def test_threshold_alarm_missing_period_is_no_breach(spark):
    per = spark.createDataFrame([("2024-01-01 00:00:00", 5), ("2024-01-01 00:05:00", 5),
                                 ("2024-01-01 00:15:00", 5), ("2024-01-01 00:20:00", 1)],
                                "period_start string, v int").withColumn("period_start", F.col("period_start").cast("timestamp"))
    a = monitor.threshold_alarm(per, "v", 3, 2, 300).orderBy("period_start").collect()
    assert [(r.alarm, r.run) for r in a] == [(False, 1), (True, 2), (False, 1), (False, 0)]    # the empty period is no row


def test_slow_runs(spark):
    runs = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 25.0), (4, 12.0)], "started_at int, duration double")
    assert [r.slow for r in monitor.slow_runs(runs).orderBy("started_at").collect()] == [False, False, True, False]


def test_stream_bronze_equals_batch_and_is_idempotent(spark, tmpdir_path):
    recs = [change("INSERT", "1", new=user_image()), change("INSERT", "2", new=task_image()),
            change("REMOVE", "3", old=task_image())]
    src_dir = write_jsonl(os.path.join(tmpdir_path, "in"), recs)
    seen = []
    q = streams.changes_to_bronze_stream(src.read_changes(spark, src_dir, stream=True), os.path.join(tmpdir_path, "bronze"),
                                         os.path.join(tmpdir_path, "quarantine"), os.path.join(tmpdir_path, "ck"),
                                         on_batch=lambda b, c: seen.append(c))
    q.awaitTermination()
    streamed = src.read_bronze(spark, os.path.join(tmpdir_path, "bronze"))
    batch = cdc.changes_to_bronze(src.read_changes(spark, src_dir))
    assert sorted(r.sequence_number for r in streamed.collect()) == sorted(r.sequence_number for r in batch.collect())
    # the watermark moves on in a batch without records
    assert [c for c in seen if c["records"]] == [{"processed": 2, "failed": 0, "skipped": 1, "records": 3, "redelivered": 0}]
    # a restart over the same checkpoint sees no new input and writes nothing more
    q2 = streams.changes_to_bronze_stream(src.read_changes(spark, src_dir, stream=True), os.path.join(tmpdir_path, "bronze"),
                                          os.path.join(tmpdir_path, "quarantine"), os.path.join(tmpdir_path, "ck"))
    q2.awaitTermination()
    assert src.read_bronze(spark, os.path.join(tmpdir_path, "bronze")).count() == 2


def test_stream_bronze_keeps_late_changes(spark, tmpdir_path):
    """Files in their own micro-batches, the later ones days older, after a malformed line; what comes again is dropped."""
    src_dir, seen = os.path.join(tmpdir_path, "in"), []
    files = [[change("INSERT", "1", new=user_image()), change("INSERT", "1", new=user_image())],
             [change("INSERT", "2", new=task_image(), time="2023-12-31T00:00:00Z"), change("INSERT", "1", new=user_image())],
             [change("INSERT", "3", new=user_image("9"), time="2023-11-01T00:00:00Z"), change("REMOVE", "4", old=task_image()),
              change("INSERT", "2", new=task_image(), time="2023-12-31T00:00:00Z")]]
    for n, recs in enumerate(files):
        write_jsonl(src_dir, recs, f"part-{n}.json")
        if n == 0:
            with open(os.path.join(src_dir, "part-0.json"), "a") as f:
                f.write("no record\n")
        q = streams.changes_to_bronze_stream(src.read_changes(spark, src_dir, stream=True), os.path.join(tmpdir_path, "bronze"),
                                             os.path.join(tmpdir_path, "quarantine"), os.path.join(tmpdir_path, "ck"),
                                             on_batch=lambda b, c: seen.append(c))
        q.awaitTermination()
        assert q.exception() is None
    bronze = src.read_bronze(spark, os.path.join(tmpdir_path, "bronze"))
    assert sorted(r.sequence_number for r in bronze.collect()) == ["1", "2", "3"]
    assert [(c["processed"], c["failed"], c["skipped"]) for c in seen if c["records"]] == [(1, 1, 0), (1, 0, 0), (1, 0, 1)]


def test_stream_rollup_equals_batch(spark):
    log = monitor.app_log_from_events(streams.table_stream(spark, SF_SMALL, "events"))
    streamed = streams.replay_to_table(spark, streams.tumbling_rollup(log), "t", output_mode="complete")
    batch = monitor.rollup(monitor.app_log_from_events(fixtures.read_table(spark, SF_SMALL, "events")), "duration_ms")
    key = ["period_start", "samples", "sum", "maximum"]
    assert sorted(streamed.select(*key).collect()) == sorted(batch.select(*key).collect())


CHANGES = "task_id string, status string, sequence_number string, event_time timestamp"


def _change_stream(spark, folder, batches):
    """A file stream with one micro-batch per list of (task, status, sequence, hour of January 2024 or None)."""
    import time as _t
    for i, rows in enumerate(batches):
        rows = [(t, st, q, None if h is None else f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00") for t, st, q, h in rows]
        spark.createDataFrame(rows, "task_id string, status string, sequence_number string, event_time string") \
            .withColumn("event_time", F.col("event_time").cast("timestamp")).coalesce(1).write.parquet(f"{folder}/b{i}")
        _t.sleep(1.1)
    return spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_task_state_machine_orders_changes_of_several_batches(spark, tmpdir_path):
    """Changes wait for the watermark and apply in event order, whatever batch they came in; behind it they are late."""
    s = _change_stream(spark, tmpdir_path, [
        [("a", "in_progress", "3", 5), ("a", "pending", "1", 1), ("b", "pending", "10", 2), ("b", "done?", "9", 2)],
        [("a", "completed", "2", 3), ("a", "completed", "2", 3), ("a", None, "4", 7), ("a", "pending", "5", 8), ("n", "x", None, None)],
        [("z", "end", "99", 100)],
        [("a", "pending", "6", 4), ("a", "pending", "5", 8), ("a", "completed", "7", 101), ("z", "end", "100", 700)]])
    out = streams.replay_to_table(spark, streams.task_state_machine(s, "10 hours"), "sm", rocksdb=True).collect()
    got = sorted((r.task_id, r.sequence_number or "", r.prev_status, r.status, r.accepted, r.late) for r in out)
    assert got == [
        ("a", "1", None, "pending", True, False), ("a", "2", "pending", "completed", True, False),
        ("a", "3", "completed", "in_progress", False, False), ("a", "4", "completed", None, True, False), ("a", "5", None, "pending", True, False),
        ("a", "6", "pending", "pending", False, True), ("a", "7", "pending", "completed", True, False),
        ("b", "10", "done?", "pending", True, False), ("b", "9", None, "done?", True, False),
        ("n", "", None, "x", False, True), ("z", "99", None, "end", True, False)]


def test_task_state_is_bounded(spark, tmpdir_path):
    """What the watermark has passed leaves the list state; a task without changes for ``keep_days`` leaves altogether."""
    s = _change_stream(spark, f"{tmpdir_path}/in", [
        [("a", "s", str(h), h) for h in range(50)], [("b", "s", "1", 200)], [("b", "s", "2", 260)], [("b", "s", "3", 261)]])
    stream = streams.task_state_machine(s, "1 hour", keep_days=2)
    kept = spark.conf.get(*streams.STATE_STORE)
    spark.conf.set(streams.STATE_STORE[0], streams.ROCKSDB)
    try:
        q = stream.writeStream.foreachBatch(lambda b, n: b.count()).option("checkpointLocation", f"{tmpdir_path}/ck").trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
        held = {name: spark.read.format("statestore").option("stateVarName", name).load(f"{tmpdir_path}/ck") for name in ("waiting", "own")}
        assert [r[0][0] for r in held["own"].select("key").collect()] == ["b"]
        assert held["waiting"].count() == 2    # those that the watermark, an hour behind the newest, hasn't passed
    finally:
        spark.conf.set(streams.STATE_STORE[0], kept)


def test_redelivered_changes_and_equal_broken_lines(spark, tmpdir_path):
    """A change again, in the same micro-batch or a later one, is dropped and counted; equal lines without a number are all kept."""
    import time as _t
    old = change("INSERT", "7", new=user_image(), time="2023-12-01T00:00:00Z")
    none = {k: v for k, v in change("INSERT", "8", new=user_image()).items() if k != "eventTime"}
    first = [change("INSERT", "1", new=user_image()), change("INSERT", "1", new=user_image()), change("INSERT", "2", new=user_image()), old, none]
    src_dir, counts = f"{tmpdir_path}/in", []
    for i, recs in enumerate([first, [change("INSERT", "2", new=user_image()), old, none, change("INSERT", "3", new=user_image())]]):
        write_jsonl(src_dir, recs, f"{i}.json")
        with open(f"{src_dir}/{i}.json", "a") as f:
            f.write("broken\n" * 3)
        _t.sleep(1.1)
    q = streams.changes_to_bronze_stream(src.read_changes(spark, src_dir, stream=True, files_per_trigger=1), f"{tmpdir_path}/bronze",
                                         f"{tmpdir_path}/quarantine", f"{tmpdir_path}/ck", on_batch=lambda b, c: counts.append(c))
    q.awaitTermination()
    assert q.exception() is None
    assert sorted(r.sequence_number for r in src.read_bronze(spark, f"{tmpdir_path}/bronze").collect()) == ["1", "2", "3", "7", "8"]
    assert [(c["processed"], c["failed"], c["redelivered"]) for c in counts] == [(4, 3, 1), (1, 3, 3)]
    assert spark.read.json(f"{tmpdir_path}/quarantine").count() == 6
    landed = f"{tmpdir_path}/ck/landed"
    assert {d for d in os.listdir(landed) if d.startswith("day=")} == {"day=2023-12-01", "day=2024-01-01", "day=none"}
    assert streams.forget_landed(spark, landed, 20) == ["2023-12-01"] and "day=none" in os.listdir(landed)


def test_bronze_stream_parses_a_change_once(spark, tmpdir_path, monkeypatch):
    """The keys, the days, the counts and both outputs read one stored copy; a delivery of which nothing is new counts as such."""
    import time as _t
    from pyspark.sql.types import StringType
    passes, counts = spark.sparkContext.accumulator(0), []

    @F.udf(StringType())
    def seen(number):
        passes.add(1)
        return number
    recs = [change("INSERT", str(i), new=user_image(uid=str(i)), time=f"2024-01-0{1 + i % 3}T00:00:00Z") for i in range(9)]
    for i, some in enumerate([recs + recs[:4], recs]):
        write_jsonl(f"{tmpdir_path}/in", some, f"{i}.json")
        _t.sleep(1.1)
    changes = src.read_changes(spark, f"{tmpdir_path}/in", stream=True, files_per_trigger=1)
    parsed = changes.withColumn("dynamodb", F.col("dynamodb").withField("SequenceNumber", seen.asNondeterministic()("dynamodb.SequenceNumber")))
    q = streams.changes_to_bronze_stream(parsed, f"{tmpdir_path}/bronze", f"{tmpdir_path}/q", f"{tmpdir_path}/ck", on_batch=lambda b, c: counts.append(c))
    q.awaitTermination()
    assert q.exception() is None
    assert [(c["records"], c["processed"], c["redelivered"]) for c in counts] == [(9, 9, 4), (0, 0, 9)]
    assert src.read_bronze(spark, f"{tmpdir_path}/bronze").count() == 9 and passes.value == 22


def test_not_landed_runs_again_alike_and_opens_its_days_only(spark, tmpdir_path):
    recs = [change("INSERT", str(i), new=user_image(), time=f"2024-01-0{1 + i % 3}T00:00:00Z") for i in range(9)]
    batch = src.read_changes(spark, write_jsonl(f"{tmpdir_path}/d", recs))
    for _ in range(2):
        assert streams.not_landed(batch, 0, f"{tmpdir_path}/landed").count() == 9
    later = batch.filter(F.to_date("eventTime") == "2024-01-02")
    again = streams.not_landed(later, 1, f"{tmpdir_path}/landed")
    assert again.count() == 0
    files = [f for f in again.inputFiles() if "/landed/" in f]
    assert files and all("/day=2024-01-02/" in f for f in files)


@pytest.mark.parametrize("parts", [1, 7])
def test_exact_percentiles_open_only_the_partitions_of_their_ranks(spark, parts):
    import numpy as np
    r = np.random.default_rng(parts)
    rows = [(k, float(v)) for k in ("a", "b", None) for v in r.integers(0, 400, 300)] + [("hot", 5.0)] * 800 + [("one", 7.25), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {x.k: (x.p50, x.p95, x.p99) for x in monitor.exact_percentiles(df, "v", monitor.PERCENTILES, "k").collect()}
        whole = monitor.exact_percentiles(df.select("v"), "v", monitor.PERCENTILES).first()
        empty = monitor.exact_percentiles(df.limit(0), "v", monitor.PERCENTILES).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    for k in {x[0] for x in rows}:
        own = [v for q, v in rows if q == k and v is not None]
        assert got[k] == (pytest.approx(tuple(np.percentile(own, [50, 95, 99]))) if own else (None, None, None))
    assert tuple(whole) == pytest.approx(tuple(np.percentile([v for _, v in rows if v is not None], [50, 95, 99])))
    assert [tuple(x) for x in empty] == [(None, None, None)]


def test_alarm_islands_across_slices(spark, monkeypatch):
    """Runs go on over slices of any size; a period far away adds its own row and no other."""
    import random
    r = random.Random(2)
    for size in (1, 2, 5, 1024):
        monkeypatch.setattr(monitor, "SLICE_PERIODS", size)
        rows = [(k, p, r.random() < 0.8) for k in ("x", "y") for p in range(100, 160) if r.random() < 0.9] + [("x", 0, True)]
        df = spark.createDataFrame([(k, p * 300, float(b)) for k, p, b in rows], "k string, s long, v double") \
            .select("k", F.timestamp_seconds("s").alias("period_start"), "v")
        got = {(x.k, int(x.period_start.timestamp()) // 300): (x.breach, x.run, x.alarm) for x in
               monitor.threshold_alarm(df, "v", 0.5, 3, 300, ["k"]).collect()}
        assert len(got) == len(rows)
        on = {(k, p) for k, p, b in rows if b}
        for k, p, b in rows:
            run = 0
            while (k, p - run) in on:
                run += 1
            assert got[k, p] == (int(b), run, run >= 3)


def test_sliding_active_users_exact_and_sketched(spark, tmpdir_path):
    import random
    from datetime import date, timedelta
    r = random.Random(8)
    rows = [(r.randint(1, 4000), date(2024, 1, 1) + timedelta(r.choice([0, 1, 2, 3, 9, 10, 40]))) for _ in range(6000)]
    df = spark.createDataFrame([(u, f"{d} 10:00:00") for u, d in rows] + [(None, "2024-01-01 00:00:00")], "user_id long, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    want = {}
    for u, d in rows:
        for i in range(5):
            want.setdefault(d + timedelta(i), set()).add(u)
    exact = {x.last_day: x.active_users for x in monitor.sliding_active_users(df, "ts", "user_id", 5).collect()}
    assert exact == {d: len(u) for d, u in want.items()}
    df.write.parquet(f"{tmpdir_path}/in")
    s = spark.readStream.schema(df.schema).parquet(f"{tmpdir_path}/in")
    panes = streams.replay_to_table(spark, streams.daily_active_sketches(s), "panes", "update", "day")
    assert panes.count() == 7    # a row a day of activity, whatever the window
    sketched = {x.last_day: x.active_users for x in streams.sliding_active_users(panes, 5).collect()}
    assert sketched.keys() == exact.keys()
    assert all(abs(sketched[d] - n) <= 0.03 * n for d, n in exact.items())


def test_medallion_jobs_and_sql(spark, tmpdir_path):
    changes = fixtures.event_changes(spark, SF_SMALL)
    for _ in range(2):  # the same batch again replaces itself
        done = medallion.bronze_job(changes, os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "q"), "b1", F.col("eventTime"))
    assert done["failed"] == 0 and done["processed"] == src.read_bronze(spark, done["bronze"]).count()
    paths = medallion.silver_job(spark, os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "silver"))
    assert set(paths) == {"cdc", "users", "tasks"}
    medallion.gold_job(spark, os.path.join(tmpdir_path, "silver"), os.path.join(tmpdir_path, "gold"))
    lazy, kept = model.event_model(spark, SF_SMALL), medallion.read_gold(spark, os.path.join(tmpdir_path, "gold"))
    for q in (Q.q03_top_active_users, Q.q07_status_distribution, Q.q16_system_health):
        assert sorted(q(kept).collect()) == sorted(q(lazy).collect())
    medallion.register_gold(spark, os.path.join(tmpdir_path, "gold"))
    assert spark.sql("SELECT * FROM task_analytics_user_metrics").count() == lazy.user_metrics.count()
    # rerunning silver overwrites: same row count, no duplication
    n = src.read_silver(spark, os.path.join(tmpdir_path, "silver"), "tasks").count()
    medallion.silver_job(spark, os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "silver"))
    assert src.read_silver(spark, os.path.join(tmpdir_path, "silver"), "tasks").count() == n
    inv = {(r.layer, r.prefix): r.files for r in src.layer_inventory(
        spark, {"silver": os.path.join(tmpdir_path, "silver"), "gold": os.path.join(tmpdir_path, "gold")}).collect()}
    assert inv[("silver", "users")] > 0 and ("gold", "user_analytics") in inv


def test_empty_bronze_reads_and_skips(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "bronze", "cdc"))
    assert src.read_bronze(spark, os.path.join(tmpdir_path, "bronze", "cdc")).count() == 0
    assert medallion.silver_job(spark, os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "s")) == {}
    assert sink.skip_if_empty(spark.range(0))


def test_idempotency_stream_chains_windows(spark, tmpdir_path):
    day = 86400
    base = 1_700_000_000
    reqs = [("r1", base), ("r1", base + 100), ("r1", base + day), ("r1", base + day + 1), ("r1", base + day + 50),
            ("r1", base + 2 * day + 2), ("r2", base + 5), ("r2", base + 5 + day + 1)]
    d = os.path.join(tmpdir_path, "reqs")
    spark.createDataFrame(reqs, "request_id string, ts_epoch long").write.parquet(d)
    s = spark.readStream.schema("request_id string, ts_epoch long").parquet(d)
    got = {(r.request_id, r.ts_epoch): r.replay for r in
           streams.replay_to_table(spark, streams.idempotency_stream(s), "idem", rocksdb=True).collect()}
    # brute force: check-then-store per request in time order
    want, live = {}, {}
    for rid, ts in sorted(reqs, key=lambda x: (x[0], x[1])):
        exp = live.get(rid)
        if exp is not None and ts <= exp:
            want[(rid, ts)] = True
        else:
            live[rid] = ts + day
            want[(rid, ts)] = False
    assert got == want
    assert got[("r1", base + day + 1)] is False and got[("r1", base + day + 50)] is True


def test_idempotency_state_expires(spark, tmpdir_path):
    """Keys past their life and the delay leave the state; a later request makes a new key."""
    import time as _t
    day = 86400
    d = os.path.join(tmpdir_path, "reqs")
    os.makedirs(d)
    base = 1_700_000_000
    for i, rows in enumerate([[("a", 0), ("b", 10)], [("c", 2 * day)], [("d", 2 * day + 10)], [("a", 2 * day + 20), ("c", 2 * day + 30)],
                              [("b", 20), ("e", day), ("q", 2 * day + 8000)], [("c", 2 * day + 31), ("z", 9 * day)]]):
        spark.createDataFrame([(k, base + t) for k, t in rows], "request_id string, ts_epoch long").coalesce(1).write.parquet(f"{d}/p{i}")
        _t.sleep(1.1)
    s = spark.readStream.schema("request_id string, ts_epoch long").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(d)
    out = streams.replay_to_table(spark, streams.idempotency_stream(s), "idem-late", rocksdb=True)
    got = {(r.request_id, r.ts_epoch - base): (r.replay, r.late) for r in out.collect()}
    assert got == {("a", 0): (False, False), ("b", 10): (False, False), ("c", 2 * day): (False, False), ("d", 2 * day + 10): (False, False),
                   ("a", 2 * day + 20): (False, False), ("c", 2 * day + 30): (True, False),
                   # later than the delay: answered by a key that lived then, else unknown; none is left out, none makes a key
                   ("c", 2 * day + 31): (True, True), ("b", 20): (None, True), ("e", day): (None, True), ("q", 2 * day + 8000): (False, False), ("z", 9 * day): (False, False)}


def _held(spark, stream, checkpoint, *names):
    """Rows of state that a stream run to its end holds, by state variable, and how many rows it put out."""
    kept, out = spark.conf.get(*streams.STATE_STORE), []
    spark.conf.set(streams.STATE_STORE[0], streams.ROCKSDB)
    try:
        q = stream.writeStream.foreachBatch(lambda b, n: out.append(b.count())).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        assert q.exception() is None
        held = {n: spark.read.format("statestore").option("stateVarName", n).load(checkpoint).count() for n in names}
    finally:
        spark.conf.set(streams.STATE_STORE[0], kept)
    return held, sum(out)


def test_idempotency_groups_share_state_and_give_the_same_rows(spark, tmpdir_path):
    """Ids dealt into groups: one timer and one call a group; rows as with a state per id, late requests and expired keys too."""
    import random
    import time as _t
    r, base = random.Random(4), 1_700_000_000
    for i in range(3):
        rows = [(f"r{r.randrange(30)}", base + r.randrange(max(0, i - 1) * 90_000, (i + 1) * 90_000)) for _ in range(100)] + [(None, base + i)]
        spark.createDataFrame(rows, "request_id string, ts_epoch long").coalesce(1).write.parquet(f"{tmpdir_path}/in/p{i}")
        _t.sleep(1.1)
    s = spark.readStream.schema("request_id string, ts_epoch long").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(f"{tmpdir_path}/in")
    rows = {g: sorted(map(str, streams.replay_to_table(spark, streams.idempotency_stream(s, groups=g), "g", rocksdb=True).collect())) for g in (None, 2)}
    assert rows[2] == rows[None] and any("late=True" in x for x in rows[2])
    held, n = _held(spark, streams.idempotency_stream(s, groups=2), f"{tmpdir_path}/ck", "timer", "keys")
    assert n == 303 and held["timer"] == 2 < held["keys"]


def test_task_groups_share_state_and_give_the_same_rows(spark, tmpdir_path):
    """Tasks dealt into groups: one timer and one call a group; rows as with a state per task, late and forgotten ones too."""
    import random
    r = random.Random(6)
    batches = [[(f"t{r.randrange(12)}", r.choice(["pending", "completed", None]), str(100 * i + n), r.randrange(max(0, 20 * i - 15), 20 * i + 20))
                for n in range(60)] + [(None, "x", str(90 + i), None)] for i in range(3)] + [[("t1", "end", "999", 740)]]
    s = _change_stream(spark, f"{tmpdir_path}/in", batches)
    rows = {g: sorted(map(str, streams.replay_to_table(spark, streams.task_state_machine(s, "10 hours", groups=g), "g", rocksdb=True).collect()))
            for g in (None, 2)}
    assert rows[2] == rows[None] and any("late=True" in x for x in rows[2]) and any("accepted=False, late=False" in x for x in rows[2])
    held, n = _held(spark, streams.task_state_machine(s, "10 hours", groups=2), f"{tmpdir_path}/ck", "timer", "own")
    assert n == len(rows[2]) and held["timer"] <= 2 < held["own"]


def test_cli_end_to_end(spark, tmpdir_path):
    from conftest import change, task_image, user_image, write_jsonl
    from tessera.plans import cli
    ch = write_jsonl(os.path.join(tmpdir_path, "changes"), [
        change("INSERT", "1", new=user_image(uid="u1", email="a@x.io")),
        change("INSERT", "2", new=task_image(uid="u1", tid="t1")),
        change("MODIFY", "3", new=task_image(uid="u1", tid="t1", status="completed"))])
    root = lambda n: os.path.join(tmpdir_path, n)
    made = cli.run(["bronze", "--changes", ch, "--bronze", root("bronze"), "--quarantine", root("q"), "--batch", "1"], spark)
    assert (made["processed"], made["failed"]) == (3, 0)
    cli.run(["silver", "--bronze", root("bronze"), "--silver", root("silver"), "--latest"], spark)
    cli.run(["gold", "--silver", root("silver"), "--gold", root("gold")], spark)
    cli.run(["sql", "--gold", root("gold"), "--query", "q16_system_health", "--out", root("out")], spark)
    assert {r.metric: r.value for r in spark.read.parquet(root("out")).collect()} == {"total_users": 1, "total_tasks": 1, "completed_tasks": 1}
    cli.run(["sql", "--gold", root("gold"), "--text", "SELECT count(*) AS n FROM user_analytics", "--out", root("out2")], spark)
    assert spark.read.parquet(root("out2")).first().n == 1


def _deliveries(spark, root, first=1):
    from conftest import change, task_image, write_jsonl
    days = [[change("INSERT", "1", new=task_image(tid="a"), time="2024-01-01T10:00:00Z"),
             change("INSERT", "2", new=task_image(tid="b"), time="2024-01-01T11:00:00Z")],
            [change("MODIFY", "3", new=task_image(tid="a", status="completed"), time="2024-01-02T10:00:00Z")],
            [change("MODIFY", "0", new=task_image(tid="a", status="in_progress"), time="2024-01-01T09:00:00Z")]]
    for n, changes in enumerate(days, first):
        made = medallion.bronze_job(src.read_changes(spark, write_jsonl(root(f"c{n}"), changes)), root("bronze"), root("q"), n, F.col("eventTime"))
        yield n, made


def test_silver_increment_job(spark, tmpdir_path):
    """Each delivery opens its own bronze files and the touched buckets, nothing older; run again it changes nothing."""
    from tessera.operators import silver
    from tessera.sinks import versions
    root = lambda n: os.path.join(tmpdir_path, n)
    for n, _ in _deliveries(spark, root):
        out = medallion.silver_increment_job(spark, root("bronze"), [n], root("state"), n)
        assert out["new_files"] and all(f"/batch={n}/" in f for f in out["new_files"])
        assert out["touched"] == (2 if n == 1 else 1)
        assert all("/state/data/version=" in f for f in out["old_files"]) and len(out["old_files"]) == (0 if n == 1 else 1)
    assert sorted(versions.manifest(spark, root("state"), 3).values()) == [1, 3]    # b's bucket is pointed at, a's was rewritten
    medallion.silver_increment_job(spark, root("bronze"), [3], root("state"), 3)
    for latest in (False, True):
        users, tasks = medallion.silver_of_version(spark, root("state"), 3, latest)
        whole = silver.tasks_of(silver.silver_entities(src.read_bronze(spark, root("bronze") + "/cdc"), latest))
        assert sorted(tasks.collect()) == sorted(whole.collect()) and users.count() == 0
    assert {r.task_id: r.status for r in medallion.silver_of_version(spark, root("state"), 2, True)[1].collect()} == {"a": "completed", "b": "pending"}


def test_silver_stream_merges_each_micro_batch(spark, tmpdir_path):
    from tessera.operators import silver
    root = lambda n: os.path.join(tmpdir_path, n)
    for n, _ in _deliveries(spark, root):
        medallion.silver_stream(src.read_bronze_stream(spark, root("bronze") + "/cdc"), root("state"), root("ck")).awaitTermination()
        _, tasks = medallion.silver_of_version(spark, root("state"), n)
        whole = silver.tasks_of(silver.silver_entities(src.read_bronze(spark, root("bronze") + "/cdc")))
        assert sorted(tasks.collect()) == sorted(whole.collect())


def test_late_rows_past_watermark_are_dropped(spark, tmpdir_path):
    import time as _t
    d = os.path.join(tmpdir_path, "log")
    os.makedirs(d)
    # Spark drops late rows once their window's state is evicted (it does not
    # promise to drop earlier): batch 1 moves the watermark to 00:15, batch 2
    # evicts the 00:00 window, batch 3 brings a row for it -> dropped.
    batches = [["2024-01-01 00:01:00", "2024-01-01 00:02:00", "2024-01-01 00:07:00"],
               ["2024-01-01 00:20:00"],
               ["2024-01-01 00:25:00"],
               ["2024-01-01 00:01:30"]]
    for i, ts in enumerate(batches):
        spark.createDataFrame([(t, 10) for t in ts], "timestamp string, duration_ms long") \
            .withColumn("timestamp", F.col("timestamp").cast("timestamp")) \
            .coalesce(1).write.parquet(os.path.join(d, f"part{i}"))
        _t.sleep(1.1)
    s = spark.readStream.schema("timestamp timestamp, duration_ms long").option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(d)
    out = streams.replay_to_table(spark, streams.tumbling_rollup(s, delay="5 minutes"), "late", output_mode="update")
    first_window = [r.samples for r in out.collect() if str(r.period_start).startswith("2024-01-01 00:00")]
    assert first_window == [2]
