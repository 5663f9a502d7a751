"""Mutations, idempotency, isolation and transitions as batch operators."""

from pyspark.sql import functions as F

from tessera.operators import mutate

TASK_COLS = "user_id string, task_id string, title string, status string, priority string, updated_at long"


def _tasks(spark):
    return spark.createDataFrame([("u1", "t1", "A", "pending", "low", 100),
                                  ("u1", "t2", "B", "completed", "high", 100),
                                  ("u2", "t3", "C", "in_progress", "medium", 100)], TASK_COLS)


def test_partial_update_guard_and_not_found(spark):
    upd = spark.createDataFrame([("u1", "t1", None, "in_progress", 1), ("u1", "t1", "A2", None, 2),
                                 ("u1", "t2", None, "pending", 3), ("u9", "t9", "X", None, 4)],
                                "user_id string, task_id string, title string, status string, seq int")
    out, not_found, rejected = mutate.update_tasks(_tasks(spark), upd, F.lit(200).cast("bigint"))
    rows = {r.task_id: r for r in out.collect()}
    assert rows["t1"].title == "A2" and rows["t1"].status == "in_progress" and rows["t1"].updated_at == 200
    assert rows["t2"].status == "completed" and rows["t2"].updated_at == 100
    assert rows["t3"].updated_at == 100
    assert [r.task_id for r in not_found.collect()] == ["t9"]
    assert [r.task_id for r in rejected.collect()] == ["t2"]


def test_user_update_keeps_updated_at(spark):
    users = spark.createDataFrame([("u1", "a@x.io", "Ann", 5)], "user_id string, email string, name string, updated_at long")
    upd = spark.createDataFrame([("u1", None, "Anna", 1), ("u7", "z@x.io", None, 2)],
                                "user_id string, email string, name string, seq int")
    out, missing = mutate.update_users(users, upd)
    r = out.first()
    assert (r.email, r.name, r.updated_at) == ("a@x.io", "Anna", 5)
    assert [m.user_id for m in missing.collect()] == ["u7"]


def test_deletes(spark):
    dels = spark.createDataFrame([("u1", "t1"), ("u1", "t404")], "user_id string, task_id string")
    left, missing = mutate.delete_tasks(_tasks(spark), dels)
    assert sorted(r.task_id for r in left.collect()) == ["t2", "t3"]
    assert [r.task_id for r in missing.collect()] == ["t404"]
    assert mutate.delete_completed(_tasks(spark)).count() == 2


def test_bulk_status_keeps_terminal_guard(spark):
    out = mutate.bulk_set_status(_tasks(spark), F.col("user_id") == "u1", "cancelled", F.lit(300).cast("bigint"))
    st = {r.task_id: r.status for r in out.collect()}
    assert st == {"t1": "cancelled", "t2": "completed", "t3": "in_progress"}


def test_idempotency_expiry_by_one_second(spark):
    keys = spark.createDataFrame([("r1", 1000, 1000 + 86400)], "request_id string, created_at long, expiration_timestamp long")
    reqs = spark.createDataFrame([("r1", 1000 + 86400, 1), ("r1", 1000 + 86401, 2), ("r2", 5000, 3)],
                                 "request_id string, ts_epoch long, n int")
    replays, fresh = mutate.replay_split(reqs, keys)
    assert [r.n for r in replays.collect()] == [1]
    assert sorted(r.n for r in fresh.collect()) == [2, 3]
    assert mutate.expire_keys(keys, F.lit(1000 + 86400)).count() == 1
    assert mutate.expire_keys(keys, F.lit(1000 + 86401)).count() == 0


def test_store_idempotency_and_targets(spark):
    req = spark.createDataFrame([("u1:abc", "u1", "t1", 201, 1000)],
                                "request_id string, user_id string, task_id string, http_status_code int, ts_epoch long") \
        .withColumn("response", F.struct(F.lit("t1").alias("id")))
    keys = mutate.store_idempotency(req)
    k = keys.first()
    assert k.expiration_timestamp == 1000 + 86400 and k.target_task_pk == "TASK#u1" and k.response_data == '{"id":"t1"}'
    state = spark.createDataFrame([("TASK#u1", "TASK#t1", "A", "pending")], "PK string, SK string, title string, status string")
    hit, dangling = mutate.keys_with_targets(keys, state)
    assert hit.count() == 1 and dangling.count() == 0


def test_isolation_violations(spark):
    acc = spark.createDataFrame([("u1", "t1"), ("u2", "t1"), ("u2", "t404")], "user_id string, task_id string")
    v = mutate.isolation_violations(acc, _tasks(spark)).collect()
    assert [(r.user_id, r.task_id) for r in v] == [("u2", "t1")]


def test_current_state_out_of_order_and_remove(spark):
    ch = spark.createDataFrame([
        ("MODIFY", "2024-01-01 00:00:02", "2", "TASK#u", "TASK#a", "done"),
        ("INSERT", "2024-01-01 00:00:01", "1", "TASK#u", "TASK#a", "new"),
        ("INSERT", "2024-01-01 00:00:01", "3", "TASK#u", "TASK#b", "x"),
        ("REMOVE", "2024-01-01 00:00:05", "4", "TASK#u", "TASK#b", None),
    ], "event_name string, processed_at string, sequence_number string, PK string, SK string, status string")
    ch = ch.select("event_name", F.col("processed_at").cast("timestamp").alias("processed_at"), "sequence_number",
                   F.struct("PK", "SK", "status").alias("data"))
    state = mutate.current_state(ch.withColumn("data", F.struct(
        *[F.col(f"data.{c}") if c in ("PK", "SK", "status") else F.lit(None).cast(t).alias(c)
          for c, t in [(f.name, f.dataType) for f in __import__("tessera.schemas", fromlist=["ITEM"]).ITEM.fields]])))
    rows = state.collect()
    assert [(r.SK, r.status) for r in rows] == [("TASK#a", "done")]


def test_transitions(spark):
    tc = spark.createDataFrame([
        ("a", "pending", "2024-01-01 00:00:01", "1"), ("a", "completed", "2024-01-01 00:00:02", "2"),
        ("a", "in_progress", "2024-01-01 00:00:03", "3"), ("a", "pending", "2024-01-01 00:00:04", "4"),
    ], "task_id string, status string, processed_at string, sequence_number string") \
        .withColumn("processed_at", F.col("processed_at").cast("timestamp"))
    assert [r.sequence_number for r in mutate.lag_transitions(tc).collect()] == ["3"]


def test_updates_fold_in_order_and_null_status_is_found(spark):
    tasks = spark.createDataFrame([("u", "a", "t", "pending", 1), ("u", "b", "t", None, 1), ("u", "c", "t", "completed", 1)],
                                  "user_id string, task_id string, title string, status string, updated_at long")
    ups = spark.createDataFrame([("u", "a", None, "completed", 1), ("u", "a", "late title", "pending", 2), ("u", "a", "title", None, 3),
                                 ("u", "b", "found", None, 1), ("u", "c", None, "completed", 1), ("u", "x", "gone", None, 1)],
                                "user_id string, task_id string, title string, status string, seq int")
    out, missing, rejected = mutate.update_tasks(tasks, ups, F.lit(9).cast("bigint"))
    got = {r.task_id: (r.title, r.status, r.updated_at) for r in out.collect()}
    assert got == {"a": ("title", "completed", 9), "b": ("found", None, 9), "c": ("t", "completed", 9)}
    assert [r.task_id for r in missing.collect()] == ["x"] and [r.seq for r in rejected.collect()] == [2]


def test_delete_users_is_silent_when_absent(spark):
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    gone = spark.createDataFrame([("b",), ("z",)], "user_id string")
    assert [r.user_id for r in mutate.delete_users(users, gone).collect()] == ["a"]


def test_put_items_last_wins(spark):
    from tessera.schemas import ITEM
    cols = [f.name for f in ITEM.fields]
    empty = spark.createDataFrame([], ITEM)
    items = spark.createDataFrame([("TASK#u", "TASK#a", "first", 1), ("TASK#u", "TASK#a", "second", 2)],
                                  "PK string, SK string, title string, seq int")
    for f in ITEM.fields:
        if f.name not in items.columns:
            items = items.withColumn(f.name, F.lit(None).cast(f.dataType))
    out = mutate.put_items(empty, items, F.lit(99).cast("bigint")).collect()
    assert len(out) == 1 and out[0].title == "second" and out[0].created_at == 99 and len(cols) == len(out[0])


def test_previous_status_buckets_equal_plain_lag(spark):
    from pyspark.sql import Window
    rows = [("a", s, f"2024-01-01 00:00:{sec:02d}", str(i)) for i, (s, sec) in enumerate(
        [("pending", 1), ("completed", 1), ("in_progress", 5), (None, 9), ("pending", 9), ("completed", 30)])]
    rows += [("b", "pending", "2024-01-01 00:00:03", "100"), ("b", "completed", "2024-01-01 00:00:40", "101")]
    tc = spark.createDataFrame(rows, "task_id string, status string, processed_at string, sequence_number string") \
        .withColumn("processed_at", F.col("processed_at").cast("timestamp"))
    got = {r.sequence_number: r.prev_status for r in mutate.previous_status(tc, bucket_seconds=2).collect()}
    w = Window.partitionBy("task_id").orderBy("processed_at", F.col("sequence_number").cast("int"))
    want = {r.sequence_number: r.p for r in tc.select("sequence_number", F.lag("status").over(w).alias("p")).collect()}
    assert got == want


def test_bulk_status_only_status_and_user_scoped_delete(spark):
    out = mutate.bulk_set_status(_tasks(spark), F.lit(True), "cancelled", F.lit(300).cast("bigint"), only_status="pending")
    st = {r.task_id: (r.status, r.updated_at) for r in out.collect()}
    assert st == {"t1": ("cancelled", 300), "t2": ("completed", 100), "t3": ("in_progress", 100)}
    left = mutate.delete_completed(_tasks(spark), F.col("user_id") == "u2")
    assert left.count() == 3
    left = mutate.delete_completed(_tasks(spark), F.col("user_id") == "u1")
    assert sorted(r.task_id for r in left.collect()) == ["t1", "t3"]


def test_keys_chained_by_jumps_equal_the_fold(spark, monkeypatch):
    """Random times of several ids, one of them with a third of all rows over a year, gaps of many lives, and times at the very expiry."""
    import random
    r = random.Random(3)
    day = 86400
    rows = [("hot", r.randint(0, 365 * day)) for _ in range(1500)] + [(f"i{r.randint(0, 40)}", r.randint(0, 20 * day)) for _ in range(1500)]
    rows += [("edge", t) for t in (0, day, day + 1, 2 * day + 1, 2 * day + 2, 3 * day + 3, 50 * day, 51 * day + 1)] + [("one", 7), ("one", 7)]
    df = spark.createDataFrame(rows, "request_id string, ts_epoch long")
    want = {}
    for rid, t in sorted(rows):
        own = want.setdefault(rid, [])
        if not own or t > own[-1] + day:
            own.append(t)
    want = sorted((k, t, t + day) for k, own in want.items() for t in own)
    assert sorted(map(tuple, mutate.chained_by_jumps(df).collect())) == want
    monkeypatch.setattr(mutate, "FOLD_REQUESTS", 1000)
    assert sorted(map(tuple, mutate.chained_keys(df).collect())) == want
    assert mutate.chained_by_jumps(df.limit(0)).count() == 0


def test_copy_on_write_rewrites_the_touched_range_alone(spark, tmpdir_path):
    from tessera.sinks import versions
    root = f"{tmpdir_path}/t"
    tasks = spark.range(1000).select(F.col("id").alias("task_id"), F.lit("A").alias("title"), F.lit("pending").alias("status"),
                                     F.lit(0).cast("bigint").alias("updated_at"))
    bounds = versions.range_bounds(tasks, "task_id", 10)
    bucket = versions.range_bucket("task_id", bounds)
    versions.write_version(spark, root, tasks.withColumn("bucket", bucket), 1, ())
    low = bounds[4]
    upd = spark.range(low, low + 10).select(F.col("id").alias("task_id"), F.col("id").alias("seq"), F.lit("completed").alias("status"),
                                            F.lit(None).cast("string").alias("title"))
    change = lambda rows, req: mutate.update_tasks(rows, req, F.lit(9).cast("bigint"), key=("task_id",))[0]
    for _ in range(2):    # run again it starts from the version before
        done = versions.rewrite(spark, root, tasks.schema, 2, bucket, upd, change)
        assert done["touched"] == [5] and all("/version=1/bucket=5/" in f for f in done["read"])
    listed = versions.manifest(spark, root, 2)
    assert {b for b, w in listed.items() if w == 2} == {5} and len(listed) == len(bounds) + 1
    new = versions.read_version(spark, root, tasks.schema, 2)
    assert new.count() == 1000 and new.filter("status = 'completed' and updated_at = 9").count() == 10
    assert versions.read_version(spark, root, tasks.schema, 1).filter("status = 'completed'").count() == 0
    # a range that loses all its rows leaves the table
    versions.rewrite(spark, root, tasks.schema, 3, bucket, upd, lambda rows, req: rows.limit(0))
    assert 5 not in versions.manifest(spark, root, 3)


def test_trigram_index_equals_the_scan_and_opens_few_buckets(spark, tmpdir_path):
    from tessera.operators import lookup, textindex
    rows = [(i, f"Task {i}", f"Étude of user {i % 7}") for i in range(300)] + [(300, None, None), (301, "", "ab"), (302, "xTASK", None)]
    df = spark.createDataFrame(rows, "id long, title string, description string")
    textindex.write_index(df, f"{tmpdir_path}/x", "id", "title", "description")
    for pattern in ("task 1", "TASK", "étude", "r 3", "ab", "", "t", "none such", "k 2é", "299\nét"):
        got = sorted(r.id for r in textindex.search(df, f"{tmpdir_path}/x", "id", pattern, "title", "description").collect())
        assert got == sorted(r.id for r in lookup.search_tasks(df, pattern).collect()), pattern
    import re
    opened = textindex.candidates(spark, f"{tmpdir_path}/x", "task 1", "bigint")
    plan = opened._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[.*bucket", plan)
