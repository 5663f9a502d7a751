"""Remaining lookups, views, monitors and user/idempotency helpers."""

from pyspark.sql import functions as F

from tessera.functions import keys as K
from tessera.operators import lookup, monitor, mutate, quality
from tessera.schemas import ITEM


def _items(spark, rows):
    df = spark.createDataFrame(rows, "PK string, SK string, due_date string, priority string, category string, "
                                     "status string, created_at long")
    for f in ITEM.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    tk = K.task_keys(F.split("PK", "#")[1], F.split("SK", "#")[1], F.col("status"), F.col("priority"),
                     F.col("category"), F.col("due_date"))
    for n in ["GSI1PK", "GSI1SK", "GSI2PK", "GSI2SK", "GSI3PK", "GSI3SK", "GSI4PK", "GSI4SK"]:
        df = df.withColumn(n, F.when(F.col("PK").startswith("TASK#"), tk[n]))
    return df


def test_index_lookups_views_and_bulk_get(spark):
    st = _items(spark, [("TASK#u", "TASK#a", "2024-02-01", "high", "work", "pending", 1704067200),
                        ("TASK#u", "TASK#b", None, "low", None, "completed", 1704067200),
                        ("TASK#v", "TASK#c", "2024-02-01", "high", "work", "pending", 1704067200),
                        ("USER#u", "METADATA", None, None, None, None, 1704067200)])
    assert [r.SK for r in lookup.tasks_by_due_date(st, "u", "2024-02-01").collect()] == ["TASK#a"]
    assert [r.SK for r in lookup.tasks_by_due_date(st, "u", "none").collect()] == ["TASK#b"]
    assert [r.SK for r in lookup.tasks_by_priority(st, "u", "high").collect()] == ["TASK#a"]
    assert [r.SK for r in lookup.tasks_by_category(st, "u", "none").collect()] == ["TASK#b"]
    assert lookup.with_prefix(st, "USER#").count() == 1 and lookup.all_users(st).count() == 1
    keys = spark.createDataFrame([("TASK#u", "TASK#b"), ("TASK#x", "TASK#y")], "PK string, SK string")
    assert [r.SK for r in lookup.get_items(st, keys).collect()] == ["TASK#b"]
    assert [r.SK for r in lookup.tasks_of_user(st, "u").collect()] == ["TASK#a", "TASK#b"]
    u = lookup.user_view(st).first()
    assert u.id == "u" and str(u.created_at) == "2024-01-01 00:00:00"


def test_idempotency_view(spark):
    df = spark.createDataFrame([("IDEMPOTENCY#r1", "METADATA", "{}", "TASK#u", "TASK#a", "201", "1000", 5)],
                               "PK string, SK string, response_data string, target_task_pk string, target_task_sk string, "
                               "http_status_code string, expiration_timestamp string, created_at long")
    r = lookup.idempotency_view(df).first()
    assert (r.request_id, r.http_status_code, r.expiration_timestamp) == ("r1", 201, 1000)


def test_users_from_requests(spark):
    users = spark.createDataFrame([("u1", "a@x.io", "A", 1, 1)], "user_id string, email string, name string, "
                                                                 "created_at long, updated_at long")
    seen = spark.createDataFrame([("u1", "a@x.io", "A", 5), ("u2", "b@x.io", "B", 9), ("u2", "b2@x.io", "B2", 7)],
                                 "user_id string, email string, name string, ts_epoch long")
    allu, created = mutate.create_users_if_absent(users, seen)
    c = created.collect()
    assert [(r.user_id, r.email, r.created_at) for r in c] == [("u2", "b2@x.io", 7)] and allu.count() == 2
    assert [r.user_id for r in mutate.reject_duplicate_users(users, seen.select("user_id").distinct()).collect()] == ["u1"]


def test_request_replays_chain(spark):
    day = 86400
    reqs = [("r", 10), ("r", 5), ("s", 7), ("r", 5 + day), ("r", 6 + day), ("r", 6 + day), ("r", 7 + 2 * day), ("r", 5)]
    rows = [(a, t, i) for i, (a, t) in enumerate(reqs)]
    got = {r.n: r.replay for r in mutate.request_replays(spark.createDataFrame(rows, "request_id string, ts_epoch long, n long"), "n").collect()}
    live, want = {}, {}
    for a, t, i in sorted(rows):
        want[i] = a in live and t <= live[a]
        if not want[i]:
            live[a] = t + day
    assert got == want


def test_delivery_lag_freshness_growth(spark):
    b = spark.createDataFrame([("1", "2024-01-01 00:00:00", "2024-01-01 00:10:00"),
                               ("2", "2024-01-01 00:00:00", "2024-01-01 00:01:00")],
                              "sequence_number string, event_time string, processed_at string") \
        .select("sequence_number", F.col("event_time").cast("timestamp"), F.col("processed_at").cast("timestamp"))
    lag = monitor.delivery_lag(b).collect()
    assert [(r.sequence_number, r.lag_seconds) for r in lag] == [("1", 600.0)]
    f = quality.freshness(b, "processed_at", F.lit("2024-01-01 01:10:00").cast("timestamp")).first()
    assert f.age_seconds == 3600
    inv = spark.createDataFrame([(1, "silver", 100), (2, "silver", 150), (1, "gold", 10)],
                                "snapshot_ts int, layer string, bytes long")
    g = {(r.layer, r.snapshot_ts): r.growth_bytes for r in monitor.layer_growth(inv).collect()}
    assert g == {("silver", 1): None, ("silver", 2): 50, ("gold", 1): None}
