"""Views and lookups, quality rules, metric collection with zero denominators."""

from pyspark.sql import functions as F

from tessera.operators import lookup, metrics, quality
from tessera.schemas import ITEM


def _state(spark, rows):
    df = spark.createDataFrame(rows, "PK string, SK string, status string, priority string, due_date string, "
                                     "completed_at long, last_login string, verification_status string")
    for f in ITEM.fields:
        if f.name not in df.columns:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.withColumn("GSI1PK", F.when(F.col("PK").startswith("TASK#"), F.concat(F.lit("USER#"), F.split("PK", "#")[1]))) \
        .withColumn("GSI1SK", F.concat_ws("#", F.lit("STATUS"), "status", F.split("SK", "#")[1]))


def test_task_view_defaults(spark):
    st = _state(spark, [("TASK#u", "TASK#t1", None, "low", "2024-01-05", 0, None, None),
                        ("TASK#u", "TASK#t2", "completed", None, "bad-date", 1704067200, None, None)])
    v = {r.id: r for r in lookup.task_view(st).collect()}
    assert v["t1"].status == "pending" and v["t1"].completed_at is None and str(v["t1"].due_date) == "2024-01-05"
    assert v["t2"].priority == "medium" and v["t2"].due_date is None and v["t2"].completed_at is not None


def test_index_lookup_and_page(spark):
    st = _state(spark, [("TASK#u", f"TASK#t{i}", "pending" if i % 2 else "completed", "low", None, None, None, None)
                        for i in range(6)])
    assert lookup.tasks_by_status(st, "u", "pending").count() == 3
    p = lookup.page(st.select("PK", "SK"), ["PK", "SK"], 2, after=("TASK#u", "TASK#t1")).collect()
    assert [r.SK for r in p] == ["TASK#t2", "TASK#t3"]
    assert lookup.get_item(st, "TASK#u", "TASK#t4").count() == 1


def test_overdue_and_search(spark):
    t = spark.createDataFrame([("a", "Buy milk", None, "pending", "2024-01-01"), ("b", "Call", "milk man", "completed", "2024-01-01"),
                               ("c", "Later", None, "pending", "2024-03-01")],
                              "id string, title string, description string, status string, due_date string") \
        .withColumn("due_date", F.col("due_date").cast("date"))
    assert [r.id for r in lookup.overdue_tasks(t, "2024-02-01").collect()] == ["a"]
    assert sorted(r.id for r in lookup.search_tasks(t, "MILK").collect()) == ["a", "b"]


def test_quality_rules(spark):
    rules = quality.Rules(required_fields=["email"], data_types={"age": "int", "flag": "float"},
                          constraints={"age": {"min": 0, "max": 120}, "email": {"pattern": r"[^@]+@"}})
    df = spark.createDataFrame([("a@x.io", 25, True), ("b@x.io", 150, True), (None, 30, False), ("nope", 3, True)],
                               "email string, age int, flag boolean")
    v = [r.v for r in df.select(quality.violations(df, rules).alias("v")).collect()]
    assert v == [[], ["max:age"], ["required:email", "pattern:email"], ["pattern:email"]]
    good, bad = quality.validate(df, rules)
    assert good.count() == 1 and [r.rule for r in bad.orderBy("age").collect()] == ["pattern:email", "required:email", "max:age"]
    txt = spark.createDataFrame([("25",), ("x",)], "age string")
    assert [r.v for r in txt.select(quality.violations(txt, quality.Rules(data_types={"age": "int"})).alias("v")).collect()] \
        == [["type:age"], ["type:age"]]
    # what can't be compared rejects
    odd = quality.Rules(constraints={"age": {"min": 0}})
    assert [r.v for r in txt.select(quality.violations(txt, odd).alias("v")).collect()] == [["min:age"], ["min:age"]]
    none = spark.createDataFrame([(None,), (1,)], "age int")
    assert [r.v for r in none.select(quality.violations(none, odd).alias("v")).collect()] == [["min:age"], []]
    summary = {r.rule: r.failures for r in quality.rule_summary(df, rules).collect()}
    assert summary == {"rows": 4, "rejected_rows": 3, "required:email": 1, "type:age": 0, "type:flag": 0, "min:age": 0, "max:age": 1, "pattern:email": 2}


def test_metrics_zero_denominators(spark):
    empty = spark.createDataFrame([], ITEM)
    m = {r.metric: r.value for r in metrics.collect_metrics(empty, F.lit("2024-01-31").cast("timestamp")).collect()}
    assert m["UserVerificationRate"] == 0 and m["TaskCompletionRate"] == 0 and m["AverageTasksPerUser"] == 0
    assert len(m) == 12


def test_metrics_counts_and_active_cutoff(spark):
    st = _state(spark, [
        ("USER#1", "METADATA", None, None, None, None, "2024-01-01T00:00:00.000001", "verified"),
        ("USER#2", "METADATA", None, None, None, None, "2024-01-01T00:00:00.000000", "pending"),
        ("TASK#1", "TASK#a", "completed", "high", None, None, None, None),
        ("TASK#1", "TASK#b", "pending", "low", None, None, None, None)])
    m = {r.metric: r.value for r in metrics.collect_metrics(st, F.lit("2024-01-31").cast("timestamp")).collect()}
    assert (m["TotalUsers"], m["ActiveUsers"], m["VerifiedUsers"]) == (2, 1, 1)
    assert (m["TotalTasks"], m["CompletedTasks"], m["HighPriorityTasks"], m["TaskCompletionRate"]) == (2, 1, 1, 50.0)
    assert m["AverageTasksPerUser"] == 1.0 and m["TotalItems"] == 4


def test_quality_rules_over_json_records(spark):
    """The rule cases of the source's own tests, over JSON records."""
    import json
    rules = quality.Rules(required_fields=["user_id", "email"],
                          data_types={"user_id": "string", "age": "int", "score": "float", "active": "bool"},
                          constraints={"age": {"min": 0, "max": 120}, "email": {"pattern": r"[^@]+@[^@]+\.[a-z]+"}})
    recs = [
        {"user_id": "123", "email": "a@example.com", "age": 25, "score": 95.5, "active": True},   # valid
        {"user_id": "123", "email": "a@example.com", "age": 150},                                # above max
        {"user_id": "123", "email": "a@example.com", "age": "twenty"},                           # wrong type
        {"user_id": "123", "age": 25},                                                           # missing email
        {"user_id": "123", "email": "a@example.com", "age": True, "score": 3},                   # bool is an int, int is a float
        {"user_id": None, "email": "a@example.com"},                                             # present null fails
        {"user_id": "123", "email": "not-an-email"},                                             # pattern
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in recs], "j string").select(F.parse_json("j").alias("rec"))
    flat = quality.record_fields(df, "rec", rules)
    v = [r.v for r in flat.select(quality.violations(flat, rules).alias("v")).collect()]
    assert v[0] == [] and v[1] == ["max:age"] and v[2][0] == "type:age" and v[3] == ["required:email"]
    assert v[4] == [] and v[5][0] == "required:user_id" and v[6] == ["pattern:email"]
