"""Catalog and sink helpers: database/table registration, run-SQL-to,
CTAS, metric and log round trips, crawler-style schema inference."""

import os

from pyspark.sql import functions as F

from conftest import write_jsonl
from tessera.operators import metrics
from tessera.schemas import ITEM
from tessera.sinks import lake as sink
from tessera.sources import lake as src


def test_register_database_table_and_sql(spark, tmpdir_path):
    sink.register_database(spark, "analytics_t", "analytics", os.path.join(tmpdir_path, "db"))
    assert "analytics_t" in [d.name for d in spark.catalog.listDatabases()]
    p = os.path.join(tmpdir_path, "ua")
    spark.createDataFrame([("1", 5), ("2", 7)], "user_id string, total_events long").write.parquet(p)
    sink.register_table(spark, "analytics_t.user_analytics", p)
    out = sink.run_sql_to(spark, "SELECT COUNT(*) AS total_users FROM analytics_t.user_analytics",
                          os.path.join(tmpdir_path, "results"))
    assert out.first().total_users == 2
    sink.ctas_gold(spark, "analytics_t.top_users",
                   "SELECT user_id FROM analytics_t.user_analytics WHERE total_events > 5")
    sink.ctas_gold(spark, "analytics_t.top_users",
                   "SELECT user_id FROM analytics_t.user_analytics WHERE total_events > 5")
    assert [r.user_id for r in spark.table("analytics_t.top_users").collect()] == ["2"]


def test_metrics_written_by_namespace(spark, tmpdir_path):
    m = metrics.collect_metrics(spark.createDataFrame([], ITEM), F.lit("2024-01-31").cast("timestamp"))
    p = os.path.join(tmpdir_path, "metrics")
    sink.write_metrics(m, p)
    sink.write_metrics(m, p)
    back = spark.read.parquet(p)
    assert back.count() == 24 and back.select("namespace").distinct().count() == 1


def test_read_logs_and_infer_catalog(spark, tmpdir_path):
    d = write_jsonl(os.path.join(tmpdir_path, "logs"), [
        {"timestamp": "2024-01-01T00:00:00Z", "level": "INFO", "request_id": "r1", "duration_ms": 12,
         "status": "ok", "metadata": {"http_status": "200"}},
        {"timestamp": "2024-01-01T00:00:01Z", "level": "ERROR", "request_id": "r2", "extra": "ignored"}])
    logs = src.read_logs(spark, d).collect()
    assert [r.level for r in logs] == ["INFO", "ERROR"] and logs[1].duration_ms is None
    schema = src.infer_catalog(spark, "raw_logs_t", d)
    assert "extra" in schema.fieldNames()
    assert spark.table("raw_logs_t").count() == 2


def test_bronze_date_partition_filter(spark, tmpdir_path):
    env = spark.createDataFrame([("INSERT", "1", "2024-01-01 10:00:00"), ("INSERT", "2", "2024-01-02 10:00:00")],
                                "event_name string, sequence_number string, processed_at string") \
        .withColumn("processed_at", F.col("processed_at").cast("timestamp"))
    p = os.path.join(tmpdir_path, "bronze")
    sink.write_bronze(env, p, 1)
    df = src.read_bronze(spark, p, dates=["2024-01-02"])
    assert [r.sequence_number for r in df.collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_layer_growth_from_snapshots(spark, tmpdir_path):
    from tessera.operators import monitor
    silver_dir = os.path.join(tmpdir_path, "silver")
    spark.range(100).write.parquet(os.path.join(silver_dir, "users"))
    s1 = src.inventory_snapshot(spark, {"silver": silver_dir}, "2024-01-01 00:00:00")
    s1 = spark.createDataFrame(s1.collect(), s1.schema)  # freeze the first snapshot
    spark.range(1000).write.parquet(os.path.join(silver_dir, "tasks"))
    s2 = src.inventory_snapshot(spark, {"silver": silver_dir}, "2024-01-02 00:00:00")
    g = monitor.layer_growth(s1.unionByName(s2)).orderBy("snapshot_ts").collect()
    assert g[0].growth_bytes is None and g[1].growth_bytes > 0 and g[1].files > g[0].files
