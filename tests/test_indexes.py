"""Stored indexes against plain filters of the state, over versions with re-keyed, deleted and re-made items."""

import re
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from tessera.functions import keys as K
from tessera.schemas import ITEM
from tessera.sinks import indexes

#: Small tables in few buckets.
BY_STATUS, BY_DUE_DATE, PRIMARY = (replace(i, buckets=16, spread=4) for i in (indexes.BY_STATUS, indexes.BY_DUE_DATE, indexes.PRIMARY))


def _state(spark, rows):
    """Item rows from (user, task, status, due_date)."""
    df = spark.createDataFrame(rows, "u string, t string, status string, due_date string")
    made = K.task_keys(F.col("u"), F.col("t"), F.col("status"), F.lit("low"), F.lit("c"), F.col("due_date"))
    df = df.select(*[c.alias(k) for k, c in made.items()], "status", "due_date")
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in ITEM.fields])


def _new(tmpdir_path):
    name = f"ix_{uuid.uuid4().hex}"
    return name, f"{tmpdir_path}/{name}"


def _found(df):
    return sorted((r.PK, r.SK, r.status) for r in df.collect())


def _plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().toString()


V1 = [("1", f"t{i}", ["pending", "completed"][i % 2], f"2024-01-{i + 1:02d}") for i in range(20)] + [("2", "x", "pending", None)]
#: t0 changes its status, t2 is deleted, t4 changes its due date only, "y" is new.
OLD2 = [V1[0], V1[2], V1[4]]
NEW2 = [("1", "t0", "completed", "2024-01-01"), ("1", "t4", "pending", "2024-03-01"), ("2", "y", "pending", "2024-01-05")]
#: t0 goes back to its first status, t2 is made again.
OLD3, NEW3 = [NEW2[0]], [V1[0], V1[2]]


def _status(spark, name, user, status):
    return indexes.lookup(spark, BY_STATUS, name, f"USER#{user}", *indexes.prefix_range(f"STATUS#{status}#"))


def test_versions_equal_a_scan_of_the_state(spark, tmpdir_path):
    name, path = _new(tmpdir_path)
    indexes.build(_state(spark, V1), BY_STATUS, name, path)
    states = {1: V1, 2: [r for r in V1 if r not in OLD2] + NEW2}
    states[3] = [r for r in states[2] if r not in OLD3] + NEW3
    for version, (old, new) in enumerate([([], []), (OLD2, NEW2), (OLD3, NEW3)], 1):
        if version > 1:
            indexes.apply_changes(_state(spark, old), _state(spark, new), BY_STATUS, name, path, version)
        for user in ("1", "2", "3"):
            for status in ("pending", "completed"):
                want = sorted((f"TASK#{u}", f"TASK#{t}", s) for u, t, s, _ in states[version] if u == user and s == status)
                assert _found(_status(spark, name, user, status)) == want
    # a version appended again changes nothing
    before = _found(_status(spark, name, "1", "pending"))
    indexes.apply_changes(_state(spark, OLD3), _state(spark, NEW3), BY_STATUS, name, path, 3)
    assert _found(_status(spark, name, "1", "pending")) == before
    # and the compacted table holds the standing entries alone
    into, there = _new(tmpdir_path)
    indexes.compact(spark, BY_STATUS, name, into, there, 4)
    assert spark.table(into).count() == len(states[3])
    assert _found(_status(spark, into, "1", "pending")) == before


def test_unchanged_key_takes_the_new_image(spark, tmpdir_path):
    name, path = _new(tmpdir_path)
    indexes.build(_state(spark, V1), BY_STATUS, name, path)
    indexes.apply_changes(_state(spark, OLD2), _state(spark, NEW2), BY_STATUS, name, path, 2)
    got = {r.SK: r.due_date for r in _status(spark, name, "1", "pending").collect()}
    assert got["TASK#t4"] == "2024-03-01"


def test_lookups_open_the_buckets_of_their_part(spark, tmpdir_path):
    name, path = _new(tmpdir_path)
    indexes.build(_state(spark, V1), PRIMARY, name, path)
    point = indexes.get_item(spark, PRIMARY, name, "TASK#1", "TASK#t3")
    assert _found(point) == [("TASK#1", "TASK#t3", "completed")]
    assert "SelectedBucketsCount: 1 out of 16" in _plan(point) and "hashpartitioning" not in _plan(point)
    ranged = indexes.lookup(spark, PRIMARY, name, "TASK#1", *indexes.prefix_range("TASK#t1"))
    opened = int(re.search(r"SelectedBucketsCount: (\d+) out of 16", _plan(ranged)).group(1))
    assert 1 <= opened <= PRIMARY.spread
    assert "GreaterThanOrEqual(sort" in _plan(ranged)
    assert [r[1] for r in _found(ranged)] == sorted(f"TASK#t{i}" for i in (1, *range(10, 20)))


def test_a_hot_part_fills_many_buckets(spark, tmpdir_path):
    name, path = _new(tmpdir_path)
    indexes.build(_state(spark, [("1", f"t{i}", "pending", None) for i in range(400)]), BY_STATUS, name, path)
    sizes = [r["count"] for r in spark.table(name).groupBy("cell").count().collect()]
    assert len(sizes) == BY_STATUS.spread and max(sizes) < 200
    assert _status(spark, name, "1", "pending").count() == 400


def test_bulk_lookups_read_the_index_as_it_lies(spark, tmpdir_path):
    name, path = _new(tmpdir_path)
    indexes.build(_state(spark, V1), BY_DUE_DATE, name, path)
    low, high = "DUEDATE#2024-01-03#", indexes.prefix_range("DUEDATE#2024-01-05#")[1]
    wanted = spark.createDataFrame([("USER#1", low, high), ("USER#1", low, high), ("USER#2", low, high), ("USER#9", low, high), (None, low, high),
                                    ("USER#2", *indexes.prefix_range("DUEDATE#none#"))], "part string, low string, high string")
    got = indexes.lookup_many(BY_DUE_DATE, name, wanted)
    assert [(r.PK, r.SK) for r in got.orderBy("PK", "SK").collect()] == [("TASK#1", f"TASK#t{i}") for i in (2, 3, 4)] + [("TASK#2", "TASK#x")]
    keys = spark.createDataFrame([("TASK#1", "TASK#t1"), ("TASK#1", "TASK#t1"), ("TASK#1", "no"), (None, "TASK#t1")], "PK string, SK string")
    other, there = _new(tmpdir_path)
    indexes.build(_state(spark, V1), PRIMARY, other, there)
    items = indexes.get_items(PRIMARY, other, keys)
    assert _found(items) == [("TASK#1", "TASK#t1", "completed")]


def test_sparse_empty_and_attached(spark, tmpdir_path):
    name, path = _new(tmpdir_path)
    bare = _state(spark, V1[:2]).withColumn("GSI1PK", F.when(F.col("SK") == "TASK#t0", F.col("GSI1PK")))
    indexes.build(bare, BY_STATUS, name, path)
    assert spark.table(name).count() == 1
    spark.sql(f"DROP TABLE {name}")
    indexes.attach(spark, BY_STATUS, name, path)
    hit = _status(spark, name, "1", "pending")
    assert _found(hit) == [("TASK#1", "TASK#t0", "pending")] and "SelectedBucketsCount" in _plan(hit)
    empty, there = _new(tmpdir_path)
    indexes.build(_state(spark, V1).limit(0), BY_STATUS, empty, there)
    assert _status(spark, empty, "1", "pending").count() == 0
