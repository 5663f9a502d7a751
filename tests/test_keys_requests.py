"""Key layout, request identity, request ids and scope checks (PRJ-04/06/14..16, FIL-20)."""

import json
import os

from pyspark.sql import functions as F

from conftest import write_jsonl
from tessera.functions import keys as K
from tessera.sources.lake import read_changes
from tessera.streaming import streams


def test_entity_type_and_ids(spark):
    df = spark.createDataFrame([("USER#1", "METADATA"), ("TASK#u#TASK#x", "TASK#a#TASK#b"), ("IDEMPOTENCY#r", "METADATA"),
                                (None, None), ("OTHER", "x")], "PK string, SK string")
    et = K.entity_type(F.col("PK"))
    uid, tid = K.derive_ids(F.col("PK"), F.col("SK"), et)
    rows = df.select(et.alias("e"), uid.alias("u"), tid.alias("t"),
                     K.strip_prefix(F.col("SK"), "TASK#", anchored=True).alias("a")).collect()
    assert [r.e for r in rows] == ["USER", "TASK", "IDEMPOTENCY", "UNKNOWN", "UNKNOWN"]
    assert rows[1].u == "u#x" and rows[1].t == "a#b" and rows[1].a == "a#TASK#b"
    assert rows[2].u is None and rows[0].t is None


def test_task_index_keys(spark):
    df = spark.createDataFrame([("u1", "t1", "pending", "high", None, None)],
                               "u string, t string, s string, p string, c string, d string")
    k = K.task_keys(F.col("u"), F.col("t"), F.col("s"), F.col("p"), F.col("c"), F.col("d"))
    r = df.select(*[v.alias(n) for n, v in k.items()]).first()
    assert (r.PK, r.SK, r.GSI1PK, r.GSI1SK) == ("TASK#u1", "TASK#t1", "USER#u1", "STATUS#pending#t1")
    assert r.GSI2SK == "DUEDATE#none#t1" and r.GSI4SK == "CATEGORY#none#t1" and r.GSI3SK == "PRIORITY#high#t1"


def test_identity_from_claims(spark):
    events = [
        {"authorizer": {"jwt": {"claims": {"sub": "u1", "email": "a@x.io", "name": "Ann"}}}},
        {"authorizer": {"claims": {"sub": "u2", "email": "b@x.io", "cognito:username": "bee"}}},
        {"authorizer": {"jwt": {"claims": {"sub": "u3", "email": "c@x.io"}}}},
        {"authorizer": {"jwt": {"claims": {"email": "d@x.io"}}}},
        {"authorizer": {}},
    ]
    df = spark.createDataFrame([(json.dumps(e),) for e in events], "j string").select(F.parse_json("j").alias("rc"))
    out = [r.i for r in df.select(K.identity_from_claims(F.col("rc")).alias("i")).collect()]
    assert (out[0].user_id, out[0].name, out[0].valid) == ("u1", "Ann", True)
    assert (out[1].user_id, out[1].name) == ("u2", "bee")
    assert out[2].name == "c@x.io"
    assert out[3].valid is False and out[4].valid is False


def test_request_id_and_scope(spark):
    df = spark.createDataFrame([
        ({"Idempotency-Key": "k1", "X-Request-ID": "x"}, "u1"),
        ({"Idempotency-Key": "", "X-Request-ID": "x2"}, None),
        ({"X-Amzn-RequestId": "amz"}, "u3"),
        ({}, "u4"),
    ], "h map<string,string>, u string")
    rid = K.request_id(F.col("h"), F.col("u"), fallback=F.lit("gen"))
    ids = [r.r for r in df.select(rid.alias("r")).collect()]
    assert ids == ["u1:k1", "x2", "u3:amz", "u4:gen"]
    sc = spark.createDataFrame([("u1:abc", "u1"), ("u2:abc", "u1"), ("abc", "u1"), ("abc", None), ("abc", "")],
                               "rid string, u string")
    assert [r.ok for r in sc.select(K.request_scope_ok(F.col("rid"), F.col("u")).alias("ok")).collect()] \
        == [True, False, False, True, True]


def test_incremental_processes_only_new_files(spark, tmpdir_path):
    src_dir = os.path.join(tmpdir_path, "in")
    write_jsonl(src_dir, [{"eventName": "INSERT", "dynamodb": {"SequenceNumber": "1"}}], "a.json")
    seen = []
    ck = os.path.join(tmpdir_path, "ck")
    streams.incremental(read_changes(spark, src_dir, stream=True), lambda df, b: seen.append(df.count()), ck).awaitTermination()
    write_jsonl(src_dir, [{"eventName": "MODIFY", "dynamodb": {"SequenceNumber": "2"}}] * 2, "b.json")
    streams.incremental(read_changes(spark, src_dir, stream=True), lambda df, b: seen.append(df.count()), ck).awaitTermination()
    assert seen == [1, 2]
