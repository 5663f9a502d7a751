"""Change records -> bronze: the four change kinds, empty and invalid batches,
quarantine, counters and the 63-change workload."""

from pyspark.sql import functions as F

from conftest import change, task_image, user_image, write_jsonl
from tessera.operators import cdc
from tessera.sources.lake import read_changes


def _read(spark, tmp, records):
    return read_changes(spark, write_jsonl(tmp, records))


def test_insert_modify_remove(spark, tmpdir_path):
    old = user_image(email="old@example.com")
    new = user_image(email="new@example.com")
    ch = _read(spark, tmpdir_path, [
        change("INSERT", "123456789", new=user_image()),
        change("MODIFY", "123456790", new=new, old=old),
        change("REMOVE", "123456791", old=new),
    ])
    env = cdc.changes_to_bronze(ch).orderBy("sequence_number").collect()
    assert [e.event_name for e in env] == ["INSERT", "MODIFY"]
    assert env[0].data.PK == "USER#123" and env[0].partition_key == "USER#123"
    assert env[1].data.email == "new@example.com"
    assert env[0].sequence_number == "123456789" and env[0].table_name


def test_other_event_uses_old_image(spark, tmpdir_path):
    ch = _read(spark, tmpdir_path, [change("CUSTOM", "1", new=user_image(email="n@x.io"), old=user_image(email="o@x.io"))])
    env = cdc.changes_to_bronze(ch).collect()
    assert len(env) == 1 and env[0].data.email == "o@x.io"


def test_missing_or_empty_image_is_skipped(spark, tmpdir_path):
    ch = _read(spark, tmpdir_path, [change("INSERT", "1"), change("MODIFY", "2", new={})])
    counts = cdc.batch_counters(ch).first()
    assert (counts.processed, counts.failed, counts.skipped) == (0, 0, 2)
    assert cdc.changes_to_bronze(ch).count() == 0


def test_empty_batch(spark, tmpdir_path):
    ch = _read(spark, tmpdir_path, [])
    assert cdc.changes_to_bronze(ch).count() == 0
    assert cdc.batch_counters(ch).first().records == 0


def test_bad_number_keeps_its_text_and_bad_records_are_quarantined(spark, tmpdir_path):
    bad = task_image(tid="t9", created="oops")
    bad["created_at"] = {"N": "oops"}
    marks = task_image(tid="t8")
    marks["marks"] = {"NS": ["1", "x"]}
    ch = _read(spark, tmpdir_path, [change("INSERT", "1", new=task_image()), change("INSERT", "2", new=bad), change("INSERT", "3", new=marks)])
    import os
    with open(os.path.join(tmpdir_path, "cut.json"), "w") as f:
        f.write('{"eventName": "INSERT", "dynamo\n')
    from tessera.sources import lake as src
    ch = ch.unionByName(src.read_changes(spark, os.path.join(tmpdir_path, "cut.json")))
    good, quarantined = cdc.split_quarantine(ch)
    kept = {r.sequence_number: r.raw for r in good.collect()}
    assert kept == {"1": None, "2": {"created_at": "oops", "updated_at": "oops"}}
    q = {r.error: r.record for r in quarantined.collect()}
    assert set(q) == {cdc.MALFORMED, cdc.BAD_SET} and q[cdc.MALFORMED].startswith('{"eventName"')
    assert {r.error: r.failed for r in cdc.delivery_failures(quarantined).collect()} == {cdc.MALFORMED: 1, cdc.BAD_SET: 1}
    counts = cdc.batch_counters(ch).first()
    assert (counts.processed, counts.failed, counts.skipped) == (2, 2, 0)


def test_arrival_time_is_the_clock_unless_pinned(spark, tmpdir_path):
    ch = _read(spark, tmpdir_path, [change("INSERT", "1", new=task_image())])
    row = cdc.changes_to_bronze(ch).select((F.unix_seconds("processed_at") - F.unix_seconds("event_time")).alias("lag")).first()
    assert row.lag > 86400
    row = cdc.changes_to_bronze(ch, now=F.col("eventTime")).first()
    assert row.processed_at == row.event_time


def test_null_event_name_survives_remove_filter(spark, tmpdir_path):
    ch = _read(spark, tmpdir_path, [{"dynamodb": {"SequenceNumber": "5", "OldImage": user_image()}}])
    env = cdc.changes_to_bronze(ch).collect()
    assert len(env) == 1 and env[0].event_name is None


def test_sixty_three_change_workload(spark, tmpdir_path):
    """3 users x 5 tasks x 3 updates: 3 + 15 + 45 = 63 changes, all processed."""
    recs, seq = [], 0
    for u in range(3):
        seq += 1
        recs.append(change("INSERT", seq, new=user_image(uid=f"u{u}", email=f"u{u}@x.io")))
        for t in range(5):
            seq += 1
            recs.append(change("INSERT", seq, new=task_image(uid=f"u{u}", tid=f"{u}-{t}")))
            for s in ["in_progress", "completed", "completed"]:
                seq += 1
                recs.append(change("MODIFY", seq, new=task_image(uid=f"u{u}", tid=f"{u}-{t}", status=s)))
    ch = _read(spark, tmpdir_path, recs)
    assert ch.count() == 63
    assert cdc.batch_counters(ch).first().processed == 63
    env = cdc.changes_to_bronze(ch)
    assert env.filter(F.col("data.PK").startswith("TASK#")).count() == 60
