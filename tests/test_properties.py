"""Property tests: encode -> decode round trip of typed items, and state
folding that does not depend on the order changes arrive in."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.decode import decode_attributes, encode_item, tag_n, tag_s
from tessera.operators import mutate
from tessera.schemas import ITEM

_text = st.one_of(st.none(), st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=12))
_num = st.one_of(st.none(), st.integers(min_value=-(2 ** 62), max_value=2 ** 62))
_row = st.fixed_dictionaries({"PK": st.text(min_size=1, max_size=10), "SK": st.text(min_size=1, max_size=10),
                              "title": _text, "status": _text, "created_at": _num, "completed_at": _num})


@settings(max_examples=8, deadline=None)
@given(st.lists(_row, min_size=1, max_size=25))
def test_encode_decode_round_trip(spark, rows):
    schema = "PK string, SK string, title string, status string, created_at long, completed_at long"
    df = spark.createDataFrame([(r["PK"], r["SK"], r["title"], r["status"], r["created_at"], r["completed_at"])
                                for r in rows], schema)
    img = encode_item({"PK": tag_s(F.col("PK")), "SK": tag_s(F.col("SK")), "title": tag_s(F.col("title")),
                       "status": tag_s(F.col("status")), "created_at": tag_n(F.col("created_at")),
                       "completed_at": tag_n(F.col("completed_at"))})
    back = df.select(decode_attributes(img, ITEM).alias("d")).select(
        "d.PK", "d.SK", "d.title", "d.status", "d.created_at", "d.completed_at")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["INSERT", "MODIFY", "REMOVE"]),
                          st.sampled_from(["pending", "in_progress", "completed"])), min_size=1, max_size=30),
       st.randoms(use_true_random=False))
def test_state_independent_of_arrival_order(spark, changes, rnd):
    rows = [(ev, f"2024-01-01 00:00:{i % 60:02d}", str(i), "TASK#u", f"TASK#{k}", s) for i, (k, ev, s) in enumerate(changes)]
    shuffled = rows[:]
    rnd.shuffle(shuffled)

    def state(rs):
        df = spark.createDataFrame(rs, "event_name string, processed_at string, sequence_number string, "
                                       "PK string, SK string, status string")
        data = F.struct(*[F.col(f.name) if f.name in ("PK", "SK", "status") else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in ITEM.fields])
        env = df.select("event_name", F.col("processed_at").cast("timestamp").alias("processed_at"),
                        "sequence_number", data.alias("data"))
        return sorted((r.SK, r.status) for r in mutate.current_state(env).collect())

    assert state(rows) == state(shuffled)
    # brute force: last change per key in (time, sequence) order decides
    last = {}
    for ev, t, seq, _pk, sk, s in sorted(rows, key=lambda r: (r[1], int(r[2]))):
        last[sk] = (ev, s)
    assert state(rows) == sorted((sk, s) for sk, (ev, s) in last.items() if ev != "REMOVE")
