"""The pipeline keeps clean documents and drops planted ones, stage by stage."""

import numpy as np
import pytest

import corpus_pipeline
from llm_helpers import DOCS, clashing, prose
from tessera.llm import packing
from tessera.llm.common import written


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    items = [(i, prose(400 + i, 40)) for i in range(5)]
    rows, labels = [], []
    for i in range(400):
        text = prose(i, 90).capitalize() + "."
        if i % 10 == 1:
            text = " ".join(w + "###" for w in text.split())
        elif i % 10 == 2:
            text = rows[i - 2][1] + " more"
        elif i % 10 == 3:
            text = f"{text} {items[i % 5][1]}"
        rows.append((i, text, "en", f"src{i % 3}", len(text)))
        labels.append((i, int(i % 10 != 1), 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    clean = {i for i in range(400) if i % 10 not in (1, 2, 3)}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = written(stage(spark, docs, corpus), name)
        assert new.columns == docs.columns
        kept.append({r.doc_id for r in new.collect()})
        docs = new
    quality, near, decontaminated, mixed = kept
    assert clean <= decontaminated == {i for i in range(400) if i % 10 not in (1, 2, 3)}
    assert {i for i in range(400) if i % 10 == 1}.isdisjoint(quality)
    assert near == {i for i in quality if i % 10 != 2}
    assert mixed <= decontaminated
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, corpus).collect()
    vocabulary = packing.Vocabulary(packing.VOCABULARY)
    ends = sum(int((np.frombuffer(r.input_ids, vocabulary.kind)[:r.tokens] == vocabulary.end).sum()) for r in packed)
    assert ends == docs.count()


def test_stages_judge_rows_by_text(spark, corpus):
    """Null and repeated ids: copies without an id go, a text stays whatever else its id stands for."""
    a, b, c, d, e = (prose(600 + i, 90) for i in range(5))
    leak = f"{prose(700, 60)} {prose(400, 40)}"
    rows = [(3, a + " more"), (7, a), (7, b), (None, c), (None, c), (None, c + " more"), (8, d), (None, d), (8, d),
            (9, e), (9, e + " more"), (None, leak), (5, leak + " more"), (5, prose(701, 60)), (None, None), (None, None)]
    docs = clashing(spark.createDataFrame([(i, t, "en", "s", n) for n, (i, t) in enumerate(rows)], DOCS))
    stages = dict(corpus_pipeline.STAGES)
    near = stages["near_duplicates"](spark, docs, corpus)
    assert near.columns == docs.columns
    got = sorted((str(r.doc_id), r.text or "") for r in near.collect())
    in_class = lambda t: [x for x in got if x[1] in (t, t + " more")]
    assert in_class(a) == [("3", a + " more")] and in_class(b) == [("7", b)] and in_class(d) == [("8", d)]
    assert [i for i, _ in in_class(c)] == ["None"] and [i for i, _ in in_class(e)] == ["9"] and [i for i, _ in in_class(leak)] == ["5"]
    assert len(got) == 9
    clean = stages["decontamination"](spark, docs, corpus)
    assert clean.columns == docs.columns
    assert sorted(r.n_chars for r in clean.collect()) == [n for n in range(len(rows)) if n not in (11, 12)]


def test_run(spark, corpus):
    out = corpus_pipeline.run(spark, corpus)
    assert out.count() > 0 and "input_ids" in out.columns


def test_run_on_empty_tables(spark, corpus, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
