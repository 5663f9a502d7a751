"""Near duplicates, decontamination, repeated spans, classifier, packing: against brute force and round trips."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_helpers import no_docs, odd_docs, prose  # noqa: F401
from tessera.llm import components, decontam, neardup, packing, quality, shingles, substrings


# --- near duplicates

def _shingle_sets(rows):
    out = []
    for text in rows:
        w = (text or "").lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def _brute_classes(ids, texts):
    sets, parent, links = _shingle_sets(texts), list(range(len(ids))), Counter()

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            same = texts[i] is not None and texts[i] == texts[j]
            both = len(sets[i] & sets[j])
            if same or (both and 10 * both >= 8 * len(sets[i] | sets[j])):
                links[i] += 1
                links[j] += 1
                parent[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, d in enumerate(ids):
        least[top(i)] = min(least.get(top(i), d), d)
    return {d: (least[top(i)], links[i]) for i, d in enumerate(ids)}


def _near_rows(n_groups=12, size=9):
    r, rows = random.Random(5), []
    for g in range(n_groups):
        base = prose(100 + g, r.choice([6, 40, 120, 400])).split()
        for _ in range(r.randint(1, size)):
            words = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4])):
                words[r.randrange(len(words))] = prose(r.randrange(10**6), 1)
            rows.append(" ".join(words))
    r.shuffle(rows)
    return rows + ["", "", "same", "same", "Same"]


def test_jaccard_classes_against_brute_force(spark):
    texts = _near_rows()
    docs = spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.jaccard_classes(docs).collect()}
    assert got == _brute_classes([i * 3 for i in range(len(texts))], texts)


def test_jaccard_blocks_and_large_buckets(spark, monkeypatch):
    """A group over many blocks, and buckets too large to prune, give the same result."""
    r, base = random.Random(1), prose(1, 150).split()
    texts = []
    for _ in range(150):
        words = list(base)
        for _ in range(r.randint(0, 4)):
            words[r.randrange(len(words))] = prose(r.randrange(10**6), 1)
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = _brute_classes(list(range(150)), texts)
    for name, value in (("BLOCK", 20), ("BUCKET", 10)):
        monkeypatch.setattr(neardup, name, value)
        assert {x.doc_id: (x.class_id, x.n_links) for x in neardup.jaccard_classes(docs).collect()} == want


def test_jaccard_odd_rows(odd_docs, no_docs):
    got = neardup.jaccard_classes(odd_docs).toPandas()
    assert len(got) == odd_docs.count()
    by = {int(d): (c, n) for d, c, n in got.dropna(subset="doc_id").itertuples(index=False) if d != 9}
    assert by[1] == by[2] == (1, 2) and by[3] == (3, 0) and by[6] == (6, 1) and by[7] == (6, 1)
    assert by[4] == (4, 0) and by[5] == (5, 0)
    kept = neardup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(x.doc_id for x in kept.collect() if x.doc_id is not None) == [1, 3, 4, 5, 6, 8, 9]
    assert neardup.jaccard_classes(no_docs).count() == 0 and neardup.keep_one(no_docs).count() == 0


def test_bayes_pruning_keeps_similar_pairs():
    r, xor_odd = np.random.default_rng(0), shingles.permutations(neardup.HASHES)
    lost = kept_far = 0
    for _ in range(300):
        common = r.integers(0, 1 << 63, 160, dtype=np.uint64)
        a, b = (np.concatenate([common, r.integers(0, 1 << 63, 20, dtype=np.uint64)]) for _ in range(2))
        far = np.concatenate([common[:40], r.integers(0, 1 << 63, 140, dtype=np.uint64)])
        s = [(shingles.minhash(x, *xor_odd) & 255).astype(np.uint8) for x in (a, b, far)]
        lost += not len(neardup.surviving(s[0], s[1][None]))
        kept_far += len(neardup.surviving(s[0], s[2][None]))
    assert lost == 0 and kept_far == 0
    assert list(neardup.least_matches()) == sorted(neardup.least_matches())


def test_connected_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 140)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(70)] + [(7, 7)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.component for x in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for a, b in edges if a != b for x in (a, b)}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination

def _items():
    return [(i, prose(900 + i, n)) for i, n in enumerate([20, 35, 59, 24, 40, 3, 200])] + [(50, None), (51, ""), (52, prose(900, 20))]


def test_decontamination_against_brute_force(spark):
    r, rows = random.Random(2), []
    items = _items()
    for i in range(60):
        words = prose(3000 + i, r.choice([5, 80, 700])).split()
        kind = i % 4
        item = items[r.randrange(7)][1].split()
        if kind == 1:  # whole
            words[len(words) // 2:len(words) // 2] = item
        elif kind == 2:  # a third: not a leak
            words[3:3] = item[:len(item) // 3]
        elif kind == 3:  # other case and punctuation
            words[-1:-1] = (" ".join(item).upper().replace(" ", ", ")).split()
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows + [(None, items[0][1]), (99, None), (98, ""), (0, rows[0][1])], "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontam.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for d, t in rows + [(None, items[0][1])]:
        held = decontam.runs(decontam.tokens(t))
        for k, text in items:
            words = decontam.tokens(text)
            if not words:
                continue
            if len(words) < 5:
                line = decontam.tokens(t)
                if any(line[i:i + len(words)] == words for i in range(len(line))):
                    want.add((d, k))
                continue
            q, a = (decontam.runs(x) for x in decontam.question_and_answer(text))
            if len(q & held) >= 0.6 * len(q) and len(a & held) >= 0.6 * len(a):
                want.add((d, k))
    assert got == want
    assert {d for d, _ in got} >= {i for i in range(60) if i % 4 in (1, 3)}
    assert not {d for d, k in got if k != 5} & {i for i in range(60) if i % 4 in (0, 2)}


def test_block_max_wand_equals_scoring_everything():
    r = random.Random(9)
    words = [prose(i, 1) for i in range(120)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.randint(5, 30)))) for i in range(70)]
    df = Counter(t for _, x in items for t in set(x.split()))
    index = decontam.Index(items, df, len(items), 17.0)
    for _ in range(200):
        query = sorted({index.terms[w] for w in r.sample(words, r.randint(1, 60)) if w in index.terms})
        scores = defaultdict(float)
        for t in query:
            for d, x in zip(index.lists[t], index.impacts[t]):
                scores[d] += x
        for threshold in (0.1, 0.3, 0.6):
            assert sorted(d for d, _ in index.search(query, threshold)) == sorted(d for d, s in scores.items() if s >= threshold - 1e-9)


def test_decontamination_segments_and_odd_rows(spark, monkeypatch, odd_docs, no_docs):
    items = spark.createDataFrame([(1, prose(2, 60)), (2, prose(77, 30)), (None, prose(3, 40))], "item_id long, text string")
    one = sorted(map(repr, decontam.find_leaks(odd_docs, items).collect()))
    assert len(one) == 4  # three rows with the first item, one with the last
    monkeypatch.setattr(decontam, "SEGMENT_ITEMS", 2)
    assert sorted(map(repr, decontam.find_leaks(odd_docs, items).collect())) == one
    kept = decontam.keep_clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert decontam.find_leaks(no_docs, items).count() == 0
    assert decontam.find_leaks(odd_docs, items.limit(0)).count() == 0


def test_decontamination_finds_items_with_one_edit(spark):
    """A word substituted, inserted or deleted at any place of items of 15 to 59 words; a part alone is no leak."""
    items = [(n, prose(7000 + n, n)) for n in (15, 25, 40, 59)]
    rows, want = [], set()
    for k, text in items:
        words = text.split()
        cut = len(decontam.question_and_answer(text)[0])
        edits = [words[:i] + new + words[i + gone:] for i in range(k) for new, gone in ((["zzz"], 1), (["zzz"], 0), ([], 1))]
        for n, held in enumerate([*edits, words[:cut], words[cut:], words[:cut] + prose(1, k - cut).split()]):
            own = prose(8000 + len(rows), 150).split()
            at = len(rows) % 151
            if n < len(edits):
                want.add((len(rows), k))
            rows.append((len(rows), " ".join(own[:at] + held + own[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontam.find_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == want


def test_aligned_equals_common_subsequence():
    def common(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
            row = new
        return row[-1]

    r = random.Random(5)
    for _ in range(300):
        part, passage = ([r.choice("abcdefgh") for _ in range(n)] for n in (r.randint(5, 20), r.randint(0, 60)))
        width = len(part) + 1 + len(part) // 4
        best = max([common(part, passage[i:i + width]) for i in range(len(passage))], default=0) / len(part)
        for least in (0.3, 0.8):
            assert decontam.aligned(part, passage, least) == (best if best >= least - 1e-12 else 0)


# --- repeated spans

def test_repeated_passages_are_found_and_clean_texts_left(spark):
    r, rows = random.Random(4), []
    passages = [prose(5000 + i, 55) for i in range(8)]
    for i in range(200):
        words = prose(7000 + i, 150).split()
        if i % 2:
            at = r.randrange(150)
            words[at:at] = passages[r.randrange(8)].split()
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = substrings.repeated_spans(docs).toPandas()
    assert set(spans.doc_id) == {i for i in range(200) if i % 2}
    texts = dict(rows)
    for s in spans.itertuples():
        found = texts[s.doc_id][s.span_start:s.span_end].strip()
        assert any(found in p for p in passages) and len(found.split()) == s.words >= substrings.LEAST_WORDS
    assert spans.original.sum() == 8
    cut = {x.doc_id: x.text for x in substrings.cut_repeats(docs).collect()}
    assert all(cut[i] == texts[i] for i in range(0, 200, 2))
    assert all(len(cut[s.doc_id]) < len(texts[s.doc_id]) for s in spans.itertuples() if not s.original)


def test_cuts_resist_insertions():
    table, kinds = substrings._gear_table(), substrings._kinds()
    text = prose(1, 3000)
    chunks = lambda t: Counter(t.encode()[a:b] for bounds, _ in [substrings.cuts(np.frombuffer(t.encode(), np.uint8), table, kinds)] for a, b in zip(bounds, bounds[1:]))
    one, other = chunks(text), chunks(text[:4000] + " inserted words " + text[4000:])
    assert sum((one - other).values()) <= 4 and sum(one.values()) > 250
    data = np.frombuffer(text.encode(), np.uint8)
    h, slow = substrings.gear(data, table), 0
    for i, b in enumerate(data[:200]):
        slow = (slow * 4 + int(table[b])) % (1 << 32)
        assert i < 16 or slow == int(h[i])


def test_chunks_that_stand_elsewhere_apart_are_no_span(spark):
    """Every chunk of document 0 stands in another document, but no two of them side by side."""
    table, kinds = substrings._gear_table(), substrings._kinds()
    text = prose(11, 400)
    data = text.encode()
    bounds = substrings.cuts(np.frombuffer(data, np.uint8), table, kinds)[0]
    pieces = [data[a:b].decode() for a, b in zip(bounds, bounds[1:])]
    # each chunk alone in a document of its own
    rows = [(0, text)] + [(i, f"{prose(900 + i, 30)} {p} {prose(1900 + i, 30)}") for i, p in enumerate(pieces, 1)]
    assert substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0
    # but a stretch of them in order is
    rows.append((5000, prose(77, 40) + " " + "".join(pieces[10:30]) + " " + prose(78, 40)))
    got = substrings.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert sorted(got.doc_id) == [0, 5000]
    span = got[got.doc_id == 0].iloc[0]
    assert text[span.span_start:span.span_end].strip() in "".join(pieces[10:30])


def test_long_chunks_are_cut_on():
    table, kinds = substrings._gear_table(), substrings._kinds()
    data = np.frombuffer(prose(5, 4000).encode(), np.uint8)
    for most in (1, 3, 19):
        bounds, words = substrings.cuts(data, table, kinds, most_words=most)
        assert words.max() <= most and words.sum() == 4000 and len(bounds) == len(words) + 1


def test_repeated_spans_odd_rows(odd_docs, no_docs):
    got = substrings.repeated_spans(odd_docs).toPandas()
    assert set(got.doc_id.dropna()) == {1, 2, 6, 7}
    assert got[got.doc_id == 1].original.all() and not got[got.doc_id == 7].original.any()
    cut = substrings.cut_repeats(odd_docs)
    assert cut.columns == odd_docs.columns and cut.count() == odd_docs.count()
    assert substrings.repeated_spans(no_docs).count() == 0 and substrings.cut_repeats(no_docs).count() == 0


# --- quality

def _labelled(spark, n=600):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(i, 60).split()
        rows.append((i, " ".join(w + "%%%" for w in words) if bad else " ".join(words).capitalize() + "."))
        labels.append((i, int(not bad), 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_held_out_accuracy(spark):
    docs, labels = _labelled(spark)
    got = quality.predict_quality(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert (got.held_out == [__import__("zlib").crc32(str(d).encode()) % 5 == 0 for d in got.doc_id]).all()
    out = got[got.held_out]
    assert len(out) > 50 and (out.predicted == out.quality).mean() > 0.97
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()


def test_quality_ignores_held_out_labels(spark):
    from pyspark.sql import functions as F

    docs, labels = _labelled(spark, 200)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = (sorted(map(tuple, quality.predict_quality(docs, x).collect())) for x in (labels, flipped))
    assert one == other


def test_quality_odd_rows(spark, odd_docs, no_docs):
    _, labels = _labelled(spark, 50)
    odd_labels = labels.unionAll(spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 0, 1), (2, 1, 1)], "doc_id long, quality int, toxic int"))
    got = quality.predict_quality(odd_docs, odd_labels)
    assert got.count() == odd_docs.count() and got.filter("score is null or predicted is null or held_out is null").count() == 0
    for empty in (odd_labels.limit(0), odd_labels.filter("quality = 1")):  # nothing to learn: keep
        assert {x.predicted for x in quality.predict_quality(odd_docs, empty).collect()} == {1}
    kept = quality.keep_quality(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert quality.predict_quality(no_docs, labels).count() == 0


def test_dual_descent_reaches_the_optimum():
    """At the end every row meets the optimality conditions, so no other weights have a smaller loss."""
    r = np.random.default_rng(0)
    rows = [np.unique(r.integers(0, 200, 30)).astype(np.int32) if i % 2 else np.unique(r.integers(100, 300, 30)).astype(np.int32) for i in range(120)]
    labels = np.array([1 if i % 2 else -1 for i in range(120)])
    weights, scale, bias = quality.descend(rows, labels, epochs=300)
    margins = np.array([quality.margin(x, weights, scale, bias) for x in rows])
    assert ((margins > 0) == (labels > 0)).mean() > 0.98


# --- packing

def test_best_fit_decreasing_against_plain_search():
    r = np.random.default_rng(0)
    for width in (1, 7, 64, 100):
        sizes = r.integers(1, width + 1, 300)
        rooms, want = [], []
        for p in np.argsort(-sizes, kind="stable"):
            fit = [i for i, room in enumerate(rooms) if room >= sizes[p]]
            if fit:
                rooms[min(fit, key=lambda i: rooms[i])] -= sizes[p]
            else:
                rooms.append(width - sizes[p])
            want.append(sorted(rooms))
        got = packing.best_fit_decreasing(sizes, width)
        assert sorted(i for x in got for i in x) == list(range(300))
        assert sorted(width - sizes[x].sum() for x in got) == sorted(rooms)


@pytest.mark.parametrize("width", [64, 2048])
def test_packing_round_trip(spark, odd_docs, no_docs, width, tmp_path):
    vocabulary = packing.Vocabulary(packing.VOCABULARY)
    decode = vocabulary.encoding().decode
    packed = packing.pack_tokens(odd_docs, width=width)
    rows = packed.collect()
    found = Counter()
    parts = defaultdict(list)
    for x in rows:
        ids = np.frombuffer(x.input_ids, vocabulary.kind)
        assert len(ids) == width and x.cu_seqlens[0] == 0 and x.cu_seqlens[-1] == x.tokens
        assert x.position_resets == (x.cu_seqlens if x.tokens < width else x.cu_seqlens[:-1])
        assert (ids[x.tokens:] == vocabulary.end).all()
        for k, (d, p) in enumerate(zip(x.doc_ids, x.pieces)):
            parts[d].append((p, ids[x.cu_seqlens[k]:x.cu_seqlens[k + 1]].tolist()))
    for d, own in parts.items():
        if len({p for p, _ in own}) == len(own):  # ids of one row
            whole = [i for _, ids in sorted(own) for i in ids]
            assert whole[-1] == vocabulary.end
            found[(d, decode(whole[:-1]))] += 1
    texts = Counter((x.doc_id, x.text or "") for x in odd_docs.collect())
    single = {d for d, n in Counter(d for d, _ in texts.elements()).items() if n == 1}
    assert {k: v for k, v in found.items() if k[0] in single} == {k: v for k, v in texts.items() if k[0] in single}
    assert packing.pack_tokens(no_docs, width=width).count() == 0
    files = packing.write_matrices(packed, str(tmp_path / "out"), width=width).collect()
    assert sum(f.rows for f in files) == len(rows)
    ids = np.load(tmp_path / "out" / f"{files[0].file}.ids.npy")
    positions, bounds = (np.load(tmp_path / "out" / f"{files[0].file}.{p}.npy") for p in ("positions", "cu_seqlens"))
    offsets = np.load(tmp_path / "out" / f"{files[0].file}.offsets.npy")
    assert ids.shape == positions.shape == (files[0].rows, width)
    for i in range(len(ids)):
        for a, b in zip(bounds[offsets[i]:offsets[i + 1]][:-1], bounds[offsets[i]:offsets[i + 1]][1:]):
            assert (positions[i, a:b] == np.arange(b - a)).all()
