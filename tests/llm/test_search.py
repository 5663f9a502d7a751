"""Exact top-k and the WARC index: against brute force and by reading back."""

import base64
import gzip
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import topk, warc

VECTORS = "vec_id long, embedding array<float>, rank int, score int, block int, centre int"


def _brute(rows, k, step=20):
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in whole:
        if q % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), d) for d, w in whole if d != q)
        out += [(q, r + 1, d, -s) for r, (s, d) in enumerate(scored[:k])]
    return sorted(out)


def _rows(n, dims, seed, hot=0):
    r = np.random.default_rng(seed)
    middles = r.normal(size=(6, dims)) * 3
    rows = [(i, (middles[i % 6] + r.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]
    same = rows[0][1]
    return [(i, same if i < hot else v) for i, v in rows]


@pytest.mark.parametrize(("n", "hot", "block"), [(300, 0, 2048), (700, 250, 64), (3, 0, 2048)])
def test_top_k_against_brute_force(spark, monkeypatch, n, hot, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = _rows(n, 8, n, hot)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    got = sorted(map(tuple, topk.top_k(df.filter("vec_id % 20 = 0"), df).collect()))
    assert got == _brute(rows, topk.K)


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, None]), (2, [float("nan"), 1.0]), (3, [float("inf"), 1.0]), (4, None), (5, []), (6, [2.0]),
            (20, [0.0, 0.0]), (21, [-1.0, 3.0]), (None, [1.0, 1.0]), (22, [1e6, 1e6]), (21, [-1.0, 3.0])]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], VECTORS)
    got = sorted(map(tuple, topk.top_k(df.filter("vec_id % 20 = 0"), df).collect()))
    assert got == _brute(rows, topk.K)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df.limit(0), df).count() == 0


def test_dual_search_prunes(spark):
    """Far clusters are never scored, and the result is still exact."""
    import pickle

    r = np.random.default_rng(1)
    points = np.rint(np.concatenate([r.normal(size=(300, 4)) + m for m in ([400, 0, 0, 0], [0, 400, 0, 0], [0, 0, -400, 0])])).astype(np.int64)

    def side(ids, pts):
        tree = topk.CoverTree(pts)
        order = np.array(tree.order)
        back = np.empty(len(order), int)
        back[order] = np.arange(len(order))
        places, radius, first, last, children = zip(*tree.nodes)
        assert sorted(tree.order) == list(range(len(pts)))
        for p, rad, a, b, _ in tree.nodes:  # every node covers its points
            assert np.sqrt(((pts[order[a:b]] - pts[p]) ** 2).sum(axis=1)).max() <= rad
        return topk.Side(ids[order].tobytes(), pts[order].astype("i8").tobytes(), "i8", pickle.dumps((back[list(places)].tolist(), radius, first, last, children)), 4)

    data, queries = side(np.arange(900), points), side(np.arange(10_000, 10_050), points[:50] + 1)
    seen = []
    plain = topk._products
    topk._products = lambda q, d, small: seen.append(len(d) * len(q)) or plain(q, d, small)
    try:
        best = topk.nothing_yet(queries)
        topk.dual_search(queries, data, 5, np.full(50, -np.inf), best)
    finally:
        topk._products = plain
    assert sum(seen) < 50 * 900 / 2
    for i, (ids, scores) in enumerate(best):
        want = sorted((-int(s), d) for d, s in zip(data.ids, data.whole @ queries.whole[i]))[:5]
        assert [(-s, d) for s, d in zip(scores, ids)] == want


PAGES = "page_id long, url string, html string, key string, file string, digest string"


def _pages(spark):
    rows = [(5, "http://a.Example.com/x?q=1", "<p>é</p>"), (3, "https://b.example.com/x", "<p>é</p>"), (4, None, None), (9, "no scheme", ""),
            (7, "http://a.example.com/x?q=1", "other"), (8, "http://a.example.com/odd\ttab\nline %41", "z" * 300_000), (1, "http://ü.org/ß", "other"), (2, "http://c.org", "one")]
    return spark.createDataFrame([(*r, "k", "f", "d") for r in rows], PAGES)


def test_warc_read_back(spark):
    got = {r.page_id: r for r in warc.archive_and_read(_pages(spark)).collect()}
    rows = {r.page_id: r for r in _pages(spark).collect()}
    assert set(got) == set(rows)
    for p, r in rows.items():
        payload = (r.html or "").encode()
        assert got[p].payload_bytes == len(payload)
        assert got[p].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert got[p].url == (None if r.url is None else warc.target_uri(r.url))
        same = [q for q, x in rows.items() if (x.html or "") == (r.html or "")]
        assert (got[p].record_type, got[p].refers_to) == (("response", None) if p == min(same) else ("revisit", min(same)))
    least = {r.page_id: r.record_type for r in warc.archive_and_read(_pages(spark), 6).collect()}
    assert [p for p, t in least.items() if t == "revisit"] == [5]  # the others' payloads are smaller


def test_warc_files_are_standard_and_index_finds_by_key(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    pages = _pages(spark).unionAll(_pages(spark).filter("page_id = 2"))
    captures = warc.write_warc(pages, root)
    for c in captures.collect():
        data = (tmp_path / "w" / "archive" / c.file).read_bytes()[c.offset:c.offset + c.length]
        record = gzip.decompress(data)
        head, _, rest = record.partition(b"\r\n\r\n")
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        length = int(head.decode().split("Content-Length: ")[1].split("\r\n")[0])
        assert len(rest) == length + 4
    shards = warc.write_index(captures, root, block_lines=2)
    keys = spark.createDataFrame([("com,example,a)/x?q=1",), ("org,c)",), ("zz",), ("",)], "key string")
    found = sorted((x.key, x.page_id) for x in warc.lookup(keys, shards, root).collect())
    assert found == [("", 4), ("com,example,a)/x?q=1", 5), ("com,example,a)/x?q=1", 7), ("org,c)", 2), ("org,c)", 2)]
    # more shards than one task may hold: the same rows by way of stretches of the shard table
    for most in (0, 2, 3):
        monkeypatch.setattr(warc, "BROADCAST_ROWS", most)
        assert sorted((x.key, x.page_id) for x in warc.lookup(keys, shards, root).collect()) == found
    with gzip.open(next((tmp_path / "w" / "index").glob("*.cdx.gz"))) as f:
        assert f.read()


def test_warc_empty(spark):
    assert warc.archive_and_read(_pages(spark).limit(0)).count() == 0


def test_url_key(spark):
    df = spark.createDataFrame([("https://www.Example.com/A?b#c",), (None,), ("x",)], "url string")
    assert [r[0] for r in df.select(warc.url_key(F.col("url"))).collect()] == ["com,example,www)/A?b#c", "", ")x"]
