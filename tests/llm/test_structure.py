"""Conversation repair, page text and periodic runs: against brute force, the SQL and odd rows."""

import hashlib
import random
import re
import zlib
from itertools import pairwise

import duckdb
import pytest
from pyspark.sql import functions as F

from llm_helpers import clashing, no_docs, odd_docs  # noqa: F401
from tessera.llm import pathratio, runs, turns

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- conversations ---

def _cheapest(kinds: str) -> tuple[int, str]:
    """All labels (cost, audit) per last role initial, none dropped: for a handful of rows only."""
    now = {"^": {(0, "")}}

    def inserted(states):
        out = {s: set(v) for s, v in states.items()}
        for _ in range(2):
            more = {}
            for s, labels in out.items():
                more.setdefault("a" if s == "u" else "u", set()).update((c + 5, a + "I") for c, a in labels)
            for s, labels in more.items():
                out.setdefault(s, set()).update(labels)
        return out

    for kind in kinds:
        after: dict = {}
        for s, labels in inserted(now).items():
            for c, a in labels:
                after.setdefault(s, set()).add((c + 2, a + "D"))
                if kind != "x":
                    extra, initial = 5 * kind.isupper(), kind.lower()
                    if s + initial in ("^s", "^u", "su", "ua", "au"):
                        after.setdefault(initial, set()).add((c + extra, a + "K"))
                    after.setdefault("a" if s == "u" else "u", set()).add((c + extra + 1, a + "R"))
        now = after
    return min(x for s, labels in inserted(now).items() if s in "^a" for x in labels)


def test_search_against_all_repairs():
    r = random.Random(3)
    for _ in range(150):
        kinds = "".join(r.choice("uasoxUASO") for _ in range(r.randint(0, 4)))
        assert turns.search(kinds) == _cheapest(kinds)


def test_pieces_give_what_one_search_gives():
    r = random.Random(4)
    for _ in range(200):
        kinds = "".join(r.choice("uauauasoxUA") for _ in range(r.randint(0, 50)))
        size = r.randint(1, 9)
        tables = []
        for i in range(0, len(kinds), size):
            tables.append({(e, last): f for e in range(4) for last in range(4)
                           if (f := turns.search(kinds[i:i + size], e, (last,), closing=False))})
        assert turns.chain(iter(tables)) == turns.search(kinds)


CONV = "conv_id long, turn long, role string, text string"


def _conversations(spark, rows=None):
    r = random.Random(9)
    if rows is None:
        rows = [(c, t, r.choice(["user", "assistant", "system", "tool", "", None, "usr"]),
                 r.choice(["Yes.", "no", "Ok! \n", "", " \t", None, "A. b", "é?", "x" * 3000 + "."]))
                for c in range(40) for t in range(r.randint(1, 9))]
        rows += [(None, None, None, None), (None, 3, "user", "a."), (7, None, "user", "b."), (7, None, "user", "b."), (7, 2, "assistant", "c."),
                 (3, 1, "user", "Yes."), (3, 1, "user", "Yes."), (900, 0, "system", "S.")]
        # one conversation of a third of all rows
        rows += [(5, t, "user" if t % 2 else "assistant", f"turn {t % 60}" + "." * (t % 7 > 0)) for t in range(150)]
    return spark.createDataFrame(rows, CONV)


def _expected(conversations):
    con = duckdb.connect()
    con.register("conversations", conversations.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    return con.execute(turns.SQL).fetchall()


@pytest.mark.parametrize("piece", [1024, 7])
def test_repair_equals_sql(spark, monkeypatch, tmp_path, piece):
    monkeypatch.setattr(turns, "PIECE", piece)
    conversations = _conversations(spark)
    conversations.write.parquet(f"{tmp_path}/conversations.parquet")
    got = turns.op11(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(_expected(conversations), key=str)


def test_repaired_rows_are_legal(spark):
    conversations = _conversations(spark)
    found, repaired = turns.repair_conversations(clashing(conversations))
    rows = repaired.orderBy("conv_id", "position").collect()
    by = {}
    for r in rows:
        by.setdefault(r.conv_id, []).append(r)
    for own in by.values():
        assert [r.position for r in own] == list(range(len(own)))
        assert re.fullmatch("s?(ua)+", "".join(r.role[0] for r in own))
    audits = {r.conv_id: r for r in found.collect()}
    assert set(audits) == {r.conv_id for r in conversations.select("conv_id").distinct().collect()}
    for conv, r in audits.items():
        assert len(by.get(conv, [])) == sum(e != "D" for e in r.audit)
        assert turns.repaired_sha256(repaired).filter(F.col("conv_id").eqNullSafe(F.lit(conv).cast("long"))).count() == (conv in by)
        if len(audits) > 10 and conv and conv > 3:
            break


def test_many_equal_rows_are_one_hot_group(spark):
    rows = [(1, 0, "user", "Same.")] * 3000 + [(1, 1, "assistant", "Yes.")] + [(2, 0, "user", "")] * 50
    found, repaired = turns.repair_conversations(_conversations(spark, rows))
    got = {r.conv_id: r for r in found.collect()}
    assert (got[1].duplicate, got[1].illegal, got[1].cost, got[1].audit) == (2999, 2999, 5998, "K" + "D" * 2999 + "K")
    assert (got[2].blank, got[2].duplicate, got[2].audit) == (50, 0, "D" * 50)
    assert [tuple(r) for r in repaired.orderBy("position").collect()] == [(1, 0, "user", "Same."), (1, 1, "assistant", "Yes.")]


def test_no_conversations(spark, tmp_path):
    _conversations(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert turns.op11(spark, str(tmp_path)).count() == 0


# ------------------------------------------------------------------------ pages ---

def test_page_without_article_keeps_its_content_and_drops_furniture():
    page = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="content"><h2>Title</h2>
      <p>A long paragraph, with commas, and text that goes on. It really does.</p><p>Second. <a href=x>A link</a> and <b>bold</b>.</p>
      <ul><li>One<li>Two</ul><span class=ad>BUY</span></div>
      <div class="comments"><p>I think, really, that this is a very good article. Truly, I do. Good work!</p></div>
      <div class="cookie-notice"><p>We use cookies, and so on, for many reasons, which are long.</p></div>
      <div class=side-bar>hi</div><aside>aside, long, long, long. text</aside><form><p>Sign up, now, here.</p></form><footer>c 2020</footer>"""
    assert pathratio.main_text(page) == ("Title\nA long paragraph, with commas, and text that goes on. It really does.\n"
                                         "Second. A link and bold.\nOne\nTwo")


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<", "<"), ("<!-- open <p>x", ""), ("<script>x<p>y", ""), ('<a "', ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"),
    ("<article><p>Ti.</article><div><p>A far longer advert, with commas, and more. And more.</p></div>", "Ti."),
    ("<article><header><h1>T</h1></header>x<br>y<table><tr><td>1<td>2</table><div class=article-comments>c</div></article>", "T\nx y\n1\n2"),
    ("<form><article><p>in a form</p><form>mail <button>ok</button></form></article></form>", "in a form"),
    ("<p>a &lt;b&gt;&nbsp; c &#x41;&eacute; &am &amp;amp;</p>", "a <b> c Aé &am &amp;"),
    ("<main><nav>menu</nav><p>t<span>y</span>z <a href=q>l1<a href=r>l2</a> e</main>", "tyz l1l2 e"),
    ('<article><p title="a > b">x</p><style>p{}</style><p>y<img src=z>z</p><!-- no --></article>', "x\nyz"),
])
def test_page_cases(page, text):
    assert pathratio.main_text(page) == text


def test_deep_and_broken_pages_take_linear_time():
    for page in ("<div>" * 30_000 + "x", "<b>" * 30_000 + "x</i>" * 30_000, "<p>" * 50_000, '<a "' * 50_000, "<!--" * 50_000):
        pathratio.main_text(page)


def test_page_rows(spark, no_docs):
    rows = [(1, "u", "<article>a&amp;b</article>"), (1, "u", "<article>a&amp;b</article>"), (None, None, None), (2, "v", "𝒳 <p>é</p>")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    out = pathratio.extract_text(pages.withColumn("text", F.lit(0)).withColumn("markup", F.lit("m")))
    got = sorted(((r.page_id, r.url, r.text, r.n_chars, r.rank, r.markup) for r in out.collect()), key=str)
    assert got == sorted([(1, "u", "a&b", 3, 7, "m"), (1, "u", "a&b", 3, 7, "m"), (None, None, "", 0, 7, "m"), (2, "v", "𝒳\né", 3, 7, "m")], key=str)
    assert pathratio.extract_text(pages.limit(0)).count() == 0


# ------------------------------------------------------------------------- runs ---

def _brute_runs(words):
    out = set()
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            if words[i] != words[i - q]:
                i += 1
                continue
            start = i - q
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            own = words[start:i]
            if len(own) >= max(6, 4 * q) and q == next(p for p in range(1, q + 1) if own[p:] == own[:-p]):
                out.add((start, len(own), q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def _text_with_repeats(r):
    words = []
    for _ in range(r.randint(0, 6)):
        if r.random() < 0.6:
            unit = [r.choice("abc") for _ in range(r.randint(1, 14))]
            if r.random() < 0.4:
                unit = [r.choice("ab")] * r.randint(2, 20) + unit
            words += (unit * 10)[:int(len(unit) * r.uniform(1, 9))]
        else:
            words += [r.choice("abcde") for _ in range(r.randint(0, 20))]
    return (words * 6)[:r.randint(0, 900)] if r.random() < 0.3 else words[:900]


def test_runs_against_brute_force():
    r = random.Random(5)
    for _ in range(120):
        texts = [_text_with_repeats(r) for _ in range(r.randint(1, 4))]
        assert runs.find_runs(texts) == [_brute_runs(t) for t in texts]


def test_runs_of_long_texts():
    assert runs.find_runs([["a"] * 200_000]) == [[(0, 200_000, 1)]]
    assert runs.find_runs([["a", "b"] * 50_000 + ["c"] + ["a", "b"] * 9_000]) == [[(0, 100_000, 2), (100_001, 18_000, 2)]]
    unit = [str(i * (i % 97)) for i in range(30_000)]
    assert runs.find_runs([["x"] + unit * 5]) == [[(1, 150_000, 30_000)]]


def _digest_row(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = _brute_runs(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_periodic_runs_query_against_brute_force(spark, tmp_path, odd_docs, no_docs):
    r = random.Random(6)
    rows = [(i, r.choice([" ", "\n", "\t \x0b"]).join(_text_with_repeats(r)) + r.choice(["", " ", " ."]), "en", "a", 1) for i in range(300)]
    rows += [(i, " ".join(str(k) for k in range(i % 90)), "en", "a", 1) for i in range(300, 500)] + [rows[4], (None, "a " * 30, None, None, None)]
    odd = odd_docs.select("doc_id", F.substring("text", 1, 900).alias("text"), "lang", "source", "n_chars")
    docs = clashing(spark.createDataFrame(rows, odd.schema).union(odd))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = runs.op13(spark, str(tmp_path)).collect()
    want = [_digest_row(x.doc_id, x.text) for x in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want if w[0] is not None and w[0] >= 300 and zlib.crc32(str(w[0]).encode()) % 10 == 0) > 0
    no_docs.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert runs.op13(spark, f"{tmp_path}/none").count() == 0


def test_periodic_runs_keep_other_columns(spark, odd_docs):
    docs = odd_docs.withColumn("runs", F.lit("mine")).withColumn("row", F.lit("r")).withColumn("n_words", F.lit(1.5))
    out = runs.periodic_runs(docs)
    assert out.columns == [c for c in odd_docs.columns if c not in runs.NEW] + list(runs.NEW)
    assert out.count() == docs.count() and {r.row for r in out.select("row").collect()} == {"r"}
    assert all(a < b for own in out.select("runs").collect() for a, b in pairwise([(x.start, x.period) for x in own.runs]))
