"""Benchmark decontamination: BM25 over an inverted index of test items, block-max WAND, overlap check.

The test items are indexed: per term the items that hold it, with the BM25
impact divided by the item's score against itself, so one threshold fits all
items.  Postings are cut into blocks of items with the largest impact of each.
Every training text is cut into overlapping passages, and every passage is a
query that retrieves all items above the threshold:

* passages whose terms' largest impacts, summed per group of blocks, stay below
  the threshold in every group hold none (decided for all passages of a text
  at once);
* the others walk the postings document at a time: the pivot is the first item
  whose terms' largest impacts reach the threshold, and it is scored only if
  the largest impacts of the blocks around it reach it too; otherwise whole
  blocks are skipped.

A retrieved item contaminates a document if the document's passage holds
enough of the item's question and of its answer: of their word runs or, so that
a changed, new or missing word doesn't break all runs of a short part, of their
words in order.

The index is built segment by segment, of at most ``SEGMENT_ITEMS`` items, and
each segment is broadcast by itself; texts are read once per segment and
length class.  Passages are twice as long as the longest item of the class
and overlap by half, so every item lies whole in one of them.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import map_slices, read_table, ship_by_value, written

ship_by_value(__name__)

K1, B = 1.2, 0.75
#: Least share of an item's own score.
THRESHOLD = 0.5
#: Least shares of the question's and of the answer's word runs found in the passage.
QUESTION, ANSWER = 0.6, 0.6
RUN = 5
#: Least share of a part's words in order that counts as overlap, and the longest part that is aligned; from 17 words on
#: one edit leaves 0.6 of the runs.
NEAR, ALIGNED = 0.8, 64
BLOCK_ITEMS = 2
#: Bytes of the table of largest impacts per term and group of blocks.
GROUP_BYTES = 32 << 20
#: Rows of that table gathered at a time.
_GATHER = 1 << 15
#: Items and bytes of text in an index segment, the size bound of what is broadcast.
SEGMENT_ITEMS, SEGMENT_BYTES = 20_000, 16 << 20
#: Items of up to so many words share passages; longer ones fall into classes four times as long each.
CLASS_WORDS = 64
_WORD = re.compile(r"\w+")
_END = 1 << 60

LEAKS = "doc_id long, item_id long, passage int, score double, question_overlap double, answer_overlap double"


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """An item without separate fields: its last fifth of words, one run at least, is the answer."""
    words = tokens(text)
    cut = len(words) - max(min(RUN, len(words)), len(words) // 5)
    return (words[:cut], words[cut:]) if cut >= RUN else (words, words)


def runs(words: list[str], size: int = RUN) -> set[tuple[str, ...]]:
    """The runs of ``size`` words; all words if there are fewer."""
    n = min(size, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def aligned(part: list[str], passage: list[str], least: float = NEAR) -> float:
    """Share of the part's words that stand in their order in the best window of the passage, 0 if below ``least``.

    A window is a quarter and a word longer than the part.  The longest common
    subsequence is found a passage word at a time, all words of the part in the bits of a number.
    """
    size = len(part)
    width, full = size + 1 + size // 4, (1 << size) - 1
    masks: dict[str, int] = {}
    for i, word in enumerate(part):
        masks[word] = masks.get(word, 0) | 1 << i
    found = [(i, masks[word]) for i, word in enumerate(passage) if word in masks]
    at = [i for i, _ in found]
    best = math.ceil(least * size - 1e-9) - 1
    for k, start in enumerate(at):
        end = bisect_left(at, start + width, k)
        if end - k <= best:
            continue
        free = full
        for _, mask in found[k:end]:
            own = free & mask
            free = ((free + own) | (free - own)) & full
        best = max(best, size - free.bit_count())
    return best / size if best >= least * size - 1e-9 else 0.0


class Index:
    """The inverted index of a segment: postings by term, sorted by item, with impacts and block maxima."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], count: int, mean: float):
        """``items``: (id, text) of the segment; document frequencies, count and mean length are of all items."""
        self.ids = [i[0] for i in items]
        self.parts = [question_and_answer(i[1]) for i in items]
        words = [tokens(i[1]) for i in items]
        self.span = max([len(w) for w in words], default=0)
        idf = lambda t: math.log(1 + (count - frequency[t] + 0.5) / (frequency[t] + 0.5))
        found: dict[str, list[tuple[int, float]]] = {}
        for d, own in enumerate(words):
            impacts = {t: idf(t) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(own) / mean)) for t, n in Counter(own).items()}
            whole = sum(impacts.values())
            for t, x in impacts.items():
                found.setdefault(t, []).append((d, x / whole))
        self.terms = {t: k for k, t in enumerate(sorted(found))}
        self.lists = [[d for d, _ in found[t]] for t in self.terms]
        self.impacts = [[x for _, x in found[t]] for t in self.terms]
        self.most = np.array([max(x) for x in self.impacts])
        self.blocks = []
        for at, x in zip(self.lists, self.impacts, strict=True):
            best: dict[int, float] = {}
            for d, v in zip(at, x, strict=True):
                best[d // BLOCK_ITEMS] = max(best.get(d // BLOCK_ITEMS, 0.0), v)
            self.blocks.append(best)
        blocks = -(-len(items) // BLOCK_ITEMS)
        wide = -(-blocks // max(1, min(blocks, GROUP_BYTES // (4 * max(1, len(self.terms))))))
        self.groups = np.zeros((len(self.terms), -(-blocks // wide)), np.float32)
        for t, best in enumerate(self.blocks):
            for block, x in best.items():
                # rounded up, so that a bound stays one
                self.groups[t, block // wide] = max(self.groups[t, block // wide], np.nextafter(np.float32(x), np.float32(1)))
        self.wanted = [(runs(q), runs(a), min(RUN, len(a))) for q, a in self.parts]

    def search(self, query: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items that the distinct terms score at ``threshold`` or more: block-max WAND."""
        out = []
        cursors = [[self.lists[t][0], 0, t] for t in query]
        most, lists, impacts, blocks = self.most, self.lists, self.impacts, self.blocks
        slack = threshold - 1e-9
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += most[t]
                if bound >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK_ITEMS
            if sum(blocks[t].get(block, 0.0) for _, _, t in cursors[:pivot + 1]) < slack:
                # nothing up to the block's end, or to the next cursor, can reach the threshold
                to = (block + 1) * BLOCK_ITEMS
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, item + 1)
            elif cursors[0][0] == item:
                score = sum(impacts[t][at] for _, at, t in cursors[:pivot + 1])
                if score >= slack:
                    out.append((item, score))
                to = item + 1
            else:
                to = item
            for c in cursors[:pivot + 1]:
                if c[0] < to:
                    own = lists[c[2]]
                    c[1] = bisect_left(own, to, c[1])
                    c[0] = own[c[1]] if c[1] < len(own) else _END
            cursors = [c for c in cursors if c[0] < _END]
        return out


def passage_queries(texts: list[list[str]], index: Index, threshold: float) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, passage, distinct terms) of the passages that some group of blocks may score at ``threshold`` or more.

    Passage p of a text covers its words from p * span to (p + 2) * span.  All
    texts are looked at together.
    """
    span, count = max(1, index.span), max(1, len(index.most))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.cumsum(sizes) - sizes
    last = np.maximum(-(-sizes // span) - 2, 0)
    base = np.cumsum(last + 1) - (last + 1)  # passages are numbered through
    found = np.fromiter(map(index.terms.get, chain.from_iterable(texts), repeat(-1)), np.int64, int(sizes.sum()))
    at = np.flatnonzero(found >= 0)
    if not len(at):
        return
    own = np.repeat(np.arange(len(texts)), sizes)[at]
    part = (at - starts[own]) // span
    terms, first, final = found[at], base[own], base[own] + last[own]
    both = np.concatenate([np.minimum(first + part, final), np.maximum(first + part - 1, first)])
    keys = both * count + np.concatenate([terms, terms])
    if keys.max() < 1 << 31:
        keys = keys.astype(np.int32)
    passage, term = np.divmod(np.unique(keys), count)
    near = (np.bincount(passage, weights=index.most[term]) >= threshold - 1e-9)[passage]
    passage, term = passage[near], term[near]
    start = 0
    while start < len(passage):
        end = min(start + _GATHER, len(passage))
        end = int(np.searchsorted(passage, passage[end - 1], side="right"))  # whole passages
        firsts = np.flatnonzero(np.diff(passage[start:end], prepend=-1))
        bounds = np.add.reduceat(index.groups[term[start:end]], firsts, axis=0).max(axis=1)
        ends = np.append(firsts[1:], end - start) + start
        for i in np.flatnonzero(bounds >= threshold - 1e-5):
            number = int(passage[start + firsts[i]])
            text = int(np.searchsorted(base, number, side="right")) - 1
            yield text, number - int(base[text]), term[start + firsts[i]:ends[i]]
        start = end


def overlap(part: list[str], own: set[tuple[str, ...]], passage: list[str], held: set[tuple[str, ...]]) -> float:
    """The larger of the shares of the part's runs ``own`` among the passage's, and of its aligned words."""
    share = len(own & held) / len(own)
    return max(share, aligned(part, passage)) if share < 1 and RUN <= len(part) <= ALIGNED else share


def _search(shared, threshold: float, question: float, answer: float, kind: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index: Index = shared.value
        span = max(1, index.span)
        for batch in batches:
            ids, texts = batch["doc_id"].tolist(), [tokens(t) for t in batch["text"]]
            best: dict[tuple[int, int], tuple] = {}
            for text, p, query in passage_queries(texts, index, threshold):
                hits = index.search(query.tolist(), threshold)
                if not hits:
                    continue
                passage = texts[text][p * span:(p + 2) * span]
                held = {RUN: runs(passage)}
                for item, score in hits:
                    asked, told, size = index.wanted[item]
                    if size not in held:
                        held[size] = runs(passage, size)
                    q, a = (overlap(part, own, passage, held[size]) for part, own in zip(index.parts[item], (asked, told), strict=True))
                    if q >= question and a >= answer and ((text, item) not in best or score > best[text, item][1]):
                        best[text, item] = (p, score, q, a)
            rows = [(ids[text], index.ids[item], *x) for (text, item), x in best.items()]
            yield pd.DataFrame(rows, columns=["doc_id", "item_id", "passage", "score", "question_overlap", "answer_overlap"]).astype({"doc_id": kind})

    return run


def _segments(items: DataFrame) -> Iterator[Index]:
    """The index of the items, a bounded segment at a time; classes of length don't mix."""
    counted = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInPandas(_terms_of, "item_id long, text string, words int, terms array<string>")
    counted = written(counted.filter("words > 0"), "items")
    count, mean = counted.agg(F.count("*"), F.avg("words")).first()
    if not count:
        return
    level = F.greatest(F.lit(0), F.ceil(F.log(4.0, F.col("words") / CLASS_WORDS))).cast("int")
    frequency = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    placed = written(counted.withColumn("level", level).withColumn("bytes", F.octet_length("text").cast("long")), "placed")
    for (k, n, size) in placed.groupBy("level").agg(F.count("*"), F.sum("bytes")).orderBy("level").collect():
        parts = max(-(-n // (SEGMENT_ITEMS // 2)), -(-size // (SEGMENT_BYTES // 2)))
        for part in range(parts):
            own = placed.filter((F.col("level") == k) & (F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part))
            known = frequency.join(own.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")
            found = sorted((r.item_id if r.item_id is not None else -1, r.text) for r in own.select("item_id", "text").toLocalIterator())
            if found:
                yield Index(found, {r.term: r.df for r in known.toLocalIterator()}, count, mean)


def _terms_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        words = [tokens(t) for t in batch["text"]]
        yield batch.assign(words=[len(w) for w in words], terms=[sorted(set(w)) for w in words])


def find_leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, question: float = QUESTION, answer: float = ANSWER) -> DataFrame:
    """(doc_id, item_id, passage, score, question_overlap, answer_overlap) of each document and each item it holds.

    ``score`` is the BM25 score over the item's score against itself, of the
    document's best passage for the item; ``passage`` its number.  An overlap is
    the share of a part's word runs in the passage or that of its words in
    order, if this is larger and at least ``NEAR``.

    Null or empty texts and items without words match nothing; an item shorter
    than a word run is looked for whole.  Items with equal texts are found
    each; a null item id reads -1.  Repeated rows: each document row that holds an
    item gives a row.  Empty tables: empty result.  Other columns are not read.
    """
    return _leaks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), items, LEAKS, "Int64", threshold, question, answer)


def _leaks(rows: DataFrame, items: DataFrame, schema: str, kind: str, threshold: float = THRESHOLD, question: float = QUESTION,
           answer: float = ANSWER) -> DataFrame:
    """``find_leaks`` of (doc_id, text), the id of pandas' ``kind``."""
    spark, rows = rows.sparkSession, rows.filter("text is not null")
    out = spark.createDataFrame([], schema)
    for index in _segments(items):
        out = out.unionAll(map_slices(rows, _search(spark.sparkContext.broadcast(index), threshold, question, answer, kind), schema))
    return out


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, with their columns, that hold no item.  Rows without an id stay."""
    leaks = written(find_leaks(docs, items).filter("doc_id is not null").select(F.col("doc_id").alias("leak_id")).distinct(), "leaks")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("of"))
    return own.join(leaks, own["of"] == leaks["leak_id"], "left_anti").select("row.*")


def keep_clean_rows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, with their columns, whose text holds no item, whatever rows have the same id or none."""
    texts = docs.select(F.md5("text").alias("doc_id"), "text")
    leaks = written(_leaks(texts, items, LEAKS.replace("doc_id long", "doc_id string"), "object").select(F.col("doc_id").alias("leak")).distinct(), "leaks")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.md5("text").alias("digest"))
    return own.join(leaks, own["digest"] == leaks["leak"], "left_anti").select("row.*")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
