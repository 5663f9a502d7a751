"""Periodic runs of words: online sparse diagonal dynamic programming.

A run is a stretch of words with smallest period q in which every word equals
the one q before it, that cannot be extended.  On the diagonal of lag d the
match length is the number of words in a row that equal the word d before
them.  The texts are read from the left; a word's earlier occurrences say which
diagonals are live there.  Each of those counts one match more, and one that
was live and is not met again has ended and gives its run at once.

What keeps the diagonals sparse and the result whole: a run of smallest period
d repeats d words at least ``exponent - 1 >= 2`` times, so a gram of g words,
g <= d < 2g, recurs at lag d all along it.  Diagonals of those lags are driven by the
earlier occurrences of g-grams, one level for each power of two g.  Of these only
grams count that did not occur within the last g/2 words: were all grams of a
run periodic below g/2, the run itself would be.  Occurrences of a gram that is not
periodic are more than g/2 apart, so at most three earlier ones have a lag in
[g, 2g).  A diagonal is therefore counted through its first such gram, and words
around that are compared one by one.  The work is O(n log n) for any text, also one
that repeats a single word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import map_slices, read_table, ship_by_value

ship_by_value(__name__)

#: A run has at least so many words, and so many periods.
MIN_WORDS = 6
MIN_EXPONENT = 4
#: Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"\x20\x09-\x0D"
_WORD = re.compile(f"[^{BLANKS}]+")
#: Earlier occurrences of a gram whose lag can lie in its level, see above.
_BACK = 3
NEW = ("n_words", "runs", "collapsed")


def _numbers(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense numbers of equal keys, and how often each number occurs."""
    _, number, count = np.unique(keys, return_inverse=True, return_counts=True)
    return number, count


def _incidences(word: np.ndarray, first: np.ndarray, last: np.ndarray, exponent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per gram length g: (g, positions, lags) of earlier occurrences at lags of [g, 2g), by position.

    ``first`` and ``last`` hold, per word, the bounds of its text in the concatenation;
    equal numbers of ``word`` are equal words of one text.
    """
    n = len(word)
    longest = int((last - first).max(initial=0))
    number, count = _numbers(word)
    at = np.flatnonzero(count[number] > 1)     # positions whose gram occurs again in its text
    gram = np.full(n, -1, np.int64)
    gram[at] = number[at]
    g = 1
    while len(at) and exponent * g <= longest:
        order = at[np.argsort(gram[at], kind="stable")]
        same = gram[order]
        near = np.full(len(order), n, np.int64)
        near[1:] = np.where(same[1:] == same[:-1], order[1:] - order[:-1], n)
        found_at, found_lag = [], []
        for back in range(1, min(_BACK, len(order) - 1) + 1):
            lag = order[back:] - order[:-back]
            keep = ((same[back:] == same[:-back]) & (lag >= g) & (lag < 2 * g) & (2 * near[back:] > g)
                    & (exponent * lag <= (last - first)[order[back:]]))
            found_at.append(order[back:][keep])
            found_lag.append(lag[keep])
        if found_at:
            place, lag = np.concatenate(found_at), np.concatenate(found_lag)
            by = np.lexsort((lag, place))
            yield g, place[by], lag[by]
        # grams of twice the length, of those positions only where both halves recur
        both = at[at + g < n]
        both = both[gram[both + g] >= 0]
        number, count = _numbers(gram[both] * n + gram[both + g]) if len(both) else (both, both)
        keep = count[number] > 1 if len(both) else np.zeros(0, bool)
        gram[:] = -1
        at = both[keep]
        gram[at] = number[keep]
        g *= 2


def find_runs(texts: list[list[str]], min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """Per text of words, its runs (start, length, period) by start, then period.

    ``exponent`` is at least 3: the proof above needs two repeats of the period.
    """
    if exponent < 3:
        raise ValueError("exponent is at least 3")
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(texts) or not ends[-1]:
        return out
    text = np.repeat(np.arange(len(texts)), sizes)
    code, words = pd.factorize(np.array([w for t in texts for w in t], object))
    code = code.astype(np.int64)
    first, last = (ends - sizes)[text], ends[text]
    found: dict[tuple[int, int], int] = {}     # (start, end) -> smallest period

    def close(g: int, lag: int, begin: int, stop: int, counted: dict[int, int]) -> None:
        """The diagonal of ``lag`` matched grams at begin..stop: its whole stretch, and the run if long enough."""
        if counted.get(lag, -1) > begin:
            return   # a part of a stretch counted before, met again behind short periods
        low, high = int(first[begin]) + lag, int(last[begin])
        stop += g
        while stop < high and code[stop] == code[stop - lag]:
            stop += 1
        while begin > low and code[begin - 1] == code[begin - 1 - lag]:
            begin -= 1
        counted[lag] = stop
        if stop - begin + lag >= max(min_words, exponent * lag):
            key = (begin - lag, stop)
            # a multiple of the smallest period has the same stretch
            found[key] = min(lag, found.get(key, lag))

    for g, places, lags in _incidences(text * len(words) + code, first, last, exponent):
        counted: dict[int, int] = {}
        live: dict[int, int] = {}    # lag -> where its stretch of matches began, as of the last position
        now: dict[int, int] = {}     # the same as of this position
        at = -2
        for place, lag in zip(places.tolist(), lags.tolist(), strict=True):
            if place != at:
                for ended, begin in live.items():
                    close(g, ended, begin, at - 1, counted)
                live, now = now, {}
                if place != at + 1:
                    for ended, begin in live.items():
                        close(g, ended, begin, at, counted)
                    live = {}
                at = place
            now[lag] = live.pop(lag, place)
        for ended, begin in live.items():
            close(g, ended, begin, at - 1, counted)
        for ended, begin in now.items():
            close(g, ended, begin, at, counted)
    offset = ends - sizes
    for (start, end), period in sorted(found.items(), key=lambda x: (x[0][0], x[1])):
        own = int(text[start])
        out[own].append((start - int(offset[own]), end - start, period))
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return [w for w, k in zip(words, keep, strict=True) if k]


def periodic_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, exponent: int = MIN_EXPONENT) -> DataFrame:
    """The input's columns, ``n_words``, ``runs`` (array of start, length, period) and ``collapsed``, per row.

    Words are what lies between ASCII blanks.  ``runs`` holds every maximal
    run of at least ``min_words`` words and ``exponent`` periods, by start,
    then period; ``collapsed`` the words outside of repeats joined by one
    space.  Rows are worked on alone, in slices bounded by rows and bytes.

    Null, empty or blank text: no word, no run, empty ``collapsed``.  Equal
    rows give equal results, one each.  Null ids are not looked at.  Empty
    table: empty result.  An input column named like a new one is replaced.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in NEW or c == text])
    kept = [c for c in docs.columns if c not in NEW]
    own = T.StructType([f for f in docs.schema.fields if f.name in kept])
    # the other columns travel as one struct, so none can clash with what workers add
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    runs = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))
    schema = T.StructType([T.StructField("row", own), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", runs), T.StructField("collapsed", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [_WORD.findall(t) if isinstance(t, str) else [] for t in frame["text"]]
            found = find_runs(texts, min_words, exponent)
            yield pd.DataFrame({
                "n_words": [len(t) for t in texts],
                "runs": [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in found],
                "collapsed": [" ".join(collapse(t, rs)) for t, rs in zip(texts, found, strict=True)]})

    return map_slices(packed, run, schema, carry=("row",)).select("row.*", *NEW)


def _planted(docs: DataFrame) -> DataFrame:
    """Documents (doc_id, text) in which the words of every tenth id repeat periodically from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", f"[{BLANKS}]+"), lambda w: w != "")
    drawn = F.col("h") % 10 == 0
    own = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), h.alias("h"))
           .withColumn("g", F.floor(F.col("h") / 10)).withColumn("words", F.when(drawn, words)))
    own = own.withColumn("n", F.size("words").cast("long"))
    own = own.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    own = own.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    again = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get(
        "words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return own.select("doc_id", F.when(drawn & (F.col("n") > 0), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents after the planted repeats.  A null id plants nothing."""
    found = periodic_runs(_planted(read_table(spark, sf_dir, "documents")))
    best = F.col("best")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["start"]).alias("start"), best["length"].alias("length"),
        (-best["period"]).alias("period"), F.floor(1000 * best["length"] / -best["period"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
