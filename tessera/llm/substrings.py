"""Substring dedup by content-defined chunking with a gear rolling hash.

A text is cut before the words at which the rolling hash of the bytes just
read is least among its ``REACH`` neighbours on both sides.  A cut depends on
those few words alone, so an insertion moves only the cuts around it and equal
passages are cut alike wherever they stand.  Of equal hashes each is least, so
a word repeated on and on is cut at every word.  A chunk that would hold as many words as a
span must is cut on from its own start, so that no span is a single chunk.  Each pair of
neighbouring chunks is a digest of 128 bits; pairs that occur more than once are links, and chains
of links of at least ``LEAST_WORDS`` words are reported as repeated spans.  Chunks that each stand
elsewhere, but not side by side, make none.

A passage of 50 words holds cuts at 7 words on average; a span lies inside its
passage, short of it by the few words on either side whose cuts also depend on
the text around.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import map_slices, read_table, ship_by_value, written

ship_by_value(__name__)

#: A cut is a minimum among so many words on either side; but for ties chunks are longer than that.
REACH = 3
#: Least words of a repeated run of chunks; with the edges it falls short of, a passage of 50 words has more.
LEAST_WORDS = 20

PAIRS = "uid long, doc_id long, no int, start int, length int, words int, next_words int, high long, low long"


def _gear_table() -> np.ndarray:
    return np.random.default_rng(1).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """At each byte h = 4 h + table[byte] modulo 2^32: a hash of the last 16 bytes, here summed by doubling."""
    h = table[data]
    for width in (1, 2, 4, 8):
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint32(2 * width)
        h = wider
    return h


def _kinds() -> np.ndarray:
    """1 for white space, 2 for the first bytes of characters that scripts without spaces use."""
    kinds = np.zeros(256, np.uint8)
    kinds[[9, 10, 11, 12, 13, 32]] = 1
    kinds[0xE3:0xF5] = 2
    return kinds


def cuts(data: np.ndarray, table: np.ndarray, kinds: np.ndarray, reach: int = REACH,
         most_words: int = LEAST_WORDS - 1) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, words): the places of the chunks from 0 to the end, and the number of words of each, ``most_words`` at most."""
    kind = kinds[data]
    space = kind == 1
    starts = ~space
    starts[1:] &= space[:-1] | (kind[1:] == 2)
    at = np.flatnonzero(starts)
    inner = at[1:]  # a cut lies before any word but the first
    value = gear(data, table)[inner - 1]
    cut = np.ones(len(inner), bool)
    for r in range(1, min(reach, len(inner) - 1) + 1):
        cut[r:] &= value[r:] <= value[:-r]
        cut[:-r] &= value[:-r] <= value[r:]
    if len(inner) == 1:
        cut[:] = False
    number = np.arange(1, len(at))
    since = number - np.maximum.accumulate(np.where(cut, number, 0))
    cut |= (since > 0) & (since % most_words == 0)
    bounds = np.concatenate([[0], inner[cut], [len(data)]])
    first = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(at)]])
    return bounds, np.diff(first)


def _pair_up(batches: Iterator[pd.DataFrame], most_words: int) -> Iterator[pd.DataFrame]:
    table, kinds, digest = _gear_table(), _kinds(), xxhash.xxh3_128_digest
    for batch in batches:
        uids, ids, parts = [], [], []
        for uid, doc_id, text in batch.itertuples(index=False):
            raw = (text or "").encode()
            if not raw:
                continue
            data = np.frombuffer(raw, np.uint8)
            bounds, words = cuts(data, table, kinds, most_words=most_words)
            if len(words) < 2:
                continue
            ends = bounds.tolist()
            found = np.frombuffer(b"".join([digest(raw[a:b]) for a, b in zip(ends[:-2], ends[2:], strict=True)]), ">i8").astype(np.int64)
            # offsets in characters: bytes that don't continue one
            chars = bounds if raw.isascii() else np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
            uids.append(uid)
            ids.append(doc_id)
            parts.append((len(words) - 1, np.arange(len(words) - 1), chars[:-2], chars[2:] - chars[:-2], words[:-1], words[1:], found[::2], found[1::2]))
        if parts:
            sizes, *columns = zip(*parts, strict=True)
            frame = dict(zip(("no", "start", "length", "words", "next_words", "high", "low"), map(np.concatenate, columns), strict=True))
            yield pd.DataFrame({"uid": np.repeat(np.array(uids), sizes), "doc_id": pd.array(ids, "Int64").repeat(sizes), **frame})


def pair_table(docs: DataFrame, most_words: int = LEAST_WORDS - 1) -> DataFrame:
    """A row for every two neighbouring chunks, the first numbered ``no``, written: where they stand, their words and
    their digest (high, low); ``uid`` numbers the document rows."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(map_slices(rows, partial(_pair_up, most_words=most_words), PAIRS), "pairs")


def repeated_spans(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, uid, span_start, span_end, words, chunks, copies, original) of every chain of repeated pairs of chunks.

    Offsets are characters.  ``copies`` is how often the chain's rarest pair
    occurs; ``original`` says that no pair of it occurs in a document with a
    smaller id.  Every place of a passage is reported, the original too.  ``least_words`` is 2 or more.

    Null, empty texts and texts of a single word: no spans.  Rows equal in
    everything repeat each other whole if long enough.  A null id counts as
    larger than any.  Empty table: empty result.  Other columns are not read.
    """
    pairs = pair_table(docs, least_words - 1)
    # counted before they meet, so a passage that a third of all documents holds is a few rows
    # and written before they join, so that Spark can split the join's hot keys
    repeated = written(pairs.groupBy("high", "low").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id"))
                       .filter("copies > 1"), "repeated")
    hits = pairs.join(repeated, ["high", "low"]).select(
        "uid", "doc_id", "no", "start", "length", "words", "next_words", "copies",
        F.coalesce(F.col("first_id") == F.col("doc_id"), F.col("first_id").isNull()).alias("original"))
    run = F.col("no") - F.row_number().over(Window.partitionBy("uid").orderBy("no"))
    # the last pair brings the chain's last chunk too
    return (hits.withColumn("run", run).groupBy("uid", "run")
            .agg(F.min("doc_id").alias("doc_id"), F.min("start").alias("span_start"), F.max(F.col("start") + F.col("length")).alias("span_end"),
                 (F.sum("words") + F.max_by("next_words", "no")).alias("words"), (F.count("*") + 1).alias("chunks"),
                 F.min("copies").alias("copies"), F.min("original").alias("original"))
            .filter(F.col("words") >= least_words)
            .select("doc_id", "uid", "span_start", "span_end", "words", "chunks", "copies", "original"))


def cut_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The documents, with their columns, without the repeated spans that stand in a document with a smaller id too."""
    rows = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")), "rows")
    flat = rows.select("_row", F.col("_row.doc_id").alias("doc_id"), F.col("_row.text").alias("text"))
    spans = (repeated_spans(flat, least_words).filter("not original")
             .groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("span_start", "span_end"))).alias("spans")))
    numbered = rows.withColumn("uid", F.monotonically_increasing_id()).join(spans, "uid", "left")
    text = F.col("_row.text")
    kept = F.aggregate("spans", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
                       lambda acc, s: F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["span_start"] - acc["at"])).alias("out"),
                                               s["span_end"].alias("at")))
    left = F.concat(kept["out"], F.substring(text, kept["at"] + 1, F.length(text)))
    return numbered.select(*[F.when(F.col("spans").isNull(), text).otherwise(left).alias("text") if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(read_table(spark, sf_dir, "documents")).drop("uid")
