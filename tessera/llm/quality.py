"""Quality classifier: naive Bayes support vectors.

A text is a set of hashed n-grams: its words, and runs of one to three word
shapes (letters by case, digits, the punctuation kept, and whether a word
repeats the one before).  Every indicator is scaled by its class log-count
ratio, rows are scaled to length one, and a linear hinge-loss model is fitted
by dual coordinate descent.  A sigmoid fitted on rows kept back from the
descent turns margins into scores.

The fit reads a bounded sample of labelled rows (``FIT_ROWS``); scoring reads
every whole text, with a model of fixed size.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import SLICE_ROWS, map_slices, read_table, ship_by_value, written

ship_by_value(__name__)

#: At most so many labelled rows are learned from: those with the smallest hash of their id.
FIT_ROWS = 10_000
#: Hash buckets of n-grams; a model is two arrays of this size.
BUCKETS = 1 << 18
EPOCHS = 12
PENALTY = 1.0
#: Weight of the support vectors against their mean, which stands for plain naive Bayes.
MIX = 0.75
SMOOTHING = 1.0
THRESHOLD = 0.3
FOLDS = 5
_CACHE = 100_000

MODEL = "weights binary, scale binary, bias double, slope double, shift double"
SCORED = "doc_id long, score double"


class _Words(dict):
    """Of a word: the hashes of the word and of its shape.  Refilled when it has grown large."""

    def __missing__(self, word: str) -> tuple[int, int]:
        if len(self) >= _CACHE:
            self.clear()
        shape = re.sub(r"[^\W\d_A-ZÀ-ÖØ-Þ]+", "x", word)
        shape = re.sub(r"[A-ZÀ-ÖØ-Þ]{2,}", "XX", re.sub(r"\d+", "0", shape))
        self[word] = pair = (zlib.crc32(word.lower().encode()), zlib.crc32(re.sub(r"([^xX0])\1{3,}", r"\1\1\1\1", shape).encode()))
        return pair


def features(text: str | None, words: dict) -> np.ndarray:
    """The distinct buckets of a text's n-grams; none for a null text or one without words."""
    found = (text or "").split()
    if not found:
        return np.empty(0, np.int32)
    pairs = np.array([words[w] for w in found], dtype=np.uint64)
    own, shape = pairs[:, 0], pairs[:, 1]
    same = np.zeros(len(own), np.uint64)
    same[1:] = own[1:] == own[:-1]
    shape = shape * np.uint64(2) + same
    grams = [own * np.uint64(0x9E3779B97F4A7C15)]
    run = np.zeros(len(own), np.uint64)
    for n in range(1, min(3, len(own)) + 1):
        run = run[: len(own) - n + 1] * np.uint64(0x100000001B3) + shape[n - 1:] + np.uint64(n)
        grams.append(run * np.uint64(0xC2B2AE3D27D4EB4F))
    hashed = np.concatenate(grams)
    return np.unique((hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def _featurize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    words = _Words()
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"],
                            "grams": [features(t, words).tobytes() for t in batch["text"]]})


def descend(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, penalty: float = PENALTY) -> tuple[np.ndarray, np.ndarray, float]:
    """(weights, scale, bias) of the hinge-loss model over log-count-ratio scaled indicators.

    Solves the dual one row at a time: a row's multiplier moves to the
    minimum of its own quadratic, clipped to [0, penalty]; the rarer class
    gets a penalty larger by the ratio of the class sizes.
    """
    good, bad = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for ids, y in zip(rows, labels, strict=True):
        (good if y > 0 else bad)[ids] += 1
    scale = np.log(good / good.sum()) - np.log(bad / bad.sum())
    weights, bias = np.zeros(BUCKETS), 0.0
    sizes = {1: (labels > 0).sum(), -1: (labels < 0).sum()}
    limit = {y: penalty * max(1.0, sizes[-y] / max(1, sizes[y])) for y in (1, -1)}
    held = np.zeros(len(rows))
    values = [scale[ids] / max(1e-9, float(np.sqrt((scale[ids] ** 2).sum()))) for ids in rows]
    square = np.array([float((v ** 2).sum()) + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y = int(labels[i])
            slope = y * (float(weights[rows[i]] @ values[i]) + bias) - 1
            moved = min(max(held[i] - slope / square[i], 0.0), limit[y])
            if moved != held[i]:
                step = (moved - held[i]) * y
                weights[rows[i]] += step * values[i]
                bias += step
                held[i] = moved
    # interpolation with the mean magnitude keeps n-grams that few rows hold from ruling
    return (1 - MIX) * np.abs(weights).mean() + MIX * weights, scale, MIX * bias


def margin(ids: np.ndarray, weights: np.ndarray, scale: np.ndarray, bias: float) -> float:
    if not len(ids):
        return bias
    values = scale[ids]
    return float(weights[ids] @ values) / max(1e-9, float(np.sqrt((values ** 2).sum()))) + bias


def sigmoid_fit(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (at least 0) and shift of the sigmoid of greatest likelihood, by Newton steps on smoothed targets."""
    up, down = (labels > 0).sum(), (labels < 0).sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    slope, shift = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -35, 35)))
        w = p * (1 - p) + 1e-6
        gradient = np.array([((p - target) * margins).sum() + 1e-3 * (slope - 1), (p - target).sum() + 1e-3 * shift])
        hessian = np.array([[(w * margins ** 2).sum() + 1e-3, (w * margins).sum()], [(w * margins).sum(), w.sum() + 1e-3]])
        move = np.linalg.solve(hessian, gradient)
        move *= min(1.0, 5.0 / max(1e-12, float(np.abs(move).max())))
        slope, shift = max(0.0, slope - move[0]), shift - move[1]
    return float(slope), float(shift)


def _fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    frames = list(batches)  # at most FIT_ROWS rows of hashed n-grams
    sample = pd.concat(frames).sort_values("doc_id") if frames else pd.DataFrame({"label": [], "grams": []})
    rows = [np.frombuffer(g, np.int32) for g in sample["grams"]]
    labels = np.where(sample["label"].to_numpy(dtype=float) > 0, 1, -1)
    weights, scale, bias, slope, shift = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, 4.0 * (labels.sum() >= 0) - 2.0
    if len(set(labels)) == 2 and min((labels > 0).sum(), (labels < 0).sum()) >= 2:
        back = np.zeros(len(rows), bool)
        for y in (1, -1):  # every fifth row of each class calibrates
            back[np.flatnonzero(labels == y)[::5]] = True
        weights, scale, bias = descend([r for r, b in zip(rows, back, strict=True) if not b], labels[~back])
        slope, shift = sigmoid_fit(np.array([margin(r, weights, scale, bias) for r, b in zip(rows, back, strict=True) if b]), labels[back])
    yield pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "scale": [scale.astype(np.float32).tobytes()],
                        "bias": [bias], "slope": [slope], "shift": [shift]})


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned: CRC-32 of its id as text is divisible by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row: the model fitted on at most ``fit_rows`` labelled documents outside the held-out fold.

    A document labelled both ways isn't learned from; of rows with one id the
    smallest text is.  Without rows of both classes every score is the same.
    """
    known = (labels.filter("doc_id is not null and quality is not null").filter(~held_out(F.col("doc_id")))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
             .filter("low = high").select("doc_id", F.col("low").cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most fit_rows pairs of numbers are broadcast
    sample = (texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    grams = map_slices(sample, _featurize, "doc_id long, label int, grams binary")
    return written(grams.repartition(1).mapInPandas(_fit, MODEL), "model")


def _scores(shared, texts: pd.Series, words: dict) -> np.ndarray:
    weights, scale, bias, slope, shift = shared.value
    weights, scale = np.frombuffer(weights, np.float32), np.frombuffer(scale, np.float32)
    margins = np.array([margin(features(t, words), weights, scale, bias) for t in texts], dtype=float)
    return 1 / (1 + np.exp(-np.clip(slope * margins + shift, -35, 35)))


def _shared(docs: DataFrame, model: DataFrame):
    """The model as a broadcast of a few MB, whatever the corpus."""
    return docs.sparkSession.sparkContext.broadcast(tuple(bytes(x) if isinstance(x, (bytes, bytearray)) else x for x in model.first()))


def score_quality(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, score) of every document.

    Null or empty text: scored by the bias alone.  Repeated rows and ids: each
    row is scored.  Empty table: empty result.  No column but the text enters.
    """
    shared = _shared(docs, model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = _Words()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": _scores(shared, batch["text"], words)})

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, SCORED)


def predict_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score_quality(docs, fit_quality(docs, labels, fit_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents that the classifier doesn't reject, with their columns."""
    shared = _shared(docs, fit_quality(docs, labels, fit_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(i, SLICE_ROWS)
                yield rows.filter(pa.array(_scores(shared, rows.column("text").to_pylist(), words) >= THRESHOLD, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
