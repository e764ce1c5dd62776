"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are presence of a document's words, word pairs and pairs with one word between them (A-Z lower-cased, ASCII
punctuation aside), hashed to `DIMENSIONS`. FTRL-proximal keeps a learning rate per coordinate and sets coordinates without
enough evidence to exactly zero (L1), so that the fitted weights are a short list of (coordinate, weight), which is
broadcast: at most DIMENSIONS entries whatever the corpus.

The fit sees at most `TRAIN_DOCS` labelled documents, those with the smallest hash of their id, and none that is held out. Each comes
as its distinct coordinates, and one with more than `MOST_COORDINATES` isn't learned from; so the one task that fits holds at most
TRAIN_DOCS * MOST_COORDINATES numbers of 4 bytes (768 MB; 25 MB on the 0.1 tables). All documents are then scored, whole.

Defined results: null or empty text: the bias alone. Documents with several label rows: toxic if any says so; of several
rows with one doc_id the smallest text is learned from; null labels: not learned from. No label at all: score 0.5 for every text. A null doc_id is not held out and has no label. Repeated rows: each its own.
Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import folded_words, held_out, prepare

DIMENSIONS = 1 << 20
TRAIN_DOCS = 12_000
MOST_COORDINATES = 16_000
EPOCHS = 4
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.0

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_CACHE_LIMIT = 400_000


class WordHash(dict):
    """A word's 64-bit hash, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        h = ((zlib.crc32(word) << 32) | zlib.crc32(word, 0x5BD1E995)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        if len(self) < _CACHE_LIMIT:
            self[word] = h
        return h


def _fold(x: np.ndarray) -> np.ndarray:
    return ((x * _B) >> np.uint64(44)).astype(np.int64)


def coordinates(text: bytes | None, hashes: WordHash) -> np.ndarray:
    """The features' coordinates, with repeats: words, neighbours, and pairs around one word."""
    words = folded_words(text)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return np.concatenate([_fold(h), _fold(h[:-1] * _A + h[1:]), _fold((h[:-2] ^ _B) * _A + h[2:])])


def ftrl(examples: list[np.ndarray], labels: list[int], dimensions: int = DIMENSIONS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights; the last one is the bias. examples: distinct coordinates each, in the order of learning."""
    z, n = np.zeros(dimensions + 1), np.zeros(dimensions + 1)
    l1 = np.full(dimensions + 1, L1)
    l1[-1] = 0

    def weights(at: np.ndarray) -> np.ndarray:
        part = z[at]
        return np.where(np.abs(part) <= l1[at], 0.0, -(part - np.sign(part) * l1[at]) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(epochs):
        for x, y in zip(examples, labels):
            at = np.append(x, dimensions)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(dimensions + 1))


def _featurize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHash()
    for batch in batches:
        rows = [np.unique(coordinates(t.as_py(), hashes)).astype(np.int32) for t in batch.column(2).cast(pa.binary())]
        take = [i for i, x in enumerate(rows) if len(x) <= MOST_COORDINATES]
        yield pa.record_batch([batch.column(0).take(pa.array(take, pa.int64())), batch.column(1).take(pa.array(take, pa.int64())), pa.array([rows[i].tobytes() for i in take], pa.binary())], names=["h", "y", "x"])


def _train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows += [(h, x.as_py(), y) for h, y, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2))]
    rows.sort(key=lambda r: r[0])
    w = ftrl([np.frombuffer(x, np.int32) for _, x, _ in rows], [y for _, _, y in rows]) if rows else np.zeros(DIMENSIONS + 1)
    at = np.flatnonzero(w)
    yield pa.record_batch([pa.array(at, pa.int64()), pa.array(w[at], pa.float64())], names=["at", "weight"])


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_DOCS) -> list[tuple[int, float]]:
    """docs: doc_id, text; labels: doc_id, toxic. The weights that aren't zero."""
    prepare(docs.sparkSession)
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("_y")).withColumn("_h", F.xxhash64(F.lit("toxicity"), F.col("doc_id")))
    chosen = one.orderBy("_h", "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `most` rows of three numbers
    each = texts.groupBy("_h", "doc_id").agg(F.max("_y").cast("int").alias("_y"), F.min("text").alias("text"))
    ready = each.select("_h", "_y", "text").mapInArrow(_featurize, "h long, y int, x binary")
    rows = ready.repartition(1).mapInArrow(_train, "at long, weight double").collect()
    return [(r["at"], r["weight"]) for r in rows]


def scorer(spark, weights: list[tuple[int, float]]):
    """A function of a text column: its score."""
    at, w = np.array([a for a, _ in weights], np.int64), np.array([x for _, x in weights])
    sent = spark.sparkContext.broadcast((at, w))
    state: dict[str, object] = {}

    @F.arrow_udf(DoubleType())
    def score(text: pa.Array) -> pa.Array:
        if not state:
            dense = np.zeros(DIMENSIONS + 1, np.float32)
            dense[sent.value[0]] = sent.value[1]
            state.update(dense=dense, hashes=WordHash())
        dense, out = state["dense"], []
        for t in text.cast(pa.binary()):
            x = coordinates(t.as_py(), state["hashes"])
            hit = np.unique(x[dense[x] != 0])
            out.append(1 / (1 + np.exp(-np.clip(float(dense[hit].astype(np.float64).sum() + dense[-1]), -30, 30))))
        return pa.array(out, pa.float64())

    return score


def predict(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Each row's doc_id, held_out, score and predicted."""
    weights = fit(docs, labels)
    score = scorer(docs.sparkSession, weights).asNondeterministic()
    told = docs.select("doc_id", score(F.col("text")).alias("score"))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
