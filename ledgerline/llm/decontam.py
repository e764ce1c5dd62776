"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

An item is in a document if at least `THRESHOLD` (0.8) of the item's distinct word 5-shingles are among the document's (words
without case and ASCII punctuation; an item of fewer words is one shingle of all of them).

Items are partitioned by size (their number of distinct shingles, by powers of two), and each partition has its own sketch size. A
sketch is a bottom-k MinHash: the k shingles with the least hashes. With m shingles, of which at most
m - ceil(0.8 m) may be missing, a document with the item has at least k - (m - ceil(0.8 m)) of any k of them; k is
chosen per partition so that this is at least one for its largest size, plus `EXTRA`. Documents that meet the bound are
candidates, and their shared shingles are then counted exactly, word by word. Banded MinHash signatures, tuned per partition,
would lose items: a 30-word item in a 5,000-word document has a Jaccard similarity of 0.005.
With bottom-k sketches looked up in all of a document's shingles, nothing can be lost.

The items are a query set against all documents, and equal texts are one item for the search. They go to the executors as indexes
of at most about `BLOCK` bytes of item text, each some 12 bytes for a byte of text once it is serialized and about twice that in memory;
one pass over the documents searches `TOGETHER` of them, so that what a task holds doesn't grow with the benchmark. Documents aren't shuffled.

Defined results: null or empty item or document text: nothing shared. Null ids are results like others. Repeated items or documents: a
row for each pair. Empty tables: empty result. Other columns are ignored by `matches` and kept by `clean`.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import folded_words, input_bytes, prepare, stash, unused

SHINGLE = 5
THRESHOLD = 0.8
EXTRA = 4
BLOCK = 4 << 20
TOGETHER = 4

MATCH = StructType([StructField("item", StringType()), StructField("n_shingles", LongType()), StructField("n_shared", LongType())])

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def needed(m: int, threshold: float = THRESHOLD) -> int:
    """The least number of shared shingles of an item that has m."""
    return int(np.ceil(threshold * m - 1e-9))


class Index:
    """Sketches of one block of items, and all their shingles for the verification."""

    def __init__(self, items: list[tuple[str, bytes]], threshold: float = THRESHOLD):
        self.words: dict[bytes, int] = {}
        self.items = items
        self.threshold = threshold
        by_width: dict[int, list] = defaultdict(list)
        self.sizes = [0] * len(items)
        for n, (_, text) in enumerate(items):
            ids = [self.words.setdefault(w, len(self.words)) for w in folded_words(text)]
            width = min(SHINGLE, len(ids))
            if width:
                rows = np.unique(np.lib.stride_tricks.sliding_window_view(np.array(ids, np.uint32), width), axis=0)
                self.sizes[n] = len(rows)
                by_width[width].append((n, rows))
        # The order of shingles is that of a hash of their words, so that it is the same in any block.
        crc = np.zeros(len(self.words), np.uint64)
        for w, i in self.words.items():
            crc[i] = zlib.crc32(w) + 1
        self.widths = []
        for width, found in sorted(by_width.items()):
            sketch, rest = [], []
            for n, rows in found:
                m = len(rows)
                largest = 1 << (m - 1).bit_length()  # of its partition
                k = min(m, largest - needed(largest, threshold) + 1 + EXTRA)
                order = np.argsort(self.hash_of(crc[rows]), kind="stable")
                sketch.append((np.full(k, n), rows[order[:k]]))
                rest.append((np.full(m, n), rows))
            least = {n: max(1, min(self.sizes[n], self._k(n)) - (self.sizes[n] - needed(self.sizes[n], threshold))) for n, _ in found}
            self.widths.append((width, self._table(sketch), self._table(rest), least))

    def _k(self, n: int) -> int:
        largest = 1 << (self.sizes[n] - 1).bit_length()
        return largest - needed(largest, self.threshold) + 1 + EXTRA

    @staticmethod
    def hash_of(rows: np.ndarray) -> np.ndarray:
        """One number of each row's; rows of words or of their numbers."""
        x = np.zeros(len(rows), np.uint64)
        for i in range(rows.shape[1]):
            x = (x ^ (rows[:, i].astype(np.uint64) + np.uint64(1))) * _A
            x ^= x >> np.uint64(29)
        return x * _B

    def _table(self, found: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted hashes of distinct shingles with their words' numbers, and the (shingle, item) pairs."""
        item = np.concatenate([n for n, _ in found])
        rows = np.concatenate([r for _, r in found])
        each, at = np.unique(rows, axis=0, return_inverse=True)
        h = self.hash_of(each)
        order = np.argsort(h, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        pairs = np.stack([place[at.ravel()], item])
        return h[order], each[order], pairs[:, np.argsort(pairs[0], kind="stable")]

    @staticmethod
    def _present(table, rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which of a table's shingles are among the rows, compared word by word."""
        h, each, _ = table
        first = np.searchsorted(h, hashes)
        found = []
        for step in range(1 + int((h[1:] == h[:-1]).any()) * 8):  # equal hashes lie side by side
            at = np.minimum(first + step, len(h) - 1)
            same = (h[at] == hashes) & (each[at] == rows).all(axis=1)
            found.append(at[same])
        return np.unique(np.concatenate(found))

    def search(self, text: bytes | None) -> list[dict]:
        words = folded_words(text)
        number = self.words.get
        ids = np.array([number(w, -1) for w in words], np.int64)
        out = []
        for width, sketch, whole, least in self.widths:
            if len(ids) < width:
                continue
            known = np.cumsum(np.r_[0, ids >= 0])
            at = np.flatnonzero(known[width:] - known[:-width] == width)
            if not len(at):
                continue
            rows = ids[at[:, None] + np.arange(width)].astype(np.uint32)
            hashes = self.hash_of(rows)
            hits = self._count(sketch, self._present(sketch, rows, hashes))
            likely = [n for n, c in hits.items() if c >= least[n]]
            if not likely:
                continue
            exact = self._count(whole, self._present(whole, rows, hashes))
            for n in likely:
                if exact.get(n, 0) >= needed(self.sizes[n], self.threshold):
                    out.append({"item": self.items[n][0], "n_shingles": self.sizes[n], "n_shared": exact[n]})
        return out

    @staticmethod
    def _count(table, present: np.ndarray) -> dict[int, int]:
        pairs = table[2]
        first, last = np.searchsorted(pairs[0], present), np.searchsorted(pairs[0], present, side="right")
        if not len(present):
            return {}
        items = np.concatenate([pairs[1][a:b] for a, b in zip(first, last)])
        n, c = np.unique(items, return_counts=True)
        return dict(zip(n.tolist(), c.tolist()))


def _texts(benchmark: DataFrame) -> DataFrame:
    """item (a digest of the text), text: each distinct text once."""
    return benchmark.select(_digest().alias("item"), "text").filter("text <> ''").dropDuplicates(["item"])


def _digest():
    return F.sha1(F.col("text").cast("binary"))


def indexes(benchmark: DataFrame, threshold: float = THRESHOLD) -> Iterator[Index]:
    """Indexes of all items (item_id, text), one at a time, from one pass over them; the driver holds about BLOCK bytes of text."""
    texts = _texts(benchmark)
    n, size = input_bytes(texts, "text")
    held, taken = [], 0
    for r in texts.repartition(max(1, min(n, -(-size // BLOCK))), "item").sortWithinPartitions("item").toLocalIterator() if n else ():
        held.append((r["item"], r["text"].encode("utf-8", "replace")))
        taken += len(held[-1][1])
        if taken > BLOCK:
            yield Index(held, threshold)
            held, taken = [], 0
    if held:
        yield Index(held, threshold)


def searcher(spark, found: Iterable[Index]):
    """A function of a text column: an array of MATCH, from some indexes."""
    sent = [spark.sparkContext.broadcast(index) for index in found]

    @F.arrow_udf(ArrayType(MATCH))
    def search(text: pa.Array) -> pa.Array:
        kind = pa.list_(pa.struct([("item", pa.string()), ("n_shingles", pa.int64()), ("n_shared", pa.int64())]))
        return pa.array([[m for index in sent for m in index.value.search(t.as_py())] for t in text.cast(pa.binary())], kind)

    return search.asNondeterministic()


def searchers(spark, benchmark: DataFrame, threshold: float) -> Iterator:
    """A searcher for each TOGETHER indexes."""
    every = indexes(benchmark, threshold)
    while some := list(islice(every, TOGETHER)):
        yield searcher(spark, some)


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document and item in it: doc_id, item_id, n_shingles, n_shared, containment."""
    spark = docs.sparkSession
    prepare(spark)
    out = docs.select("doc_id", *(F.lit(None).cast(f.dataType).alias(f.name) for f in MATCH)).limit(0)
    for k, search in enumerate(searchers(spark, benchmark, threshold)):
        found = docs.select("doc_id", search(F.col("text")).alias("m")).filter(F.size("m") > 0).select("doc_id", F.inline("m"))
        out = out.union(found) if k else found
    told = out.join(benchmark.select("item_id", _digest().alias("item")), "item")
    return told.select("doc_id", "item_id", "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that have no item in them, with all their columns. Each pass but the last writes what it keeps."""
    spark = docs.sparkSession
    prepare(spark)
    (m,) = unused(docs, "__m")
    out = docs
    for k, search in enumerate(searchers(spark, benchmark, threshold)):
        left = stash(out, "decontam-clean") if k else out
        out = left.withColumn(m, search(F.col("text"))).filter(F.size(m) == 0).select(*docs.columns)
    return out
