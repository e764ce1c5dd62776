"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprints have 64 bits; two of them link at `DISTANCE` (3) or fewer differing bits; documents of a connected
component form a group.

Search. Pigeonhole: of four 16-bit segments one has no error, and of the two 24-bit halves of the other 48 bits one has
at most one. 23 bits of that half are decoded by the perfect binary Golay code (23, 12): each vector lies within 3 of
exactly one codeword, whose index has 12 bits. A fingerprint is filed under its own codeword's index and asked for under
those of all vectors within one bit, which are 1 or 6 indices, so that two halves within one bit always share a key. Key: segment,
half, the segment's bits, the index. Rows of a key meet in one sorted stream, where distances are verified and only a
spanning forest of the verified links is given out, never all pairs. A key with more than `LARGE` fingerprints is not
compared: its rows are dealt again under finer keys (the same pigeonhole over another order of the bits), until none is. A level of these
makes four rows of each row of such a key, and cuts a key of unrelated fingerprints to 1 / 65536 of them.

Equal fingerprints are one row before the search, so that copies cost nothing however many there are.

Defined results: null or empty text, or one without words: fingerprint 0, linked like any other. A null doc_id
counts for no component's smallest id (null if it has no other). Repeated rows each stay. Empty table: empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import prepare, stash, tidy, unused
from .components import components

DISTANCE = 3
SHINGLE = 3
LARGE = 4096

#: Fixed value: generator polynomial of the binary Golay code (23, 12).
GOLAY = 0xC75


def fingerprint(text: bytes | None) -> int:
    """Unsigned 64-bit SimHash of the XXH64 (seed 42) of the word 3-shingles, A-Z lower-cased; a bit is set if it is in over half."""
    from xxhash import xxh64_intdigest as h

    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return 0
    whole = b" ".join(words)
    if n <= SHINGLE:
        return h(whole, 42)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes) + np.arange(n)
    first, last = (ends - sizes)[: n - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist()
    hashes = np.fromiter([h(whole[a:b], 42) for a, b in zip(first, last)], np.uint64, len(first))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


@F.arrow_udf(LongType())
def fingerprints(text: pa.Array) -> pa.Array:
    found = np.fromiter((fingerprint(t.as_py()) for t in text.cast(pa.binary())), np.uint64, len(text))
    return pa.array(found.view(np.int64))


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@lru_cache(1)
def _leaders() -> np.ndarray:
    """The error pattern of each of the code's 2048 syndromes; all have 3 bits or fewer."""
    bits = [0, *(1 << i for i in range(23))]
    patterns = np.array(sorted({a | b | c for a in bits for b in bits for c in bits}), np.uint32)
    out = np.zeros(2048, np.uint32)
    out[_syndrome(patterns)] = patterns
    return out


def _syndrome(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint32)
    for bit in range(22, 10, -1):
        x = x ^ (((x >> np.uint32(bit)) & np.uint32(1)) * np.uint32(GOLAY << (bit - 11)))
    return x


def codeword_index(x: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit vector."""
    return (x ^ _leaders()[_syndrome(x)]) >> np.uint32(11)


def _first_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys times 2, plus 1 where the fingerprint is filed rather than asked for; and the fingerprints."""
    keys, owners = [], []
    for s in range(4):
        exact = (fp >> np.uint64(16 * s)) & np.uint64(0xFFFF)
        low = fp & np.uint64((1 << (16 * s)) - 1)
        rest = low | ((fp >> np.uint64(16 * s + 16)) << np.uint64(16 * s)) if s < 3 else low
        for half in range(2):
            part = ((rest >> np.uint64(24 * half)) & np.uint64(0x7FFFFF)).astype(np.uint32)
            own = codeword_index(part)
            near = np.stack([own, *(codeword_index(part ^ np.uint32(1 << i)) for i in range(23))], axis=1)
            near.sort(axis=1)
            new = np.ones(near.shape, bool)
            new[:, 1:] = near[:, 1:] != near[:, :-1]
            at, _ = np.nonzero(new)
            index = near[new]
            base = (np.uint64(s * 2 + half) << np.uint64(28)) | (exact[at] << np.uint64(12)) | index
            keys.append((base << np.uint64(1)) | (index == own[at]))
            owners.append(fp[at])
    return np.concatenate(keys), np.concatenate(owners)


def _finer_keys(key: np.ndarray, fp: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Four keys each: the old key with one of four 16-bit segments over another order of the bits."""
    order = np.random.default_rng(level).permutation(64)
    mixed = np.zeros(len(fp), np.uint64)
    for to, at in enumerate(order):
        mixed |= ((fp >> np.uint64(at)) & np.uint64(1)) << np.uint64(to)
    keys = []
    for s in range(4):
        x = (key >> np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + ((mixed >> np.uint64(16 * s)) & np.uint64(0xFFFF)) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(s + 1)
        x ^= x >> np.uint64(29)
        keys.append((x * np.uint64(0x165667B19E3779F9)) | np.uint64(1))
    return np.concatenate(keys), np.tile(fp, 4)


KEYED = "k long, fp long"
FOUND = "a long, b long, k long"


def _keyed(level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(batch.num_columns)]
            k, fp = _finer_keys(*columns, level) if level else _first_keys(*columns)
            yield pa.record_batch([pa.array(k.view(np.int64)), pa.array(fp.view(np.int64))], names=["k", "fp"])

    return run


def spanning_links(fp: np.ndarray) -> tuple[list, list]:
    """Links at DISTANCE or less that connect just what all such links would: each fingerprint is reached once."""
    rest = np.unique(fp)
    a, b = [], []
    while len(rest) > 1:
        front = [rest[0]]
        rest = rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= DISTANCE
            if near.any():
                found = rest[near]
                a += [x] * len(found)
                b += found.tolist()
                front += list(found)
                rest = rest[~near]
    return a, b


def _meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of `k` and `fp`: links of each key's rows, or the rows themselves (with `k`) where they're too many."""

    def out(a, b, k):
        a, b, k = (np.asarray(x, np.uint64).view(np.int64) for x in (a, b, k))
        links = pa.record_batch([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], names=["a", "b", "k"])
        return links if not len(k) else pa.record_batch([pa.array(b), pa.nulls(len(b), pa.int64()), pa.array(k)], names=["a", "b", "k"])

    held_k, held_fp, over = np.empty(0, np.uint64), np.empty(0, np.uint64), None
    for batch in _chain_end(batches):
        if batch is not None:
            k = np.concatenate([held_k, batch.column(0).to_numpy().view(np.uint64)])
            fp = np.concatenate([held_fp, batch.column(1).to_numpy().view(np.uint64)])
        else:
            k, fp = held_k, held_fp
        if not len(k):
            continue
        key = k >> np.uint64(1)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[starts[1:], len(k)]
        if batch is not None:  # the last key may go on
            held_k, held_fp = k[starts[-1] :], fp[starts[-1] :]
            starts, ends = starts[:-1], ends[:-1]
        sizes = ends - starts
        if over is not None and len(starts):
            if key[starts[0]] == over:
                yield out([], fp[: ends[0]], k[: ends[0]])
                starts, ends, sizes = starts[1:], ends[1:], sizes[1:]
            over = None if len(starts) or batch is None or held_k[0] >> np.uint64(1) != over else over
        a, b = [], []
        pair = starts[sizes == 2]
        near = pair[(np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= DISTANCE) & (fp[pair] != fp[pair + 1])]
        if len(near):
            a, b = fp[near].tolist(), fp[near + 1].tolist()
        filed = np.cumsum(np.r_[0, k & np.uint64(1)])
        for s, e in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
            if filed[e] == filed[s]:
                continue
            if e - s > LARGE:
                yield out([], fp[s:e], k[s:e])
                continue
            x, y = spanning_links(fp[s:e])
            a += x
            b += y
        if a:
            yield out(a, b, [])
        if batch is not None and len(held_k) > LARGE:  # memory stays bounded: what is held of a large key goes out
            over = held_k[0] >> np.uint64(1)
            yield out([], held_fp, held_k)
            held_k, held_fp = held_k[:0], held_fp[:0]


def _chain_end(batches):
    yield from batches
    yield None


def links(distinct: DataFrame) -> DataFrame:
    """distinct: fp. Links (a, b) that connect all fingerprints within DISTANCE."""
    found = []
    rows, level = distinct.mapInArrow(_keyed(0), KEYED), 0
    while True:
        dealt = rows.repartition(F.shiftrightunsigned("k", 1)).sortWithinPartitions("k")
        met = stash(dealt.mapInArrow(_meet, FOUND), "simhash-links")
        found.append(met.filter("k is null").select("a", "b"))
        large = met.filter("k is not null").select("k", F.col("a").alias("fp")).distinct()
        if large.isEmpty():
            break
        level += 1
        rows = large.mapInArrow(_keyed(level), KEYED)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def groups(marked: DataFrame) -> DataFrame:
    """marked: doc_id, fp. Each distinct fp with its component: fp, root (one fp of it, which tells components apart) and component_id, its smallest doc_id."""
    with tidy() as keep:
        each = stash(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
        roots = components(links(each.select("fp")))
        rooted = each.join(roots, each["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
        rooted = stash(rooted, "simhash-roots")
        least = stash(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")  # a plain scan, so that a large group's join can be split
        return keep(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-groups").df


def near_duplicates(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. Each row's doc_id, fingerprint (hex) and component_id."""
    prepare(docs.sparkSession)
    marked = stash(docs.select("doc_id", fingerprints("text").alias("fp")), "simhash-fingerprints")
    return marked.join(groups(marked), "fp").select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents of the smallest doc_id of each group, one of each, with all their columns."""
    prepare(docs.sparkSession)
    mark = lambda: F.xxhash64("text")  # noqa: E731  # tells the rows of a doc_id apart, so that fingerprints are made once
    marked = stash(docs.select("doc_id", mark().alias("h"), fingerprints("text").alias("fp")), "simhash-fingerprints")
    group = groups(marked)
    # Of each group the rows with its smallest id: one (id, text) of them, and how many rows bear it. Groups may share an id or have none.
    rows = marked.groupBy("doc_id", "h", "fp").agg(F.count(F.lit(1)).alias("n")).join(group, "fp")
    first = rows.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id").agg(F.min(F.struct("fp", "h", "n")).alias("x"))
    i, h, n = unused(docs, "__id", "__h", "__n")
    first = stash(first.select(F.col("doc_id").alias(i), F.col("x.h").alias(h), F.col("x.n").alias(n)), "simhash-first")
    kept = docs.join(first, (mark() == F.col(h)) & F.col("doc_id").eqNullSafe(F.col(i)))
    one = kept.filter(F.col(n) == 1).select(*docs.columns)
    if first.filter(F.col(n) > 1).isEmpty():
        return one
    return one.union(kept.filter(F.col(n) > 1).dropDuplicates([i, h]).select(*docs.columns))
