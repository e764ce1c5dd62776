"""Exact substring dedup across documents by bucket-pointer refinement of sampled suffixes.

A byte is removed if a string of `LENGTH` (50) bytes that covers it also starts in a document with a smaller doc_id.

1. Sampling. Of the q-grams (24 bytes) within each 50-byte string, that with the least hash is its anchor; consecutive
   strings share anchors, so that a document has about one per 14 bytes, and equal strings have equal anchors. Anchor
   hashes are dealt to buckets, where those of more than one document are found.
2. Refinement. Only runs of strings whose anchor is shared move on, as short contexts, to their anchor's bucket. There the
   suffixes of the contexts are sorted by bucket-pointer refinement: initial buckets are grams of five to eight bytes; a bucket of several suffixes is
   sorted by the bucket pointers that these have at its depth, and is split where they differ, which adds the pointers' own depth to it.
   Pointers are updated part by part of a pass, so that later parts use what earlier ones have just refined; a bucket of one
   suffix, or one refined to 50 bytes, is left alone. Neighbours in the final order are compared byte by byte: runs of equal strings of
   50 bytes are exact. In each run, all but those of the smallest doc_id are removed.
3. Removed runs return to their documents.

Copies. Before all that, texts meet by their SHA-256: one that a smaller doc_id also has in full goes whole, and isn't sampled, since the
smallest document of a text starts all strings that its copies start. So anchors and contexts are those of different texts.

Anchors and contexts travel as packed binary rows, one per task chunk and bucket. A chunk first settles equal anchors and equal
contexts of its own: only the smallest document of each goes on, so a passage that a third of all documents
share costs one entry per chunk. Where anchors meet, a task holds an entry for each different anchor, not for each chunk.

Hot anchors. Bytes of contexts are summed for each bucket before anything is dealt. A bucket with more than `HEAVY` goes to no task: its
contexts are cut to strings where they lie, which meet in an aggregate with partial minima and a join of stored tables, both of which split a
hot string. So no task holds more than `HEAVY` bytes of contexts, however many documents have a phrase. Within a bucket, an anchor
of more than `GROUP_BYTES` goes the same way.

Defined results: null or empty text: nothing to remove (`dedup` keeps a null). A null doc_id counts as larger than any. Rows with the same doc_id
are one document's and remove nothing of each other; each row is kept. Empty table: empty result. Other columns are
carried along by `dedup` and ignored by `spans`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import prepare, stash, tidy, unused

LENGTH = 50
Q = 24
#: Bytes of text that a task holds at once, and that a bucket of documents and one of anchors is meant for. A partition has
#: `HOMES` buckets of documents, or half as many of anchors, so that hashing them to partitions evens out and fewer files are
#: written: without Hadoop's native library, each file of a `file:` folder makes the executor's JVM start three processes (chmod).
CHUNK = 8 << 20
HOME = 4 << 20
BUCKET = 8 << 20
HOMES = 8
#: Bytes of contexts that are sorted at once, and that one anchor's group may have.
SORT_BYTES = 256 << 10
GROUP_BYTES = 1792 << 10
#: Bytes of contexts that a bucket may bring to one task.
HEAVY = 48 << 20
#: Rows of copies that are broadcast, so that texts stay where they lie; more meet the texts in a shuffled join.
FEW_COPIES = 2_000_000
#: Anchors that meet before a task keeps one entry of each.
MEET = 1 << 20
#: Parts of a refinement pass; each uses the pointers that those before it have updated.
PARTS = 4

NO_ID = (1 << 63) - 1
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A bucket pointer of two."""
    x = a * _M1
    x ^= x >> np.uint64(32)
    x += b
    x *= _M2
    x ^= x >> np.uint64(29)
    return x


def grams(data: np.ndarray, width: int) -> np.ndarray:
    """The `width` (4 or 8) bytes from each position on as one number; the last positions have none."""
    x = data.astype(np.uint64)
    step = 1
    while step < width:
        x = (x[:-step] << np.uint64(8 * step)) | x[step:]
        step *= 2
    return x


#: Texts are hashed together up to about this many bytes, which a processor's cache holds.
TOGETHER = 64 << 10


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of 50-byte strings with one anchor: the text's number, the anchor's hash, the first and the last start in the text."""
    found, group, size = [], [], 0
    for k, text in enumerate(texts):
        group.append(k)
        size += len(text)
        if size > TOGETHER:
            found.append(_runs(texts, group))
            group, size = [], 0
    if group:
        found.append(_runs(texts, group))
    found = [f for f in found if f is not None]
    if not found:
        none = np.empty(0, np.int64)
        return none, np.empty(0, np.uint64), none, none
    return tuple(np.concatenate(x) for x in zip(*found))


def _runs(texts: list[bytes], group: list[int]):
    data = np.frombuffer(b"".join([texts[k] for k in group]), np.uint8)
    n = len(data)
    if n < LENGTH:
        return None
    sizes = np.fromiter((len(texts[k]) for k in group), np.int64, len(group))
    ends = np.cumsum(sizes)
    x = grams(data, 8)
    h = _mix(_mix(x[:-16], x[8:-8]), x[16:])  # Q bytes
    h &= ~np.uint64(63)
    h |= np.arange(len(h), dtype=np.uint64) & np.uint64(63)
    low, width, span = h, LENGTH - Q + 1, 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    count = n - LENGTH + 1
    if span < width:
        low = np.minimum(low[:count], low[width - span : width - span + count])
    inside = np.ones(n, bool)  # strings that end in their own text
    inside[(ends[:, None] - np.arange(1, LENGTH)).clip(0).ravel()] = False
    for k in np.flatnonzero(sizes < LENGTH).tolist():
        inside[ends[k] - sizes[k] : ends[k]] = False
    at = np.flatnonzero(inside[:count])
    if not len(at):
        return None
    low = low[at]
    new = np.flatnonzero(np.concatenate(([True], (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1))))
    first, last = at[new], at[np.concatenate((new[1:] - 1, [len(at) - 1]))]
    owner = np.searchsorted(ends, first, side="right")
    base = (ends - sizes)[owner]
    return np.array(group, np.int64)[owner], low[new] >> np.uint64(6), first - base, last - base


_PLACE = np.uint64((1 << 21) - 1)


def _new(x: np.ndarray) -> np.ndarray:
    """Where a sorted array has another value than before."""
    return np.concatenate(([True], x[1:] != x[:-1]))


def _firsts(new: np.ndarray) -> np.ndarray:
    """For each place of a sorted array the place where its run begins."""
    at = np.flatnonzero(new).astype(np.int32)
    return np.repeat(at, np.diff(at, append=len(new)))


def refine(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class numbers of the suffixes at `starts`, none if there is none: equal numbers, equal 50 bytes.

    text has at most 2^21 bytes, 50 from each start on; behind it, zeros are thought. A bucket's pointer is its first place in
    suffix order, so that pointers compare as the strings do that they stand for.
    """
    n = len(text)
    if not len(starts):
        return np.empty(0, np.int64)
    padded = np.concatenate((text, np.zeros(LENGTH + 8, text.dtype)))
    held = np.flatnonzero(np.bincount(text, minlength=256))
    code = np.zeros(256, np.uint64)
    code[held] = np.arange(1, len(held) + 1)
    bits = len(held).bit_length()
    width = min(8, 42 // bits)  # characters of a first gram: as many as 42 bits hold
    letters = code[padded]
    letters[n:] = 0
    packed = letters[:n].copy()
    for k in range(1, width):
        packed <<= np.uint64(bits)
        packed |= letters[k : n + k]
    packed <<= np.uint64(21)
    packed |= np.arange(n, dtype=np.uint64)
    packed.sort()
    alive = (packed & _PLACE).astype(np.int32)
    new = _new(packed >> np.uint64(21))
    pointer = np.zeros(n + LENGTH + 32, np.int32)  # 0 behind the text; buckets count from 1
    pointer[alive] = _firsts(new) + 1
    depth = np.full(n + 1, width, np.int8)
    depth[0] = LENGTH  # what lies behind the text is all alike
    alive = alive[~new | ~np.concatenate((new[1:], [True]))]
    while len(alive):
        cuts = np.flatnonzero(_new(pointer[alive]))
        cuts = np.unique(cuts[np.linspace(0, len(cuts), PARTS, endpoint=False).astype(np.int64)])
        left = []
        for part in np.split(alive, cuts[1:]):
            own = pointer[part]
            offset = depth[own]
            other = pointer[part + offset]
            packed = own.astype(np.uint64)
            packed <<= np.uint64(22)
            packed |= other.view(np.uint32)
            packed <<= np.uint64(21)
            packed |= np.arange(len(part), dtype=np.uint64)
            packed.sort()
            order = (packed & _PLACE).astype(np.int32)
            packed >>= np.uint64(21)
            new = _new(packed)
            within = _firsts(_new(packed >> np.uint64(22)))
            single = new & np.concatenate((new[1:], [True]))
            part, own = part[order], own[order] + (_firsts(new) - within)
            reached = np.minimum(offset + depth[other], LENGTH).astype(np.int8)[order]  # 2 * LENGTH at most, which 8 bits hold
            pointer[part] = own
            depth[own] = reached
            left.append(part[~single & (reached < LENGTH)])
        alive = np.concatenate(left)
    packed = (pointer[starts].astype(np.uint64) << np.uint64(21)) | np.arange(len(starts), dtype=np.uint64)
    packed.sort()
    order = (packed & _PLACE).astype(np.int32)
    at = starts[order]
    eight = grams(padded, 8)
    new = _new(packed >> np.uint64(21))
    open_ = np.flatnonzero(new[1:]) + 1  # other buckets than their neighbour's: told apart within 50 bytes, or only behind them?
    for k in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        open_ = open_[eight[at[open_] + k] == eight[at[open_ - 1] + k]]
    new[open_] = False
    out = np.empty(len(starts), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def least_of(classes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each member the smallest owner of its class."""
    least = np.full(int(classes.max()) + 1 if len(classes) else 0, NO_ID, np.int64)
    np.minimum.at(least, classes, owner)
    return least[classes]


def _rows(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, schema)], names=[n for n, _ in schema])


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The positions of each bucket that has any, in order."""
    order = np.argsort(bucket, kind="stable")
    held = bucket[order]
    edges = np.r_[np.flatnonzero(np.r_[True, held[1:] != held[:-1]]), len(held)] if len(held) else [0]
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(held[a]), order[a:b]


LOW = np.uint64((1 << 40) - 1)


def _tokens(g: np.ndarray, buckets: int) -> np.ndarray:
    """Anchor hashes cut to a bucket and 40 bits in it; anchors that fall together are only compared in vain."""
    n = np.uint64(buckets)
    return ((g // n) & LOW) * n + g % n


def _planes(x: np.ndarray, width: int) -> np.ndarray:
    """Numbers of `width` bytes, byte by byte, so that what sorted numbers have in common compresses."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).ravel()


def _unplaned(b: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(b) // width, 8), np.uint8)
    out[:, :width] = b.reshape(width, -1).T
    return out.view("<u8").ravel().astype(np.uint64)


def _tell(row: np.ndarray, g: np.ndarray) -> bytes:
    """Anchors of rows, packed."""
    own, local = np.unique(row, return_inverse=True)
    order = np.argsort(g)
    return _pack(own, _planes(local.ravel()[order], 3), _planes(g[order], 8))


def _untell(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    own, local, g = _unpack(blob, np.int64, np.uint8, np.uint8)
    return own[_unplaned(local, 3).astype(np.int64)], _unplaned(g, 8)


PACKED = "kind int, bucket int, blob binary"
_PACKED = [("kind", pa.int32()), ("bucket", pa.int32()), ("blob", pa.binary())]
ASK, TELL = 0, 1  # to an anchor's bucket; to a document's


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays behind their sizes."""
    head = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
    return b"".join([head.tobytes(), *(a.tobytes() for a in arrays)])


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    sizes = np.frombuffer(blob, np.int64, n, 8)
    at, out = 8 + 8 * n, []
    for size, t in zip(sizes.tolist(), types):
        out.append(np.frombuffer(blob, t, size // np.dtype(t).itemsize, at))
        at += size
    return out


def _doc_bucket(row: np.ndarray, n: int) -> np.ndarray:
    return (row.view(np.uint64) % np.uint64(n)).astype(np.int64)


def _anchors(buckets: int, homes: int):
    """(doc_id, row, text) rows: anchors for the buckets, and for the documents those known here to be shared."""

    def flush(ids: list[int], keys: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        doc_id, row = np.array(ids, np.int64), np.array(keys, np.int64)
        by_id = np.lexsort((row, doc_id))
        row = row[by_id]
        d, g, _, _ = runs([texts[i] for i in by_id.tolist()])  # numbered by doc_id
        if not len(d):
            return
        g = _tokens(g, buckets)
        order = np.argsort(g, kind="stable")
        g, d = g[order], d[order]
        fresh = np.r_[True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])]
        g, d = g[fresh], d[fresh]
        first = np.r_[True, g[1:] != g[:-1]]
        out = []
        many = ~first | np.r_[~first[1:], False]
        known, anchor = row[d[many]], g[many]
        for b, at in _split(_doc_bucket(known, homes)):
            out.append((TELL, b, _tell(known[at], anchor[at])))
        g, d = g[first], d[first]
        n = np.uint64(buckets)
        for b, at in _split((g % n).astype(np.int64)):
            own, local = np.unique(d[at], return_inverse=True)
            out.append((ASK, b, _pack(_planes(g[at] // n, 5), row[own], _planes(local.ravel(), 3))))
        yield _rows(_PACKED, out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys, texts, size = [], [], [], 0
        for batch in batches:
            for i, k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                text = t.as_py()
                if text is None or len(text) < LENGTH:
                    continue
                ids.append(i), keys.append(k), texts.append(text)
                size += len(text)
                if size > CHUNK:
                    yield from flush(ids, keys, texts)
                    ids, keys, texts, size = [], [], [], 0
        if ids:
            yield from flush(ids, keys, texts)

    return run


def _blobs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """Rows (bucket, blob)."""
    for batch in batches:
        for b, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            yield b, blob.as_py()


def _by_bucket(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Rows (bucket, blob) sorted by bucket: each bucket's blobs."""
    for bucket, rows in groupby(_blobs(batches), key=lambda r: r[0]):
        yield bucket, [blob for _, blob in rows]


def _shared(buckets: int, homes: int):
    """(key, blob, kind, bucket) rows, sorted by key: anchors of several chunks, for their documents. Rows for documents pass."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ask = pa.compute.equal(batch.column(2), ASK)
                if (told := batch.filter(pa.compute.invert(ask))).num_rows:
                    passed.append(pa.record_batch([told.column(2), told.column(3), told.column(1)], names=["kind", "bucket", "blob"]))
                if (own := batch.filter(ask)).num_rows:
                    yield own.select([3, 1])

        def meet(held: tuple, fresh: list[tuple]) -> tuple[tuple, pa.RecordBatch]:
            """One entry of each anchor (anchor, row, whether its row is told), and what rows are told now."""
            g, row, told = (np.concatenate(x) for x in zip(held, *fresh))
            order = np.argsort(g)
            g, row, told = g[order], row[order], told[order]
            new = _new(g) if len(g) else np.empty(0, bool)
            many = ~new | np.r_[~new[1:], False]
            tell = many & ~told
            out = _rows(_PACKED, [(TELL, b, _tell(row[tell][at], g[tell][at])) for b, at in _split(_doc_bucket(row[tell], homes))])
            return (g[new], row[new], many[new] | told[new]), out

        passed: list[pa.RecordBatch] = []
        none = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool))
        now, held, fresh, count = None, none, [], 0
        for bucket, blob in _blobs(asked()):
            yield from passed
            passed.clear()
            if bucket != now or count > MEET:
                held, out = meet(held, fresh)
                yield out
                fresh, count = [], 0
                if bucket != now:
                    now, held = bucket, none
            low, own, local = _unpack(blob, np.uint8, np.int64, np.uint8)
            g = _unplaned(low, 5) * np.uint64(buckets) + np.uint64(bucket)
            fresh.append((g, own[_unplaned(local, 3).astype(np.int64)], np.zeros(len(g), bool)))
            count += len(g)
        yield meet(held, fresh)[1]
        yield from passed

    return run


SPAN = "kind int, bucket int, blob binary, size long"
_SPAN = [*_PACKED, ("size", pa.int64())]  # size: bytes of contexts
STRING = "kind int, bucket int, blob binary, doc_id long, row long, start long, string binary"
_STRING = [*_PACKED, ("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("string", pa.binary())]


def _merge(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Touching intervals of a row become one."""
    order = np.lexsort((end, start, row))
    row, start, end = row[order], start[order], end[order]
    if not len(row):
        return row, start, end
    group = np.cumsum(np.r_[0, row[1:] != row[:-1]])
    reach = np.maximum.accumulate(end + group * (np.int64(1) << 40)) - group * (np.int64(1) << 40)
    new = np.r_[True, (row[1:] != row[:-1]) | (start[1:] > reach[:-1])]
    at = np.flatnonzero(new)
    return row[at], start[at], np.maximum.reduceat(reach, at)


def _told(row: np.ndarray, start: np.ndarray, end: np.ndarray, homes: int) -> list[tuple]:
    row, start, end = _merge(row, start, end)
    return [(TELL, b, _pack(row[at], start[at], end[at])) for b, at in _split(_doc_bucket(row, homes))]


def _contexts(buckets: int, homes: int):
    """(bucket, kind, blob, doc_id, row, text), sorted: contexts of the runs whose anchors are shared.

    Of equal contexts of a chunk the smallest document's go on, and the others' strings are removed at once.
    """

    def flush(found: dict[bytes, list], ids: list, keys: list) -> Iterator[pa.RecordBatch]:
        gone, sent = [], {}
        for context, rows in found.items():
            if len(rows) > 1:
                low = min(ids[r[0]] for r in rows)
                gone += [(d, s, s + len(context)) for d, _, s in rows if ids[d] > low]
                rows = [r for r in rows if ids[r[0]] == low]
            for d, g, s in rows:
                sent.setdefault(g % buckets, []).append((g, d, s, context))
        out = []
        if gone:
            d, s, e = (np.array(x, np.int64) for x in zip(*gone))
            out += [(*x, None) for x in _told(np.array(keys, np.int64)[d], s, e, homes)]
        for b, rows in sent.items():
            rows.sort(key=lambda r: r[0])  # contexts of an anchor are alike and compress together
            g, d, s, c = zip(*rows)
            own, local = np.unique(np.array(d, np.int64), return_inverse=True)
            low = np.array(g, np.uint64) // np.uint64(buckets)
            table = np.array([(ids[k], keys[k]) for k in own.tolist()], np.int64)
            blob = _pack(
                _planes(low, 5), table, _planes(local.ravel(), 3), np.array(s, np.uint32), np.fromiter(map(len, c), np.uint8, len(c)),
                np.frombuffer(zstandard.compress(b"".join(c), 3), np.uint8),
            )
            out.append((ASK, b, blob, sum(map(len, c))))
        yield _rows(_SPAN, out)

    def take(ids: list, keys: list, texts: list[bytes], shared: np.ndarray, found: dict, at: int) -> int:
        """Add the contexts of these texts' shared anchors; the bytes that they take."""
        d, g, first, last = runs(texts)
        g = _tokens(g, buckets)
        mine = _of_row(np.array(keys[at:], np.int64)[d], g)
        hit = np.flatnonzero(shared[np.minimum(np.searchsorted(shared, mine), len(shared) - 1)] == mine)
        for k, x, s, e in zip(d[hit].tolist(), g[hit].tolist(), first[hit].tolist(), (last[hit] + LENGTH).tolist()):
            found.setdefault(texts[k][s:e], []).append((at + k, x, s))
        return len(hit) * 75

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, told, shared, known = None, [], None, set()
        found: dict[bytes, list] = {}
        ids, keys, size = [], [], 0
        texts: list[bytes] = []
        for batch in batches:
            for b, kind, blob, i, k, t in zip(*(batch.column(c).to_pylist() for c in range(5)), batch.column(5)):
                if b != now:
                    if texts:
                        size += take(ids, keys, texts, shared, found, len(ids) - len(texts))
                    now, told, shared, texts = b, [], None, []
                if kind == 0:
                    told.append(blob)
                    continue
                if shared is None:
                    known, shared = _told_anchors(told)
                if k not in known:
                    continue
                ids.append(i), keys.append(k), texts.append(t.as_py())
            if texts:
                size += take(ids, keys, texts, shared, found, len(ids) - len(texts))
                texts = []
            if size > CHUNK:
                yield from flush(found, ids, keys)
                found, ids, keys, size = {}, [], [], 0
        if found:
            yield from flush(found, ids, keys)

    return run


def _of_row(row: np.ndarray, g: np.ndarray) -> np.ndarray:
    return _mix(row.view(np.uint64), g)


def _told_anchors(blobs: list[bytes]) -> tuple[set[int], np.ndarray]:
    """A document bucket's rows with shared anchors, and those: one number for each row and anchor, sorted."""
    if not blobs:
        return set(), np.empty(0, np.uint64)
    row, g = (np.concatenate(x) for x in zip(*map(_untell, blobs)))
    out = _of_row(row, g)
    out.sort()
    return set(np.unique(row).tolist()), out


def _contexts_of(blob: bytes) -> tuple:
    """Low part of the anchor, doc_id, row, start and size of a blob's contexts, and their text."""
    low, docs, local, start, size, packed = _unpack(blob, np.uint8, np.int64, np.uint8, np.uint32, np.uint8, np.uint8)
    doc_id, row = docs.reshape(-1, 2)[_unplaned(local, 3).astype(np.int64)].T
    text = np.frombuffer(zstandard.decompress(packed.tobytes()), np.uint8)
    return _unplaned(low, 5), doc_id, row, start.astype(np.int64), size.astype(np.int64), text


def _strings_of(doc_id, row, start, offset, size, text: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Each string of some contexts as a row."""
    rows = []
    for d, k, s, o, n in zip(doc_id.tolist(), row.tolist(), start.tolist(), offset.tolist(), size.tolist()):
        data = text[o : o + n].tobytes()
        rows += [(ASK, None, None, d, k, s + p, data[p : p + LENGTH]) for p in range(n - LENGTH + 1)]
        if len(rows) > 20_000:
            yield _rows(_STRING, rows)
            rows = []
    yield _rows(_STRING, rows)


def _strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, blob) rows: their contexts' strings."""
    for _, blob in _blobs(batches):
        _, doc_id, row, start, size, text = _contexts_of(blob)
        yield from _strings_of(doc_id, row, start, np.cumsum(size) - size, size, text)


def _sorted_contexts(homes: int):
    """(bucket, blob) rows: refine the suffixes of each anchor's contexts; the strings to remove, or those of a large anchor."""

    def settle(table, at: np.ndarray) -> tuple:
        """Runs of whole anchors' contexts: (row, start, end) of the strings that a smaller document has."""
        g, doc_id, row, start, offset, size, text = table
        # Of equal contexts only the smallest document's is sorted (the rows are in order of doc_id); all of the others' strings go.
        seen: dict[bytes, int] = {}
        whole = np.zeros(len(at), bool)
        parts = []
        for k, (o, n, i) in enumerate(zip(offset[at].tolist(), size[at].tolist(), doc_id[at].tolist())):
            part = text[o : o + n].tobytes()
            if seen.setdefault(part, i) < i:
                whole[k] = True
            else:
                parts.append(part)
        gone, at = at[whole], at[~whole]
        sizes = size[at]
        joined = np.frombuffer(b"".join(parts), np.uint8)
        base = np.cumsum(sizes) - sizes
        count = sizes - LENGTH + 1
        owner = np.repeat(np.arange(len(at)), count)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        classes = refine(joined, base[owner] + inner)
        ids = doc_id[at][owner]
        lost = least_of(classes, ids) < ids
        s = start[at][owner[lost]] + inner[lost]
        ends = np.concatenate((start[gone] + size[gone], s + LENGTH))
        return np.concatenate((row[gone], row[at][owner[lost]])), np.concatenate((start[gone], s)), ends

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in _by_bucket(batches):
            g, doc_id, row, start, size, text = (np.concatenate(x) for x in zip(*map(_contexts_of, blobs)))
            blobs.clear()
            offset = np.cumsum(size) - size
            order = np.lexsort((doc_id, g))
            table = tuple(x[order] for x in (g, doc_id, row, start, offset, size)) + (text,)
            g, doc_id, row, start, offset, size, _ = table
            edges = np.r_[np.flatnonzero(np.r_[True, g[1:] != g[:-1]]), len(g)]
            several = doc_id[edges[:-1]] != doc_id[edges[1:] - 1]
            total = np.r_[0, np.cumsum(size)]
            large = several & (total[edges[1:]] - total[edges[:-1]] > GROUP_BYTES)
            done, batch, held = [], [], 0
            for a, b in zip(edges[:-1][several & ~large].tolist(), edges[1:][several & ~large].tolist()):
                batch.append(np.arange(a, b))
                held += total[b] - total[a]
                if held > SORT_BYTES:
                    done.append(settle(table, np.concatenate(batch)))
                    batch, held = [], 0
            if batch:
                done.append(settle(table, np.concatenate(batch)))
            if done:
                r, s, e = (np.concatenate(x) for x in zip(*done))
                yield _rows(_STRING, [(*x, None, None, None, None) for x in _told(r, s, e, homes)])
            for a, b in zip(edges[:-1][large].tolist(), edges[1:][large].tolist()):
                yield from _strings_of(doc_id[a:b], row[a:b], start[a:b], offset[a:b], size[a:b], text)

    return run


def _apply(names: list[str], last: list[str], keep_columns: bool):
    """Document rows behind their bucket's removed runs: what is left of each; `last` names what is told of it."""

    def cut(text: bytes, spans) -> tuple[bytes, int, int]:
        if spans is None:
            return text, 0, 0
        _, start, end = _merge(np.zeros(len(spans[0]), np.int64), *spans)
        left, at = [], 0
        for s, e in zip(start.tolist(), end.tolist()):
            left.append(text[at:s])
            at = e
        left.append(text[at:])
        return b"".join(left), int((end - start).sum()), len(start)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, told, spans = None, [], None
        for batch in batches:
            take, texts, removed, count = [], [], [], []
            for at, (b, kind, blob, k, t) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), batch.column(4))):
                if b != now:
                    now, told, spans = b, [], None
                if kind == 0:
                    told.append(blob)
                    continue
                if spans is None:
                    spans = {}
                    if told:
                        row, start, end = (np.concatenate(x) for x in zip(*(_unpack(x, np.int64, np.int64, np.int64) for x in told)))
                        order = np.argsort(row, kind="stable")
                        row, start, end = row[order], start[order], end[order]
                        cutpoints = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
                        spans = dict(zip(row[cutpoints].tolist(), zip(np.split(start, cutpoints[1:]), np.split(end, cutpoints[1:]))))
                raw = t.as_py()
                text, n, m = cut(raw or b"", spans.get(k))
                take.append(at), removed.append(n), count.append(m)
                texts.append(None if raw is None and keep_columns else text)
            if not take:
                continue
            rest = batch.select(names).take(pa.array(take)) if names else None
            columns = [rest.column(i) for i in range(len(names))] if names else []
            if keep_columns:
                columns.append(pa.array([None if x is None else x.decode("utf-8", "ignore") for x in texts], pa.string()))
            else:
                columns += [pa.array([len(x) + n for x, n in zip(texts, removed)], pa.int64())]
            columns += [pa.array(removed, pa.int64()), pa.array(count, pa.int64())]
            if not keep_columns:
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()))
            yield pa.record_batch(columns, names=[*names, *last])

    return run


def _copies(told: DataFrame) -> DataFrame:
    """told: id, row, n, digest. Rows (row, n) whose whole text a smaller id also has. Both sides of the join are plain scans, as for strings."""
    least = stash(told.filter("digest is not null").groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most").drop("most"), "suffix-firsts")
    return told.join(least, "digest").filter("least < id").select("row", "n")


def _as_whole(homes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, n = (batch.column(i).to_numpy() for i in range(2))
            yield _rows(_PACKED, _told(row, np.zeros(len(n), np.int64), n, homes))

    return run


def _removed(docs: DataFrame, row: str, bucket: str) -> tuple[DataFrame, DataFrame, int]:
    """docs: doc_id, text, others. The documents with columns `row` and `bucket`, the removed runs (bucket, blob) and the number of document buckets."""
    prepare(docs.sparkSession)
    key = F.xxhash64("doc_id", "text")
    lean = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), key.alias("row"), "text")
    n = F.octet_length("text").cast("long")
    with tidy() as keep:
        digests = lean.filter("text is not null").select("id", "row", n.alias("n"), F.when(n >= LENGTH, F.unhex(F.sha2("text", 256))).alias("digest"))
        told = stash(digests.hint("rebalance"), "suffix-texts")  # small rows: a file for many input splits
        size = told.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        copies = keep(_copies(told), "suffix-copies").df
    homes, buckets = max(8, size // HOME), max(8, size // BUCKET)
    whole = copies.select("row")
    firsts = lean.join(F.broadcast(whole) if whole.count() <= FEW_COPIES else whole, "row", "left_anti").select("id", "row", "text")
    home = lambda c: F.expr(f"cast(case when `{c}` >= 0 then `{c}` % {homes} else ((`{c}` & 9223372036854775807L) % {homes} + {pow(2, 63, homes)}) % {homes} end as int)")
    with tidy() as keep:
        packed = firsts.mapInArrow(_anchors(buckets, homes), PACKED)
        asked = packed.select((F.col("kind") * 1_000_003 + F.col("bucket")).alias("key"), "blob", "kind", "bucket").repartition(max(8, buckets // (HOMES // 2)), "key").sortWithinPartitions("key")
        shared = stash(asked.mapInArrow(_shared(buckets, homes), PACKED), "suffix-shared")

        side = shared.select("bucket", F.lit(0).alias("kind"), "blob", *(F.lit(None).cast(t).alias(c) for c, t in (("id", "long"), ("row", "long"), ("text", "binary"))))
        text = lean.select(home("row").alias("bucket"), F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("blob"), "id", "row", F.col("text").cast("binary").alias("text")).filter("text is not null")
        both = side.union(text).repartition(max(8, homes // HOMES), "bucket").sortWithinPartitions("bucket", "kind")
        contexts = keep(both.mapInArrow(_contexts(buckets, homes), SPAN), "suffix-contexts").df

    asked = contexts.filter(F.col("kind") == ASK).select("bucket", "blob", "size")
    heavy = stash(asked.groupBy("bucket").agg(F.sum("size").alias("size")).filter(F.col("size") > HEAVY).select("bucket"), "suffix-heavy")
    light, strings = asked.select("bucket", "blob"), []
    if not heavy.isEmpty():
        strings.append(light.join(heavy, "bucket", "left_semi").mapInArrow(_strings, STRING))
        light = light.join(heavy, "bucket", "left_anti")
    dealt = light.repartition(max(8, buckets // (HOMES // 2)), "bucket").sortWithinPartitions("bucket")
    settled = stash(dealt.mapInArrow(_sorted_contexts(homes), STRING), "suffix-settled")
    spans = contexts.filter(F.col("kind") == TELL).select("bucket", "blob").union(settled.filter(F.col("kind") == TELL).select("bucket", "blob"))
    spans = spans.union(copies.mapInArrow(_as_whole(homes), PACKED).select("bucket", "blob"))

    large = settled.filter(F.col("kind") == ASK)
    if not large.isEmpty():
        strings.append(large)
    for each in strings:
        spans = spans.union(_settled_strings(each.select("doc_id", "row", "start", "string"), homes))
    return docs.withColumn(row, key).withColumn(bucket, home(row)), spans, homes


def _settled_strings(each: DataFrame, homes: int) -> DataFrame:
    """Strings one by one: the runs (bucket, blob) to remove. Both sides of the join are plain scans, so that a hot string's task can be split."""
    with tidy() as keep:
        rows = stash(each, "suffix-strings")
        least = stash(rows.groupBy("string").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").drop("most"), "suffix-least")
        lost = rows.join(least, "string").filter("least < doc_id").select("row", "start")
        return keep(lost.mapInArrow(_as_spans(homes), PACKED), "suffix-large").df.select("bucket", "blob")


def _as_spans(homes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start = (batch.column(i).to_numpy() for i in range(2))
            yield _rows(_PACKED, _told(row, start, start + LENGTH, homes))

    return run


def _joined(told: DataFrame, spans: DataFrame, homes: int, row: str, bucket: str, names: list[str]) -> DataFrame:
    """Documents and spans of each bucket in one partition, spans first: bucket, kind, blob, row, text and the named columns."""
    kind, blob, text = unused(told, "__kind", "__blob", "__text")
    fields = {f.name: f.dataType for f in told.schema}
    docs = told.select(F.col(bucket), F.lit(1).alias(kind), F.lit(None).cast("binary").alias(blob), row, F.col("text").cast("binary").alias(text), *names)
    side = spans.select(F.col("bucket").alias(bucket), F.lit(0).alias(kind), F.col("blob").alias(blob), F.lit(None).cast("long").alias(row), F.lit(None).cast("binary").alias(text), *(F.lit(None).cast(fields[c]).alias(c) for c in names))
    return side.union(docs).repartition(max(8, homes // HOMES), bucket).sortWithinPartitions(bucket, kind)


def spans(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text. Each row's doc_id, n_bytes, n_removed, n_spans and the SHA-256 of what is left."""
    told, removed, homes = _removed(docs.select("doc_id", "text"), "row", "bucket")
    last = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    schema = "doc_id long, " + ", ".join(f"{n} {t}" for n, t in last.items())
    return _joined(told, removed, homes, "row", "bucket", ["doc_id"]).mapInArrow(_apply(["doc_id"], list(last), False), schema)


def dedup(docs: DataFrame) -> DataFrame:
    """All columns of docs, with the text that is left; a character that is cut apart goes. Rows that lose all of a text go."""
    others = [c for c in docs.columns if c != "text"]
    row, bucket, kept, n_removed, n_spans = unused(docs, "__row", "__bucket", "__kept", "__n_removed", "__n_spans")
    told, removed, homes = _removed(docs, row, bucket)
    schema = StructType([f for f in docs.schema if f.name != "text"]).add(kept, "string").add(n_removed, "long").add(n_spans, "long")
    cut = _joined(told, removed, homes, row, bucket, others).mapInArrow(_apply(others, [kept, n_removed, n_spans], True), schema)
    left = cut.filter((F.col(kept) != "") | (F.col(n_removed) == 0))
    return left.select(*(F.col(kept).alias(c) if c == "text" else F.col(c) for c in docs.columns))
