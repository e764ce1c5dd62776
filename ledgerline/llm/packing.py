"""Best-fit packing of tokenized documents into fixed-length sequences by large-item matching.

A document is its token ids and an end id. Only a document longer than a sequence is cut, into full pieces and a
rest. Of the pieces above a third of the capacity at most two fit in one sequence, so they are matched greedily:
from the longest down, each takes the longest that still fits beside it. All other pieces, longest first, go to the
sequence with the smallest gap that holds them, or open one.

Pieces are numbered through all partitions and dealt by turns to shards of at most `SHARD` pieces, each packed alone: a shard has
one sequence with room to spare, so that shards of this size cost nearly nothing, and no task grows with the input.

Any tokenizer file serves. One with the settings in `KNOWN` is encoded by chunks that are remembered; any other encodes whole texts.

Defined results: null text: empty, hence the end id alone. Ties: any of equal lengths, repeatably. Repeated rows and
null ids are packed as rows of their own. Empty table: no pieces. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, stash

CAPACITY = 4096
END_ID = 1
SHARD = 65_536

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"

#: The normalizer and splitter that chunks rely on.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None, "truncation": None, "padding": None,
}

#: Texts of these characters alone are split here; others go to the tokenizer as they are.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PART = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_CACHE_LIMIT = 400_000


class ChunkEncoder(dict):
    """Ids of white-space-free chunks, as little-endian 32-bit bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its chunks in order; within a
    chunk of common letters, those of its lower-cased letter runs, digits and symbol runs. Both are remembered.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        marks = [t["content"].startswith("<|") and not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in told.get("added_tokens", [])]
        self.chunked = all(told.get(k) == v for k, v in KNOWN.items()) and told["model"].get("type") == "BPE" and all(marks)
        self.model = self.tokenizer.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.byte_form = {c: spell(chr(c))[0][0] for c in (*range(33, 127), *range(192, 256))}
        self.parts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def part(self, text: str) -> bytes:
        """A part needs neither normalizer nor splitter, so its byte-level form goes to the model at once."""
        return b"".join(x.id.to_bytes(4, "little") for x in self.model.tokenize(text.translate(self.byte_form)))

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if "<|" not in text and _SIMPLE.fullmatch(text):
            found = []
            for part in _PART.findall(text.lower()):
                ids = self.parts.get(part)
                if ids is None:
                    ids = self.part(part)
                    if len(self.parts) < _CACHE_LIMIT:
                        self.parts[part] = ids
                found.append(ids)
            out = b"".join(found)
        else:
            out = self.whole(text)
        if len(self) < _CACHE_LIMIT:
            self[chunk] = out
        return out

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.__getitem__, text.encode("utf-8", "replace").split())) if self.chunked else self.whole(text)


def _cut(tokenizer: str, capacity: int, end_id: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """docs: doc_id, text. A row per piece, with the CRC-32 of its ids as little-endian 32-bit words."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(_cut(tokenizer, capacity, end_id), PIECES)


def pack_lengths(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """For each length, its sequence (from 0) and its offset there.

    Gaps are integers up to the capacity, so open sequences are kept by gap, and a bit mask of the gaps in use gives the
    smallest that holds a piece at once.
    """
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    sequence, offset = [0] * len(lengths), [0] * len(lengths)
    n = 0
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0

    large = [i for i in order if 3 * lengths[i] > capacity]
    waiting: dict[int, list[int]] = {}
    held = 0  # bit L: a large piece of length L is unmatched
    for i in reversed(large):
        waiting.setdefault(lengths[i], []).append(i)
        held |= 1 << lengths[i]

    def take(length: int) -> int:
        nonlocal held
        i = waiting[length].pop()
        if not waiting[length]:
            held &= ~(1 << length)
        return i

    while held:
        first = take(held.bit_length() - 1)
        used = lengths[first]
        sequence[first] = n
        fits = held & ((1 << (capacity - used + 1)) - 1)
        if fits:
            second = take(fits.bit_length() - 1)
            sequence[second], offset[second] = n, used
            used += lengths[second]
        by_gap[capacity - used].append(n)
        mask |= 1 << (capacity - used)
        n += 1

    for i in order[len(large) :]:
        length = lengths[i]
        open_ = mask >> length
        if open_ and length:
            gap = (open_ & -open_).bit_length() - 1 + length
            s = by_gap[gap].pop()
            if not by_gap[gap]:
                mask &= ~(1 << gap)
        else:
            gap, s = capacity, n
            n += 1
        sequence[i], offset[i] = s, capacity - gap
        by_gap[gap - length].append(s)
        mask |= 1 << (gap - length)
    return sequence, offset


def _pack(capacity: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sequence, offset = pack_lengths(table["length"].to_pylist(), capacity)
        base = key[0].as_py() << 32
        out = table.drop_columns(["shard"])
        return out.append_column("sequence_id", pa.array([base + s for s in sequence], pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """docs: doc_id, text. A row per piece with its sequence and its place there."""
    shards, dealt = deal(stash(pieces(docs, tokenizer, capacity, end_id), "pieces"))
    return dealt.groupBy("shard").applyInArrow(_pack(capacity), PACKED)


def deal(cut: DataFrame) -> tuple[int, DataFrame]:
    """The number of shards, and the rows with their `shard`: shard sizes differ by one at most.

    A row's number is that of its place in its partition behind all rows of the partitions before; the driver gets one count of each
    partition. A stored table is read by the same partitions twice; were it not, shards would only be less even.
    """
    counts = dict(cut.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    shards = max(1, -(-sum(counts.values()) // SHARD))
    before = list(itertools.accumulate((counts.get(p, 0) for p in range(max(counts, default=0))), initial=0))
    first = F.get(F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>"), F.spark_partition_id())  # folded to one literal
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return shards, cut.withColumn("shard", (place + F.coalesce(first, F.lit(0))) % shards)
