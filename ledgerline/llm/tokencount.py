"""Edit-aware token counts: a segment tree of pre-tokens for each document.

A byte-level BPE never joins pre-tokens, so a text's count is the sum of its pre-tokens' counts. A document's tree has leaves of
`LEAF` pre-tokens and holds, for each node, the characters and the tokens below it. A document's edits are one sweep: each finds its
leaf by descending the tree, re-encodes from the last safe leaf boundary before it until a new pre-token ends on an old leaf
boundary behind it (and takes in further edits that begin before that), and updates the sums on the way to the root; everything else
stays as it was, and the text is copied once. New pre-tokens go to the leaves of their region; where they are too many for these, leaves are
inserted and the sums above are added up again, without encoding anything.

Boundary context. The pre-token pattern looks ahead by two characters at most (contractions), or to the end of a run of white space
and one character further. So a boundary is safe if at least two characters, one of them not white space, lie between it
and the edit. Behind the edit, matching depends on what follows alone, so a common boundary means that all later ones are common.

A tree is two arrays in heap order (the root at 1), kept in a table beside its document's text; `recount` returns both as the edits
leave them, so that the next edits start from there.

Defined results: null text: an empty tree, count 0; edits of it are ignored, as are null edits. Edits are (start, stop, text) in characters
of the text before any of them, in ascending order; one that overlaps its predecessor raises. Repeated rows: each its own.
Empty table: empty result. Other columns are kept, but those of `recount` that are named like its counts are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import prepare, unused

LEAF = 64
_CACHE_LIMIT = 400_000

TREE = StructType([StructField("chars", ArrayType(IntegerType())), StructField("tokens", ArrayType(IntegerType()))])
EDIT = StructType([StructField("start", IntegerType()), StructField("stop", IntegerType()), StructField("text", StringType())])
COUNTS = ["n_tokens", "n_edits", "n_tokens_after", "n_pretokens_encoded"]
EDITED = StructType([StructField("text", StringType()), StructField("tree", TREE), *(StructField(c, LongType()) for c in COUNTS)])
_TREE = pa.struct([("chars", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int32()))])


class PieceCounts(dict):
    """Tokens of a pre-token."""

    def __init__(self, path: str, pattern: str):
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self.encode = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece))
        if len(self) < _CACHE_LIMIT:
            self[piece] = n
        return n


class Tree:
    """Characters and tokens of each node, in heap order; leaf i is node size + i."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.chars, self.tokens, self.size = chars, tokens, len(chars) // 2

    @staticmethod
    def of_leaves(leaves: list[tuple[int, int]]) -> Tree:
        size = 1 << max(0, (len(leaves) - 1).bit_length())
        both = []
        for part in range(2):
            heap = [0] * size + [leaf[part] for leaf in leaves] + [0] * (size - len(leaves))
            for i in range(size - 1, 0, -1):
                heap[i] = heap[2 * i] + heap[2 * i + 1]
            both.append(heap)
        return Tree(*both)

    @staticmethod
    def build(text: str, split: Callable[[str], list[str]], counts: PieceCounts) -> Tree:
        pieces = split(text)
        n, c = list(map(counts.__getitem__, pieces)), list(map(len, pieces))
        return Tree.of_leaves([(sum(c[i : i + LEAF]), sum(n[i : i + LEAF])) for i in range(0, len(pieces), LEAF)])

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaf_at(self, char: int) -> tuple[int, int]:
        """The leaf with this character (the last one that has any, for the text's end), and its first character."""
        node, first = 1, 0
        char = min(char, self.chars[1] - 1)
        while node < self.size:
            node *= 2
            if char - first >= self.chars[node]:
                first += self.chars[node]
                node += 1
        return node - self.size, first

    def leaf(self, i: int) -> tuple[int, int]:
        return self.chars[i + self.size], self.tokens[i + self.size]

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node and (more_chars or more_tokens):
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def safe(self, text: str, start: int) -> tuple[int, int]:
        """The last leaf whose beginning no edit at `start` can move, and that beginning."""
        leaf, begin = self.leaf_at(start) if self.chars[1] else (0, 0)
        while leaf and (start - begin < 2 or text[begin:start].isspace()):
            leaf -= 1
            begin -= self.chars[leaf + self.size]
        return leaf, begin

    def edit(self, text: str, edits: list[tuple[int, int, str]], pattern, counts: PieceCounts) -> tuple[str, int]:
        """Apply edits (start, stop, new text) of ascending places; the new text, and how many pre-tokens were encoded."""
        parts, at = [], 0
        for start, stop, new in edits:
            if start < at or stop < start:
                raise ValueError("edits overlap")
            parts += [text[at:start], new]
            at = stop
        after = "".join([*parts, text[at:]])
        patches, encoded, i, shift = [], 0, 0, 0
        while i < len(edits):
            leaf, begin = self.safe(text, edits[i][0])
            last, goal, end = leaf, begin + self.chars[leaf + self.size], begin + shift  # goal: in places of the old text
            pieces, closed = [], False
            ahead = leaf
            for match in chain([None], pattern.finditer(after, end)):
                if match:
                    pieces.append(match[0])
                    end = match.end()
                while True:  # edits that begin within the region's leaves belong to it, and it then reaches further
                    if i < len(edits) and ahead <= last:
                        start, stop, new = edits[i]
                        shift += len(new) - (stop - start)
                        reach, reach_after = stop, stop + shift
                        i += 1
                        ahead = self.safe(text, edits[i][0])[0] if i < len(edits) else 0
                    elif last + 1 < self.size and (goal < reach or goal + shift < end):
                        last += 1
                        goal += self.chars[last + self.size]
                    else:
                        break
                if match and goal >= reach and goal + shift == end and end >= reach_after:
                    closed = True
                    break
            if not closed:
                i, last = len(edits), self.size - 1
            encoded += len(pieces)
            n, c = list(map(counts.__getitem__, pieces)), list(map(len, pieces))
            patches.append((leaf, last, [(sum(c[k : k + LEAF]), sum(n[k : k + LEAF])) for k in range(0, len(pieces), LEAF)]))
        if all(len(new) <= last + 1 - leaf for leaf, last, new in patches):
            for leaf, last, new in patches:
                for k in range(leaf, last + 1):
                    self.put(k, *(new[k - leaf] if k - leaf < len(new) else (0, 0)))
        else:
            leaves, at = [], 0
            for leaf, last, new in patches:
                leaves += [*map(self.leaf, range(at, leaf)), *new]
                at = last + 1
            leaves += map(self.leaf, range(at, self.size))
            whole = Tree.of_leaves([x for x in leaves if x[0]])
            self.chars, self.tokens, self.size = whole.chars, whole.tokens, whole.size
        return after, encoded


#: Strings that a redaction replaces: mail addresses, long hexadecimal or digit runs.
REDACTED = re.compile(r"[\w.+-]+@[\w-]+\.[\w.-]+|\b[0-9a-fA-F]{24,}\b|\+?\d[\d ()-]{7,}\d")


#: Web addresses, and runs of blank lines: what a second round of edits replaces.
LINK = re.compile(r"https?://\S+|\n{3,}")


def redactions(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "<redacted>") for m in REDACTED.finditer(text)]


def tidyings(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), "\n\n" if m[0][0] == "\n" else "<link>") for m in LINK.finditer(text)]


def _tools(path: str, pattern: str, state: dict):
    if not state:
        import regex

        state.update(counts=PieceCounts(path, pattern), pattern=regex.compile(pattern))
    return state["counts"], state["pattern"]


def tree_builder(path: str, pattern: str):
    """A function of a text column: its TREE."""
    state: dict = {}

    @F.arrow_udf(TREE)
    def build(text: pa.Array) -> pa.Array:
        counts, compiled = _tools(path, pattern, state)
        trees = [Tree.build(t.as_py() or "", compiled.findall, counts) for t in text]
        kind = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array([t.chars for t in trees], kind), pa.array([t.tokens for t in trees], kind)], names=["chars", "tokens"])

    return build


def edit_finder(find: Callable[[str], list[tuple[int, int, str]]] = redactions):
    """A function of a text column: its edits."""

    @F.arrow_udf(ArrayType(EDIT))
    def edits(text: pa.Array) -> pa.Array:
        rows = [[{"start": a, "stop": b, "text": x} for a, b, x in find(t.as_py() or "")] for t in text]
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("text", pa.string())])))

    return edits


def edit_counter(path: str, pattern: str):
    """A function of text, tree and edits: EDITED."""
    state: dict = {}

    @F.arrow_udf(EDITED)
    def count(text: pa.Array, tree: pa.Array, edits: pa.Array) -> pa.Array:
        counts, compiled = _tools(path, pattern, state)
        rows = []
        for t, k, e in zip(text, tree, edits):
            own, before = k.as_py(), t.as_py()
            held = Tree(own["chars"], own["tokens"])
            n = held.total
            todo = [(x["start"], x["stop"], x["text"] or "") for x in (e.as_py() or []) if x is not None] if before is not None else []
            after, encoded = held.edit(before, todo, compiled, counts) if todo else (before, 0)
            rows.append((after, {"chars": held.chars, "tokens": held.tokens}, n, len(todo), held.total, encoded))
        kinds = (pa.string(), _TREE, *[pa.int64()] * 4)
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 6, kinds)], names=[f.name for f in EDITED])

    return count


def trees(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """docs: text and any other columns, with their `tree`."""
    prepare(docs.sparkSession)
    return docs.withColumn("tree", tree_builder(path, pattern)(F.col("text")))


def recount(kept: DataFrame, path: str, pattern: str) -> DataFrame:
    """kept: text, tree, edits and any other columns. Text and tree after the edits, the counts before and after them, and the pre-tokens that were encoded."""
    prepare(kept.sparkSession)
    (c,) = unused(kept, "__c")
    told = kept.withColumn(c, edit_counter(path, pattern).asNondeterministic()("text", "tree", "edits"))
    return told.withColumns({f.name: F.col(f"{c}.{f.name}") for f in EDITED}).drop(c, "edits")
