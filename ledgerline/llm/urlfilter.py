"""URL filters by a Bloom filter cascade (native: DataFrame functions only).

Level 0 is a Bloom filter of the listed keys; level 1 one of level 0's false positives over the corpus's complete
key universe; level 2 one of the listed keys that level 1 takes, and so on until no key is wrong. A key of the
universe is listed exactly if the first level that misses it is an odd one. The filters are literals in the plan, so membership
needs no join; nothing is looked up but keys of the universe, so it is exact.

Rules are (host, path) keys, written host + path. A url's candidate keys are its host's suffixes, for the label
counts that rules have, with its path's prefixes, for the lengths that rules have. Two cascades, of block and of
allow rules, judge the candidates; the longest listed one wins.

Defined results: null or no `://`: empty host and path, no rule. A url without a rule is listed nowhere: allow. The
same key in both lists: block. Rules of equal length: that with the longer host. Repeated rows stay. Other columns
of the input are ignored. Empty table: empty result.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

#: Listed keys beyond which their filters would be too large for a plan literal; then membership is an equi-join.
MAX_LISTED = 2_000_000


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), "^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    """Bit positions by double hashing; both parts have 31 bits, so that no sum overflows."""
    h = F.xxhash64(F.lit(level), key)
    low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 33)
    return [(low + high * F.lit(i)) % F.lit(bits) for i in range(hashes)]


@dataclass
class Level:
    """One Bloom filter: its bits as 64-bit words."""

    level: int
    words: list[int]
    hashes: int

    @staticmethod
    def of(keys: DataFrame, level: int, n: int, error: float) -> Level:
        bits = 64 * max(1, math.ceil(-n * math.log(error) / math.log(2) ** 2 / 64))
        hashes = max(1, round(-math.log2(error)))
        at = keys.select(F.explode(F.array(*_positions(F.col("key"), level, bits, hashes))).alias("p"))
        got = at.groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("v"))
        words = [0] * (bits // 64)
        for w, v in got.collect():  # at most bits / 64 rows, bounded by MAX_LISTED
            words[w] = v
        return Level(level, words, hashes)

    def has(self, key: Column) -> Column:
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")  # folded to one literal
        test = F.lit(True)
        for p in _positions(key, self.level, 64 * len(self.words), self.hashes):
            word = F.get(table, (p / 64).cast("int"))
            test = test & (F.getbit(word, (p % 64).cast("int")) == 1)
        return test


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    @staticmethod
    def build(listed: DataFrame, universe: DataFrame, error: float = 0.01) -> Cascade:
        """listed, universe: tables with a distinct, non-null string column `key`. Raises above MAX_LISTED keys.

        Listed keys outside the universe are never looked up and so aren't encoded.
        """
        inside = stash(universe.join(listed, "key", "left_semi"), "url-listed")
        levels: list[Level] = []
        n = inside.count()
        if n > MAX_LISTED:
            raise ValueError(f"{n} keys are too many for a literal filter; judge() joins instead")
        now = before = inside
        while n:
            levels.append(Level.of(now, len(levels), n, error))
            if len(levels) == 1:  # the universe meets the filter first; only what it takes meets the list
                wrong = universe.filter(levels[0].has(F.col("key"))).join(listed, "key", "left_anti")
            else:
                wrong = before.filter(levels[-1].has(F.col("key")))
            before, now = now, stash(wrong, "url-wrong")
            n = now.count()
        return Cascade(levels)

    def has(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the filters that it passes from the first on are odd in number."""
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            out = F.when(~level.has(key), F.lit(level.level % 2 == 1)).otherwise(out)
        return out


def candidates(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """The keys a rule may have to fit this url, longest first; at most len(labels) * len(lengths)."""
    parts = F.split(host, r"\.")
    size = F.size(parts)
    found = []
    for n in labels:
        suffix = F.array_join(F.slice(parts, F.greatest(size - n + 1, F.lit(1)), F.lit(n)), ".")
        for m in lengths:
            fits = (host != "") & (size >= n) & (F.length(path) >= m)
            found.append(F.when(fits, F.concat(suffix, F.substring(path, 1, m))))
    host_size = lambda key: F.length(F.substring_index(key, "/", 1))
    return F.array_sort(
        F.filter(F.array(*found), lambda x: x.isNotNull()),
        lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).otherwise(host_size(b) - host_size(a)),
    )


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], error: float = 0.01) -> DataFrame:
    """Each row's page_id, host, path, rule and verdict. rules: (`block` or `allow`, host, path)."""
    spark = pages.sparkSession
    urls = pages.select("page_id", "url").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labels = sorted({h.count(".") + 1 for _, h, _ in rules})
    lengths = sorted({len(p) for _, _, p in rules})
    block = sorted({h + p for a, h, p in rules if a == "block"})
    allow = sorted({h + p for a, h, p in rules if a == "allow"} - set(block))
    keyed = urls.withColumn("keys", candidates(F.col("host"), F.col("path"), labels, lengths))
    if len(block) + len(allow) > MAX_LISTED:
        return _judge_by_join(keyed, block, allow)
    universe = stash(keyed.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    table = lambda keys: spark.sql("select explode(split('{}', '\n')) key".format("\n".join(k.replace("\\", "\\\\").replace("'", "\\'") for k in keys))).filter("key <> ''")
    blocks, allows = Cascade.build(table(block), universe, error), Cascade.build(table(allow), universe, error)
    hit = F.get(F.filter("keys", lambda k: blocks.has(k) | allows.has(k)), F.lit(0))
    out = keyed.select("page_id", "host", "path", hit.alias("rule"))
    return out.withColumn("verdict", F.when(F.col("rule").isNotNull() & blocks.has(F.col("rule")), "block").otherwise("allow"))


def _judge_by_join(keyed: DataFrame, block: list[str], allow: list[str]) -> DataFrame:
    """The way beyond MAX_LISTED: candidates meet the list by an equi-join."""
    spark = keyed.sparkSession
    listed = spark.createDataFrame([(k, "block") for k in block] + [(k, "allow") for k in allow], "key string, action string")
    rows = keyed.withColumn("row", F.monotonically_increasing_id())
    hits = rows.select("row", F.posexplode("keys").alias("at", "key")).join(listed, "key")
    best = hits.groupBy("row").agg(F.min(F.struct("at", "key", "action")).alias("b"))
    return rows.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("b.key").alias("rule"), F.coalesce("b.action", F.lit("allow")).alias("verdict")
    )
