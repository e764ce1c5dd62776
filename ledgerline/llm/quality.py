"""Quality rules with thresholds that adapt to each language and source.

Each document's metrics are whole per-mille ratios: mean word length, symbols per word, duplicate lines per line and
repeated words per word. For every (lang, source) group and metric a mergeable quantile sketch is built: a histogram
whose buckets keep the six leading bits of a value (relative error below 1/32), so that sketches merge by adding counts,
in any order, with one result. Counts are pre-aggregated before the shuffle, hence a hot source costs no more than its buckets.

A group's bounds come from its sketches alone. A value is an outlier if it is beyond both the Tukey fence about the middle half of the
group's values (Q3 + REACH * (Q3 - Q1)) and the group's tail quantile (`METRICS`, per mille); for word length also on the lower
side. Where a metric is spread out the fence decides, and cuts nothing from a group without outliers; where it is zero for most
documents, the fence is zero and the tail quantile decides: at most that share of the group goes. Values compare by bucket, so ties with a bound stay.
Groups of fewer than `LEAST` documents use their language's merged sketch, and languages of fewer that of all documents.
The bounds, a row per group, join the documents, and those within all bounds are kept.

Defined results: null text: no words, base_failed. Null lang or source: groups of their own. Ties and repeated rows:
each row is judged alone. Empty table: empty result. `judge` reads doc_id, text, lang and source alone; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import prepare, stash

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
REACH = 3
LEAST = 50

#: Metric: numerator, denominator, the tail quantile in per mille, and whether low values are outliers too.
METRICS = {
    "word_length": ("word_chars", "n_words", 980, True),
    "symbols": ("n_symbols", "n_words", 900, False),
    "dup_lines": ("n_dup_lines", "n_lines", 990, False),
    "repeated": ("n_repeat_words", "n_words", 990, False),
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words within 8-word windows that the text has twice or more. Windows are compared exactly: ranks of pairs, of fours, of eights."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    rank = np.fromiter([number.setdefault(w, len(number)) for w in words], np.uint64, len(words))
    if len(number) == len(words):
        return 0
    for step in (1, 2, 4):
        pair = (rank[:-step] << np.uint64(32)) | rank[step:]
        order = np.argsort(pair)
        new = np.r_[True, pair[order][1:] != pair[order][:-1]]
        if new.all():
            return 0
        rank = np.empty(len(pair), np.uint64)
        rank[order] = np.cumsum(new).astype(np.uint64)
    many = np.bincount(rank.astype(np.int64))[rank.astype(np.int64)] > 1
    reach = np.zeros(len(words) + 1, np.int64)
    np.add.at(reach, np.flatnonzero(many), 1)
    np.add.at(reach, np.flatnonzero(many) + WINDOW, -1)
    return int((np.cumsum(reach[:-1]) > 0).sum())


def counts(text: bytes | None) -> tuple[int, ...]:
    """COUNTS of one text. Lines are those with a word, split at line feeds."""
    text = text or b""
    words = text.split()
    continued = len(re.findall(b"[\x80-\xbf]", text)) if not text.isascii() else 0  # all within words
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        sum(map(len, words)) - continued,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


@F.arrow_udf(StructType([StructField(c, LongType(), False) for c in COUNTS]))
def _counts(text: pa.Array) -> pa.Array:
    rows = np.array([counts(t.as_py()) for t in text.cast(pa.binary())], np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(COUNTS))], names=COUNTS)


def per_mille(top: str, under: str) -> Column:
    return F.when(F.col(under) > 0, F.floor(F.col(top) * 1000 / F.col(under))).otherwise(0).cast("long")


def bucket(value: Column) -> Column:
    """The least value of a value's sketch bucket: its six leading bits."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, metric, bucket, n: the sketch of each group as rows; adding n merges sketches."""
    metrics = F.array(*(F.struct(F.lit(m).alias("metric"), bucket(F.col(f"_{m}")).alias("bucket")) for m in METRICS))
    each = measured.filter("not base_failed").select("lang", "source", F.inline(metrics))
    return each.groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """by, metric, total, q1, q3, low and top of the sketches merged to the groups of `by`. A group has at most some hundred buckets."""
    merged = sketch.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))
    packed = merged.groupBy(*by, "metric").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("h"))
    tail = F.coalesce(*(F.when(F.col("metric") == m, F.lit(t)) for m, (_, _, t, _) in METRICS.items()))

    def at(part: Column) -> Column:
        """The least bucket with at least `part` per mille of the values in it or below."""
        step = F.aggregate(
            "h",
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("q")),
            lambda s, x: F.struct((s["n"] + x["n"]).alias("n"), F.coalesce(s["q"], F.when((s["n"] + x["n"]) * 1000 >= F.col("total") * part, x["bucket"])).alias("q")),
        )
        return step["q"]

    return packed.select(*by, "metric", "total", at(F.lit(250)).alias("q1"), at(F.lit(750)).alias("q3"), at(1000 - tail).alias("low"), at(tail).alias("top"))


def bounds(sketch: DataFrame) -> DataFrame:
    """A row per (lang, source) group: `low_` and `high_` of each metric, from the finest sketch with enough documents."""
    fine = quantiles(sketch, ["lang", "source"])
    middle = quantiles(sketch, ["lang"]).toDF("l", "m", "total1", "q11", "q31", "low1", "top1")
    coarse = quantiles(sketch, []).toDF("c", "total2", "q12", "q32", "low2", "top2")
    told = fine.join(middle, F.col("lang").eqNullSafe(F.col("l")) & (F.col("metric") == F.col("m"))).join(coarse, F.col("metric") == F.col("c"))
    pick = lambda q: F.when(F.col("total") >= LEAST, F.col(q)).when(F.col("total1") >= LEAST, F.col(f"{q}1")).otherwise(F.col(f"{q}2"))
    reach = REACH * (pick("q3") - pick("q1"))
    ranged = told.select("lang", "source", "metric", F.least(pick("low"), pick("q1") - reach).alias("low"), F.greatest(pick("top"), pick("q3") + reach).alias("high"))
    return ranged.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("metric") == m, F.col(x))).alias(f"{x}_{m}") for m, (_, _, _, both) in METRICS.items() for x in (("low", "high") if both else ("high",)))
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, COUNTS, base_failed and the metrics (`_` before their names)."""
    prepare(docs.sparkSession)
    got = docs.select("doc_id", "lang", "source", _counts("text").alias("_c")).select("doc_id", "lang", "source", "_c.*")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return got.withColumn("base_failed", base).withColumns({f"_{m}": per_mille(t, u) for m, (t, u, _, _) in METRICS.items()})


def judge(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text, lang, source. Each row's counts, base_failed and kept."""
    measured = stash(measure(docs), "quality-metrics")
    limits = stash(bounds(sketches(measured)), "quality-bounds").withColumnsRenamed({"lang": "l", "source": "s"})
    told = measured.join(limits, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    inside = F.lit(True)
    for m, (_, _, _, both) in METRICS.items():
        held = bucket(F.col(f"_{m}"))
        inside = inside & F.coalesce(held <= F.col(f"high_{m}"), F.lit(True))
        if both:
            inside = inside & F.coalesce(held >= F.col(f"low_{m}"), F.lit(True))
    return told.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & inside).alias("kept"))
