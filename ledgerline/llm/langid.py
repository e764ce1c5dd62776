"""Hierarchical language identification: the family first, then one-versus-one linear SVMs within it.

Features are the relative frequencies of a text's letter trigrams (UTF-8 bytes, case folded, anything else a space),
hashed to `DIMENSIONS` and put through a square root, with unit length. The first step is a linear machine per
family, the best of which wins. Within the family every pair of languages has a linear support vector machine that saw only
their documents; the language with most votes wins, then the one with the larger sum of margins. Languages without an
entry in `FAMILIES` are families of their own.

The fit sees at most `PER_LANGUAGE` documents of each language and `MOST_ROWS` of all, those with the smallest hash of their id, and
never those that are held out; all documents are then classified, whole. Machines minimize the L2-regularized squared hinge
loss by full gradient steps, in one fixed order, so that a fit can be repeated.

Defined results: null text or one without a letter (Unicode category L; numerals such as `½` or `Ⅷ` are none): `und` with score 0. No
labelled document at all: `und` for every text. Null lang: not learned from. Rows of one language that share a doc_id, or have none, are one to
learn from, that with the smallest text. A null doc_id is not held out. Repeated rows: each its own. Empty table: empty result.
Other columns are ignored by `predict` and kept by `keep_known`.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import held_out, prepare, unused

DIMENSIONS = 4096
PER_LANGUAGE = 600
#: Feature vectors of 8 KB that the driver gets at most, about; with more than 25 languages each has fewer.
MOST_ROWS = 15_000
STEPS = 150

#: Families of common languages.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "pl": "slavic", "cs": "slavic", "ru": "slavic", "uk": "slavic", "bg": "slavic",
}

#: Lower case for A-Z; a space for what is neither an ASCII letter nor part of another character.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def features(text: bytes) -> np.ndarray:
    """Unit vector of the roots of hashed letter trigram counts; trigrams of spaces alone don't count."""
    out = np.zeros(DIMENSIONS, np.int64)
    data = np.frombuffer(b" " + text.translate(_FOLD) + b" ", np.uint8)
    for at in range(0, len(data) - 2, 1 << 20):
        x = data[at : at + (1 << 20) + 2].astype(np.uint32)
        key = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
        key = key[(x[1:-1] != 32)]
        out += np.bincount(((key * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64), minlength=DIMENSIONS)
    root = np.sqrt(out.astype(np.float32))
    size = np.sqrt(float(out.sum()))
    return root / size if size else root


def fit_machine(x: np.ndarray, y: np.ndarray, reg: float = 1e-4) -> tuple[np.ndarray, float]:
    """A linear SVM with squared hinge loss, classes weighted alike; y is 1 or -1."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    vw, vb = np.zeros_like(w), 0.0
    for step in range(STEPS):
        slack = np.maximum(0, 1 - y * (x @ w + b)) * y * weight
        vw = 0.9 * vw + (x.T @ slack - reg * w)
        vb = 0.9 * vb + float(slack.sum())
        w, b = w + 0.5 * vw, b + 0.5 * vb
    return w, b


@dataclass
class Model:
    """Families with their languages and machines; sizes depend on the number of languages alone."""

    families: list[str]
    languages: dict[str, list[str]]
    family_w: np.ndarray
    family_b: np.ndarray
    pairs: dict[str, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def fit(x: np.ndarray, langs: list[str], families: dict[str, str]) -> Model:
        of = {lang: families.get(lang, lang) for lang in sorted(set(langs))}
        names = sorted(set(of.values()))
        lang, family = np.array(langs), np.array([of[v] for v in langs])
        if len(names) == 1:
            machines = [(np.zeros(x.shape[1], np.float32), 1.0)]
        else:
            machines = [fit_machine(x, np.where(family == f, 1, -1).astype(np.float32)) for f in (names if len(names) > 2 else names[:1])]
            if len(names) == 2:  # the other family's machine is the mirror image
                machines.append((-machines[0][0], -machines[0][1]))
        languages = {f: [v for v in of if of[v] == f] for f in names}
        pairs = {}
        for f in names:
            own = []
            for a, b in itertools.combinations(languages[f], 2):
                here = (lang == a) | (lang == b)
                own.append(fit_machine(x[here], np.where(lang[here] == a, 1, -1).astype(np.float32)))
            if own:
                pairs[f] = (np.stack([w for w, _ in own], axis=1), np.array([b for _, b in own]))
        return Model(names, languages, np.stack([w for w, _ in machines], axis=1), np.array([b for _, b in machines]), pairs)

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not text or not self.families or not any(map(str.isalpha, text.decode("utf-8", "replace"))):
            return "und", 0.0
        x = features(text)
        margins = x @ self.family_w + self.family_b
        best = int(margins.argmax())
        score = float(1 / (1 + np.exp(-4 * margins[best])))
        langs = self.languages[self.families[best]]
        if len(langs) == 1:
            return langs[0], score
        w, b = self.pairs[self.families[best]]
        votes = np.zeros((len(langs), 2))
        chance = np.ones(len(langs))
        for (i, j), m in zip(itertools.combinations(range(len(langs)), 2), x @ w + b):
            votes[i if m >= 0 else j, 0] += 1
            votes[i, 1] += m
            votes[j, 1] -= m
            chance[i] = min(chance[i], 1 / (1 + np.exp(-4 * m)))
            chance[j] = min(chance[j], 1 / (1 + np.exp(4 * m)))
        win = max(range(len(langs)), key=lambda i: (votes[i, 0], votes[i, 1], -i))
        return langs[win], score * float(chance[win])


def _featurize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t.as_py()).astype(np.float16).tobytes() for t in batch.column(2).cast(pa.binary())]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(rows, pa.binary())], names=["lang", "h", "x"])


def fit(docs: DataFrame, families: dict[str, str] | None = None, per_language: int = PER_LANGUAGE) -> Model:
    """docs: doc_id, text, lang. Learns from documents that aren't held out and have a text and a lang."""
    prepare(docs.sparkSession)
    usable = docs.filter(F.col("lang").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("doc_id")))
    place = F.xxhash64(F.lit("langid"), F.col("doc_id")).bitwiseAND(F.lit((1 << 63) - 1))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    if not sizes:
        return Model([], {}, np.zeros((DIMENSIONS, 0)), np.zeros(0), {})
    per_language = max(1, min(per_language, MOST_ROWS // len(sizes)))
    # A hash below a language's share of 2^63 chooses about a quarter more than per_language; the surplus goes on the driver.
    within = F.lit(False)
    for lang, n in sizes.items():
        share = min(1.0, (1.25 * per_language + 50) / n)
        within = within | ((F.col("lang") == lang) & (place <= F.lit(int(share * ((1 << 63) - 1024)))))
    chosen = usable.filter(within).groupBy("lang", place.alias("h")).agg(F.min("text").alias("text"))
    rows = chosen.mapInArrow(_featurize, "lang string, h long, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["h"], r["x"]))
    rows = [r for _, g in itertools.groupby(rows, key=lambda r: r["lang"]) for r in itertools.islice(g, per_language)]
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    return Model.fit(x, [r["lang"] for r in rows], FAMILIES if families is None else families)


def predictor(spark, model: Model):
    """A function of a text column: struct of lang_pred and score."""
    sent = spark.sparkContext.broadcast(model)  # grows with the number of languages, not with the corpus

    @F.arrow_udf(StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
    def predict(text: pa.Array) -> pa.Array:
        got = [sent.value.predict(t.as_py()) for t in text.cast(pa.binary())]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["lang_pred", "score"])

    return predict.asNondeterministic()  # so that a filter on it isn't pushed below it and run twice


def predict(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs: doc_id, text, lang. Each row's doc_id, held_out, lang_pred and score."""
    model = model or fit(docs)
    told = docs.select("doc_id", predictor(docs.sparkSession, model)(F.col("text")).alias("__p"))
    return told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "__p.lang_pred", "__p.score")


def keep_known(docs: DataFrame, model: Model | None = None, least: float = 0.0) -> DataFrame:
    """The documents whose language is known, with a score of at least `least`; all their columns."""
    model = model or fit(docs)
    (p,) = unused(docs, "__p")
    told = docs.withColumn(p, predictor(docs.sparkSession, model)(F.col("text")))
    keep: Column = (F.col(f"{p}.lang_pred") != "und") & (F.col(f"{p}.score") >= least)
    return told.filter(keep).select(*docs.columns)
