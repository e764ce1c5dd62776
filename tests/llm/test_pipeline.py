"""The pipeline's stages against brute force, each on what its predecessor kept."""

import os
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline import storage
from ledgerline.llm import langid, simhash
from ledgerline.llm.common import stash
from ledgerline.llm.queries import word_tokenizer

from .test_dedup_operators import brute_matches
from .test_models_and_formats import check_packing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(3).select((F.col("doc_id") + 100_000).alias("doc_id"), F.expr("case doc_id % 3 when 0 then null when 1 then '' else '12 34 !!' end").alias("text"), "lang", "source", "n_chars")
    now = stash(docs.union(extra), "test-docs")
    seen = [("input", now)]
    for name, stage in corpus_pipeline.STAGES:
        now = stash(stage(spark, now, SF), f"test-{name}")
        seen.append((name, now))
    return seen


def home(spark):
    return storage.home(spark).removeprefix("file://")


def table(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns(stages):
    assert all(df.columns == stages[0][1].columns for _, df in stages[:-1])


def test_language(spark, stages):
    before, after = table(stages[0][1]), table(stages[1][1])
    told = {r["doc_id"]: r["lang_pred"] for r in langid.predict(stages[0][1]).collect()}
    assert set(before) - set(after) == {i for i, v in told.items() if v == "und"} and len(before) - len(after) == 3
    assert all(after[i] == before[i] for i in after)


def test_near_duplicates(stages):
    before, after = table(stages[1][1]), table(stages[2][1])
    fps = {i: simhash.fingerprint(r["text"].encode()) for i, r in before.items()}
    ids = sorted(fps)
    root = {i: i for i in ids}
    values = np.array([fps[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= 3).tolist():
            a, b = root[i], root[ids[j]]
            if a != b:
                root = {x: min(a, b) if r in (a, b) else r for x, r in root.items()}
    assert set(after) == set(root.values()) and len(after) < len(before)


def test_suffix_dedup(stages):
    before, after = table(stages[2][1]), table(stages[3][1])
    seen = {}
    for i in sorted(before):
        b = before[i]["text"].encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if seen.setdefault(b[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        left = bytes(c for c, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        if left or not any(gone):
            assert (after[i]["text"], after[i]["n_chars"], after[i]["source"]) == (left, len(left), before[i]["source"])
        else:
            assert i not in after


def test_decontamination(spark, stages):
    before, after = table(stages[3][1]), table(stages[4][1])
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, *_ in brute_matches([(i, r["text"]) for i, r in before.items()], items)}
    assert set(after) == set(before) - dirty


def test_packing_and_run(spark, stages):
    docs = [(i, r["text"]) for i, r in table(stages[4][1]).items()]
    check_packing(stages[5][1].collect(), docs, 4096)
    before = set(os.listdir(home(spark)))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(home(spark))) - before} == {"pipeline-decontaminate", "pieces"}  # no stage leaves its own tables
    lengths = defaultdict(int)
    for r in rows:
        lengths[r["doc_id"]] += r["length"]
    want = defaultdict(int)
    for r in stages[5][1].collect():
        want[r["doc_id"]] += r["length"]
    assert lengths == want and word_tokenizer()
