"""Where stashes go and when they go away; names that clash."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline import storage
from ledgerline.llm import common, decontam, langid, quality, simhash, suffixdedup
from ledgerline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def left(spark):
    home = storage.home(spark).removeprefix("file://")
    return sorted(n.rsplit("-", 1)[0] for n in os.listdir(home))


def test_tidy_drops_what_is_used_up(spark):
    storage.clear(spark)
    with common.tidy() as keep:
        inner = common.Stash(spark.range(3), "inner")
        with common.tidy() as keep_inner:
            common.Stash(inner.df, "gone")
            second = keep_inner(inner.df, "second")
        assert left(spark) == ["inner", "second"]
        kept = keep(second.df, "kept")
    assert left(spark) == ["kept"] and kept.df.count() == 3
    storage.clear(spark)
    assert left(spark) == []


def test_another_default_file_system(spark, tmp_path, monkeypatch):
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.other.link./data", f"file://{tmp_path}")
    conf.set("fs.defaultFS", "viewfs://other/")
    monkeypatch.setattr(storage, "_setting", lambda _: "/data/ckpt")
    try:
        assert storage.shared_dir(spark) == "viewfs://other/data/ckpt"
        kept = common.Stash(spark.range(5), "five")
        assert kept.path.startswith("viewfs://other/data/ckpt/") and kept.df.count() == 5
        assert (tmp_path / "ckpt" / "ledgerline").is_dir()
        kept.drop()
        assert left_in(tmp_path) == 0
    finally:
        conf.set("fs.defaultFS", before)


def left_in(folder):
    return sum(len(f) for _, _, f in os.walk(folder))


def test_a_cluster_needs_a_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_is_local", lambda _: False)
    monkeypatch.setattr(storage, "_setting", lambda _: None)
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):
        storage.shared_dir(spark)
    monkeypatch.setattr(storage, "_setting", lambda _: str(tmp_path))
    with pytest.raises(RuntimeError, match="a folder of each machine"):
        storage.shared_dir(spark)
    monkeypatch.setattr(storage, "_setting", lambda _: f"file://{tmp_path}")
    assert storage.shared_dir(spark) == f"file://{tmp_path}"  # written out: a mount, which is probed
    assert common.Stash(spark.range(2), "two").df.count() == 2 and not any("probe" in n for n in os.listdir(next((tmp_path / "ledgerline").iterdir())))


def test_probe_sees_a_folder_that_is_not_shared(spark, tmp_path, monkeypatch):
    class Lost:  # what a reader finds where the mount is missing
        def text(self, _):
            return spark.range(0)

    class Session:
        _jvm, _jsc, read = spark._jvm, spark._jsc, Lost()

    with pytest.raises(RuntimeError, match="executors see 0 of 16"):
        storage.probe(Session(), f"file://{tmp_path}")
    assert left_in(tmp_path) == 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op6_simhash_near_dedup", "op7_suffix_array_dedup", "op9_best_fit_packing"])
def test_queries_leave_only_what_their_result_reads(spark, name):
    storage.clear(spark)
    found = QUERIES[name](spark, SF)
    kept = left(spark)
    assert found.count() > 0
    read = {f.split("/ledgerline/")[1].split("/")[1].rsplit("-", 1)[0] for f in found.inputFiles() if "/ledgerline/" in f}
    assert set(kept) - read <= {"quality-bounds", "suffix-heavy"} and len(kept) <= 5, (kept, read)
    storage.clear(spark)
    assert left(spark) == []


CLASHING = ["__m", "__p", "__mark", "__n", "__row", "__id", "__h", "__bucket", "__kind", "__blob", "__text", "__kept", "__n_removed", "__n_spans", "__fp", "fp", "h", "n", "row", "m", "root", "blob", "ID"]


def test_columns_with_any_name_pass_unchanged(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en"), (2, text, "en"), (3, "a benchmark item of some words " + text.upper(), "de"), (4, None, None), (5, "", "en"), (6, "other short text", "fr"), (6, "other short text", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    more = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING})
    bench = spark.createDataFrame([(1, "a benchmark item of some words")], "item_id long, text string")
    steps = {"clean": lambda d: decontam.clean(d, bench), "keep_known": langid.keep_known, "keep_one": simhash.keep_one, "dedup": suffixdedup.dedup}
    for name, step in steps.items():
        want = sorted(map(tuple, step(docs).collect()), key=str)
        got = step(more)
        assert got.columns == more.columns, name
        found = got.collect()
        assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in found), key=str) == want, name
        assert all(r[c] == f"{c}{r['doc_id']}" for r in found for c in CLASHING), name
    judged = quality.judge(more.withColumn("source", F.lit("s")).withColumns({c: F.lit(c) for c in ("n_words", "kept", "bucket", "_c", "_symbols", "l", "s")}))
    assert judged.count() == 7
