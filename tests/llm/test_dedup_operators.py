"""SimHash groups, components, suffix dedup and decontamination against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline import storage
from ledgerline.llm import decontam, simhash, suffixdedup
from ledgerline.llm.common import folded_words
from ledgerline.llm.components import components


def groups_of(values, linked):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(values, 2):
        if linked(a, b):
            parent[find(a)] = find(b)
    out = {}
    for v in values:
        out.setdefault(find(v), set()).add(v)
    return {frozenset(g) for g in out.values()}


def test_golay_code_is_perfect():
    x = np.random.default_rng(1).integers(0, 1 << 23, 5000).astype(np.uint32)
    error = simhash._leaders()[simhash._syndrome(x)]
    assert (np.bitwise_count(error) <= 3).all() and (simhash._syndrome(x ^ error) == 0).all()
    keys = [len({int(k) for k in simhash.codeword_index(np.array([v] + [v ^ (1 << i) for i in range(23)], np.uint32))}) for v in x[:300].tolist()]
    assert set(keys) == {1, 6}


def clustered(n, seed):
    r = random.Random(seed)
    out = set()
    while len(out) < n:
        x = r.getrandbits(64)
        for _ in range(r.choice([1, 1, 3, 40])):
            out.add(x)
            for _ in range(r.choice([1, 2, 3, 3, 4])):
                x ^= 1 << r.randrange(64)
    return sorted(out)


def components_of(spark, values):
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r["node"]: r["root"] for r in components(simhash.links(df)).collect()}
    out = {}
    for v, s in zip(values, signed):
        out.setdefault(found.get(s, s), set()).add(v)
    return {frozenset(g) for g in out.values()}


def test_links_connect_what_brute_force_links(spark):
    values = clustered(1500, 7)
    assert components_of(spark, values) == groups_of(values, lambda a, b: (a ^ b).bit_count() <= 3)


def test_large_keys_are_dealt_again(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LARGE", 20)
    center = random.Random(2).getrandbits(64)
    values = sorted({center, *(center ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a))})
    assert components_of(spark, values) == {frozenset(values)}


def test_near_duplicates_edges(spark):
    text = " ".join(f"w{i}" for i in range(300))
    rows = [(5, text), (3, text), (3, text), (9, text.upper()), (7, None), (8, ""), (None, " \t"), (11, "one two"), (12, "ONE two"), (13, "é " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("root", F.lit(0))
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()]
    by = {i: (f, c) for i, f, c in got}
    assert len(got) == 10 and {by[i][1] for i in (3, 5, 9)} == {3} and by[7] == ("0" * 16, 7) == by[8] == by[None]
    assert by[11][1] == by[12][1] == 11
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    kept = simhash.keep_one(df).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([3, 7, 11, 13], key=str) and kept[0].asDict().keys() == {"doc_id", "text", "fp", "root"}


def test_one_stays_of_each_group_whatever_its_ids(spark):
    texts = [" ".join(f"{c}{i}" for i in range(100)) for c in "abcde"]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[1]), (None, texts[2]), (4, texts[3]), (4, texts[4]), (4, texts[4]), (9, texts[4])]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(zip([None, None, None, 4, 4], texts), key=str)


def test_fingerprint_by_hand():
    import xxhash

    for text in (b"", b"A b", b"A b C", b"a b c d a b c", b" ".join(b"w%d" % (i % 17) for i in range(40_000))):
        w = text.lower().split()
        shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        assert simhash.fingerprint(text) == sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {found.get(i, 0) for i in range(1, 301)} == {0} and found[1001] == 1000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_spans(rows):
    seen = {}
    low = lambda i: float("inf") if i is None else i
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for p in range(len(b) - 49):
            seen[b[p : p + 50]] = min(seen.get(b[p : p + 50], float("inf")), low(i))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if seen[b[p : p + 50]] < low(i):
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for p in range(len(gone)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def suffix_rows(seed):
    r = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcdé 日\n"
    make = lambda n: "".join(r.choice(alphabet) for _ in range(n))
    shared = [make(r.choice([49, 50, 51, 120])) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [r.choice([make(r.randrange(80)), r.choice(shared), r.choice(shared)[r.randrange(10) :]]) for _ in range(r.randrange(6))]
        rows.append((r.choice([i, i, i, 7]), "".join(parts)))
    rows += [(None, shared[0] * 3), (None, shared[0] * 3), (70, None), (71, ""), (72, "ab" * 4000), (73, "ab" * 3000), (74, "x" * 49), (75, "x" * 49), rows[0], rows[0]]
    return rows


def test_spans_against_brute_force(spark):
    for seed in (1, 2):
        rows = suffix_rows(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("blob", F.lit(1)).withColumn("bucket", F.lit(2))
        assert sorted((tuple(r) for r in suffixdedup.spans(df).collect()), key=str) == brute_spans(rows)
    assert suffixdedup.spans(df.limit(0)).count() == 0


def test_large_anchors_go_string_by_string(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "GROUP_BYTES", 300)
    r = random.Random(4)
    line = "a line that stands in all of them, which has an anchor of its own"
    rows = [(i, "".join(r.choice("xyz ") for _ in range(90)) + line + "".join(r.choice("xyz ") for _ in range(90))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    suffixdedup.GROUP_BYTES = 300
    assert sorted((tuple(x) for x in suffixdedup.spans(df).collect()), key=str) == brute_spans(rows)


def test_hot_anchor_goes_to_no_task(spark, monkeypatch):
    """A phrase that stands in all documents, between words of their own: far more contexts than a task may hold."""
    most = 6000
    monkeypatch.setattr(suffixdedup, "HEAVY", most)
    real, settle, calls = suffixdedup._sorted_contexts, suffixdedup._settled_strings, []

    def watched(homes):
        inner = real(homes)

        def run(batches):
            def seen():
                brought = {}
                for batch in batches:
                    for b, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                        brought[b] = brought.get(b, 0) + int(suffixdedup._contexts_of(blob.as_py())[4].sum())
                    assert max(brought.values(), default=0) <= most
                    yield batch

            yield from inner(seen())

        return run

    monkeypatch.setattr(suffixdedup, "_sorted_contexts", watched)
    monkeypatch.setattr(suffixdedup, "_settled_strings", lambda each, homes: calls.append(each.count()) or settle(each, homes))
    r = random.Random(11)
    own = lambda n: "".join(r.choice("pqrstuvw ") for _ in range(n))
    rows = [(i, own(30) + r.choice("xyz") * 3 + " a phrase of forty bytes that all share. " + r.choice("xyz") * 8 + own(30)) for i in range(400)]
    rows += [(500 + i, own(40) + "another passage of some more than fifty bytes, in ten of them" + own(40)) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(x) for x in suffixdedup.spans(df).collect()), key=str) == brute_spans(rows)
    assert len(calls) == 1 and calls[0] > 2000


@pytest.mark.parametrize("few", [0, 1000])
def test_copies_bring_no_contexts(spark, monkeypatch, few):
    """Whole copies are removed without their strings' being dealt, whatever their ids; what others share with them goes too."""
    r = random.Random(5)
    make = lambda n: "".join(r.choice("pqrstuvwé ") for _ in range(n))
    monkeypatch.setattr(suffixdedup, "FEW_COPIES", few)
    texts = [make(3000) for _ in range(6)] + ["x" * 49, "x" * 50, make(50)]
    rows = [(10 * k + i, t) for k in range(9) for i, t in enumerate(texts)] + [(None, texts[0]), (None, texts[0]), (0, texts[0]), (0, texts[1]), (3, texts[0]), (None, None), (None, "y" * 60), (None, "y" * 60)]
    rows += [(5, make(20) + texts[0][100:400] + make(20)), (200, make(20) + texts[3][100:400] + make(20))]
    storage.clear(spark)
    found = suffixdedup.spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(x) for x in found.collect()), key=str) == brute_spans(rows)
    at = next(f for f in found.inputFiles() if "/suffix-contexts-" in f).rpartition("/")[0]
    asked = spark.read.parquet(at).filter(f"kind = {suffixdedup.ASK}").agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    assert 0 < asked < 60_000  # two passages of 300 characters and a row of 3,000 that is there twice, not six texts in nine documents each
    storage.clear(spark)


def test_few_files_are_written(spark, monkeypatch):
    """A file for eight buckets of documents or four of anchors, and not one for each input split: each starts processes."""
    monkeypatch.setattr(suffixdedup, "HOME", 4096)
    monkeypatch.setattr(suffixdedup, "BUCKET", 8192)
    r = random.Random(6)
    make = lambda n: "".join(r.choice("pqrstuvwé ") for _ in range(n))
    shared = [make(300) for _ in range(40)]
    rows = [(i, make(900) + r.choice(shared) + make(900) + r.choice(shared)) for i in range(200)]
    homes = sum(len(t.encode()) for _, t in rows) // 4096
    files, real = {}, suffixdedup.stash

    def counted(df, name):
        out = real(df, name)
        files[name] = len(out.inputFiles())
        return out

    monkeypatch.setattr(suffixdedup, "stash", counted)
    storage.clear(spark)
    found = suffixdedup.spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(30))
    assert sorted((tuple(x) for x in found.collect()), key=str) == brute_spans(rows)
    contexts = sum("/suffix-contexts-" in f for f in found.inputFiles())
    assert homes > 100 and max(files["suffix-shared"], files["suffix-settled"], contexts) <= homes // 8
    assert files["suffix-texts"] <= 4
    storage.clear(spark)


def test_anchors_meet_in_bounded_batches(monkeypatch):
    """Each anchor's rows are all told, whatever the batches; what is held is one entry of each anchor."""
    r = random.Random(5)
    buckets, homes = 2, 3
    pairs = {(r.choice([4, 6, 8, 5, 7, 2 * r.randrange(50), 2 * r.randrange(50) + 1]), row) for row in range(400) for _ in range(2)}
    blobs = []
    for bucket in range(buckets):
        mine = sorted(p for p in pairs if p[0] % buckets == bucket)
        r.shuffle(mine)
        for i in range(0, len(mine), 25):
            g, row = (np.array(x) for x in zip(*mine[i : i + 25]))
            own, local = np.unique(row.astype(np.int64), return_inverse=True)
            blobs.append((bucket, suffixdedup._pack(suffixdedup._planes(g.astype(np.uint64) // np.uint64(buckets), 5), own, suffixdedup._planes(local.astype(np.uint64), 3))))
    batch = pa.record_batch([pa.array([b for b, _ in blobs]), pa.array([x for _, x in blobs]), pa.array([suffixdedup.ASK] * len(blobs), pa.int32()), pa.array([b for b, _ in blobs], pa.int32())], names=["key", "blob", "kind", "bucket"])
    count = {}
    for g, _ in pairs:
        count[g] = count.get(g, 0) + 1
    want = {(row, g) for g, row in pairs if count[g] > 1}
    for meet in (1, 60, 1 << 20):
        monkeypatch.setattr(suffixdedup, "MEET", meet)
        told = []
        for out in suffixdedup._shared(buckets, homes)([batch]):
            for home, blob in zip(out.column(1).to_pylist(), out.column(2)):
                rows, g = suffixdedup._untell(blob.as_py())
                assert set(suffixdedup._doc_bucket(rows, homes).tolist()) <= {home}
                told += zip(rows.tolist(), g.tolist())
        assert len(told) == len(set(told)) and set(told) == want


def test_dedup_keeps_columns(spark):
    text = "".join(random.Random(8).choice("abcdefgh ") for _ in range(200))
    rows = [(1, text, "en"), (2, text, None), (3, "own é " + text, "de"), (4, None, "x"), (5, "", "y")]
    got = {r["doc_id"]: r for r in suffixdedup.dedup(spark.createDataFrame(rows, "doc_id long, text string, n_spans string")).collect()}
    assert set(got) == {1, 3, 4, 5} and got[3]["text"] == "own é " and got[3]["n_spans"] == "de" and got[1]["text"] == text and got[4]["text"] is None and got[5]["text"] == ""


def test_refine_sorts_by_content():
    r = random.Random(9)
    text = np.frombuffer("".join(r.choice("ab") for _ in range(3000)).encode() + b"a" * 60 + b"ab" * 60, np.uint8)
    starts = np.arange(len(text) - 49)
    classes = suffixdedup.refine(text, starts)
    by = {}
    for s, c in zip(starts.tolist(), classes.tolist()):
        by.setdefault(c, set()).add(text[s : s + 50].tobytes())
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({text[s : s + 50].tobytes() for s in starts})


def brute_matches(docs, items):
    def shingles(text, width):
        w = folded_words(None if text is None else text.encode())
        return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}

    out = []
    for d, t in docs:
        for i, x in items:
            width = min(5, len(folded_words(None if x is None else x.encode())))
            own = shingles(x, width) if width else set()
            n = len(own & shingles(t, width)) if own else 0
            if own and n >= 0.8 * len(own) - 1e-9:
                out.append((d, i, len(own), n))
    return sorted(out, key=str)


def test_matches_against_brute_force(spark, monkeypatch):
    r = random.Random(6)
    words = lambda n: [r.choice("the of a in Und der, de la. que x y z".split()) + (str(r.randrange(9)) if r.random() < 0.6 else "") for _ in range(n)]
    items = [(i, " ".join(words(r.choice([1, 2, 4, 5, 6, 30, 60])))) for i in range(30)] + [(99, None), (98, ""), (3, "the of a in Und der"), (None, "null id of an item here")]
    docs = []
    for d in range(80):
        text = words(r.choice([0, 3, 50, 2000]))
        for _ in range(r.randrange(3)):
            own = (r.choice(items)[1] or "").split()
            for _ in range(r.randrange(4)):
                if own:
                    own[r.randrange(len(own))] = "changed"
            at = r.randrange(len(text) + 1)
            text[at:at] = [w.upper() for w in own]
        docs.append((d, " ".join(text)))
    docs += [(500, None), (501, ""), docs[3], (None, items[5][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute_matches(docs, items)
    assert len(want) > 40
    got = decontam.matches(df, bench).collect()
    assert sorted((tuple(x)[:4] for x in got), key=str) == want
    monkeypatch.setattr(decontam, "BLOCK", 500)
    assert sorted((tuple(x)[:4] for x in decontam.matches(df, bench).collect()), key=str) == want
    dirty = {d for d, *_ in want}
    assert {x["doc_id"] for x in decontam.clean(df, bench).collect()} == {d for d, _ in docs if d not in dirty}
    assert decontam.matches(df, bench.limit(0)).count() == 0 and decontam.clean(df, bench.limit(0)).count() == len(docs) and decontam.matches(df.limit(0), bench).count() == 0
