"""Language ID, toxicity, WARC, token counts and packing."""

import base64
import gzip
import hashlib
import math
import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import langid, packing, tokencount, toxicity, warc
from ledgerline.llm.common import stash
from ledgerline.llm.queries import word_tokenizer

SF = "/root/testdata/sf0.01"


def test_language_id_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predict(docs.withColumn("lang_pred", F.lit("clash"))).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"), F.count(F.lit(1)).alias("n")).first()
    assert held["n"] > 150 and held["a"] > 0.98
    assert got.count() == 1000 and got.filter("score < 0 or score > 1").isEmpty()
    wrong = docs.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)).withColumn("lang", F.lit("zz"))
    assert "zz" not in {v for f in langid.fit(docs.union(wrong.select(*docs.columns))).languages.values() for v in f}  # held-out labels aren't seen


def test_language_id_edges(spark):
    en, de, xx = "the cat and the dog with this ", "der hund und die katze mit ", "zorg blip blop quux "
    rows = [(i, t * 5, v) for i, (t, v) in enumerate([(en, "en"), (de, "de"), (xx, "xx")] * 12)]
    rows += [(100, None, "en"), (101, "", None), (102, "123 !? ١ ½² Ⅷ ①", None), (103, "the dog and the cat " * 20_000, None), (None, en, "en"), (0, en, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("_p", F.lit(1))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(df).collect()}
    assert got[100] == got[101] == got[102] == ("und", 0.0) and got[103][0] == "en" and got[1][0] == "de" and got[2][0] == "xx" and got[None][0] == "en"
    assert langid.keep_known(df).count() == len(rows) - 3 and langid.keep_known(df).columns == df.columns
    assert {r["lang_pred"] for r in langid.predict(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.predict(df.limit(0)).count() == 0


def test_letters():
    model = langid.Model.fit(np.stack([langid.features(b"the cat"), langid.features(b"der hund")]), ["en", "de"], {})
    for text in ("½²", "Ⅷ", "①", "½ 12", "_", "١", "é́".replace("é", "")):
        assert model.predict(text.encode()) == ("und", 0.0)
    for text in ("ª", "ß", "語", "1x"):
        assert model.predict(text.encode())[0] in ("en", "de")


def plain_prediction(model, text):
    """Family and votes with dictionaries and loops."""
    text = text or ""
    if not any(unicodedata.category(c).startswith("L") for c in text):
        return "und", 0.0
    folded = [b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in b" " + text.encode() + b" "]
    found = {}
    for a, b, c in zip(folded, folded[1:], folded[2:]):
        if b != 32:
            at = ((((a << 16) | (b << 8) | c) * 2654435761) % (1 << 32)) >> 20
            found[at] = found.get(at, 0) + 1
    size = math.sqrt(sum(found.values()))
    x = {k: math.sqrt(v) / size for k, v in found.items()}
    dot = lambda w, b: b + sum(v * float(w[k]) for k, v in x.items())
    margins = [dot(model.family_w[:, i], float(model.family_b[i])) for i in range(len(model.families))]
    best = margins.index(max(margins))
    score = 1 / (1 + math.exp(-4 * margins[best]))
    langs = model.languages[model.families[best]]
    wins, sums, least = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0), dict.fromkeys(langs, 1.0)
    k = 0
    for i, a in enumerate(langs):
        for b in langs[i + 1 :]:
            w, bias = model.pairs[model.families[best]]
            m = dot(w[:, k], float(bias[k]))
            k += 1
            wins[a if m >= 0 else b] += 1
            sums[a] += m
            sums[b] -= m
            least[a] = min(least[a], 1 / (1 + math.exp(-4 * m)))
            least[b] = min(least[b], 1 / (1 + math.exp(4 * m)))
    win = max(langs, key=lambda v: (wins[v], sums[v]))
    return win, score * least[win]


def test_language_id_against_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    for families in (None, {v: "all" for v in ("en", "de", "fr", "es")}):
        model = langid.fit(docs, families)
        got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
        assert len(got) == len(rows)
        for r in rows:
            lang, score = plain_prediction(model, r["text"])
            assert got[r["doc_id"]]["lang_pred"] == lang and abs(got[r["doc_id"]]["score"] - score) < 1e-4
            assert got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_fit_learns_one_row_of_an_id_and_few_rows_of_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_ROWS", 12)
    seen = []
    monkeypatch.setattr(langid.Model, "fit", staticmethod(lambda x, langs, families: seen.append(langs)))
    rows = [(i % 50, f"text {i}", f"l{i % 3}") for i in range(600)] + [(1, "zz text", "l1")] * 9
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(seen[0]) == 12 and {seen[0].count(v) for v in set(seen[0])} == {4}


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.predict(docs, labels).filter("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    y, s = got["toxic"].to_numpy(), got["score"].to_numpy()
    assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.96
    assert (got["predicted"][y == 1].mean() > 0.75) and got["predicted"][y == 0].mean() < 0.02


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(i, ("you idiot! " if i % 3 == 0 else "nice day ") + f"w{i % 7}") for i in range(300)] + [(900, None), (901, ""), (None, "IDIOT"), (0, "x " * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(5, None), (None, 1), (3, 0), (3, 1)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    got = toxicity.predict(docs, labels).collect()
    assert len(got) == 304 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert by[None] == 1 and by[900] == by[901] and by[299] == 0
    assert {r["score"] for r in toxicity.predict(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.predict(docs.limit(0), labels).count() == 0


def plain_toxicity(docs, labels, dimensions=1 << 20):
    """Features, FTRL-proximal and scores with dictionaries and loops; weights and scores."""
    mask = (1 << 64) - 1
    a, b = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

    def features(text):
        words = "".join(c.lower() if c.isascii() and c.isalpha() else c if not c.isascii() or c.isdigit() else " " for c in text or "").encode().split()
        h = [((zlib.crc32(w) << 32) | zlib.crc32(w, 0x5BD1E995)) * a & mask for w in words]
        found = set(h)
        found |= {(x * a + y) & mask for x, y in zip(h, h[1:])}
        found |= {((x ^ b) * a + y) & mask for x, y in zip(h, h[2:])}
        return {(x * b & mask) >> 44 for x in found}

    toxic = {}
    for i, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            toxic[i] = max(toxic.get(i, 0), y)
    texts = {}
    for i, t in docs:
        if i in toxic:
            texts[i] = min(x for x in (texts.get(i), t) if x is not None) if t is not None or i in texts else None
    z, n = {}, {}
    weight = lambda k: (
        0.0 if abs(z.get(k, 0.0)) <= (0 if k == dimensions else toxicity.L1)
        else -(z[k] - math.copysign(0 if k == dimensions else toxicity.L1, z[k])) / (toxicity.BETA + math.sqrt(n[k])) * toxicity.ALPHA
    )
    logistic = lambda m: 1 / (1 + math.exp(-min(30, max(-30, m))))
    return toxic, texts, features, z, n, weight, logistic


def test_toxicity_against_loops(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(r.choice(words) for _ in range(r.randrange(30))) + (" you idiot, go away" if i % 4 == 0 else "")) for i in range(240)]
    docs += [(5, "AAA smaller text"), (7, None), (None, "idiot"), (900, None), (901, "you idiot go away")]
    labels = [(i, int(i % 4 == 0)) for i in range(240)] + [(6, None), (None, 1), (9, 1)]
    df, known = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    toxic, texts, features, z, n, weight, logistic = plain_toxicity(docs, labels)
    place = {x["doc_id"]: x["h"] for x in known.select("doc_id", F.xxhash64(F.lit("toxicity"), F.col("doc_id")).alias("h")).collect()}
    for _ in range(toxicity.EPOCHS):
        for i in sorted(texts, key=place.__getitem__):
            x = [*features(texts[i]), 1 << 20]
            w = {k: weight(k) for k in x}
            g = logistic(sum(w.values())) - toxic[i]
            for k in x:
                sigma = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / toxicity.ALPHA
                z[k] = z.get(k, 0.0) + g - sigma * w[k]
                n[k] = n.get(k, 0.0) + g * g
    got = dict(toxicity.fit(df, known))
    want = {k: weight(k) for k in z if weight(k)}
    assert got.keys() == want.keys() and len(got) > 5 and all(abs(got[k] - want[k]) < 1e-6 for k in got)
    scores = sorted((str(d["doc_id"]), round(d["score"], 4), d["predicted"], d["held_out"]) for d in toxicity.predict(df, known).collect())
    plain = [(i, logistic(sum(want.get(k, 0.0) for k in [*features(t), 1 << 20]))) for i, t in docs]
    assert scores == sorted((str(i), round(s, 4), int(s >= 0.3), i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, s in plain)


def test_ftrl_is_sparse_and_finds_the_signal():
    r = np.random.default_rng(1)
    examples = [np.unique(r.integers(10, 5000, 60)) for _ in range(600)]
    y = [int(i % 5 == 0) for i in range(600)]
    examples = [np.append(x, 3) if t else x for x, t in zip(examples, y)]
    w = toxicity.ftrl(examples, y, dimensions=5000)
    assert w[:-1].argmax() == 3 and (w != 0).sum() < 500


def brute_warc(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        low = first.get(h or "")
        revisit = low is not None and i != low
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", low if revisit else None))
    return sorted(out, key=str)


def test_warc_round_trip(spark):
    r = random.Random(2)
    rows = [(i, f"http://x.com/{i}", r.choice(["<p>é</p>\r\n\r\nWARC/1.1", "same", None, "", f"own {i}", "long " * 50_000])) for i in range(60)]
    rows += [(7, "http://twice", rows[7][2]), (None, None, "same"), (None, "http://a b\r\nX: y", "only null ids"), (61, None, "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit(1)).repartition(4)
    folder, index = warc.write(pages)
    got = warc.read(spark, folder, index, with_payload=True).collect()
    assert sorted((tuple(x)[:5] for x in got), key=str) == brute_warc(rows)
    payloads = {x["page_id"]: bytes(x["payload"]) for x in got if x["record_type"] == "response" and x["page_id"] is not None}
    assert all(payloads[i] == (h or "").encode() for i, _, h in rows if i in payloads)
    some = warc.read(spark, folder, index.filter("page_id % 9 = 4"), gap=0, most=1000)
    assert {x["page_id"] for x in some.collect()} == {i for i in range(62) if i % 9 == 4}
    one = index.filter("page_id = 11").first()
    with open(f"{folder.removeprefix('file://')}/{one['file']}", "rb") as f:
        f.seek(one["offset"])
        head = gzip.decompress(f.read(one["length"]))
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: re") and head.endswith(b"\r\n\r\n") and b"WARC-Target-URI: http://x.com/11\r\n" in head
    assert warc.read(spark, *warc.write(pages.limit(0))).count() == 0


def test_warc_many_shared_payloads_and_parts(spark, monkeypatch):
    rows = [(i, f"http://x.com/{i}", f"page {i % 40}" if i % 3 else f"own {i} " + hashlib.sha1(b"%d" % i).hexdigest() * 200) for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    monkeypatch.setattr(warc, "BROADCAST_ROWS", 3)
    folder, index = warc.write(pages)
    monkeypatch.setattr(warc, "MOST_READ", 16 << 10)
    got = warc.read(spark, folder, index)
    size = index.agg(F.sum("length")).first()[0]
    per_task = got.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert len(per_task) > 3 and len(per_task) >= size // (16 << 10) // 2
    assert sorted((tuple(x)[:5] for x in got.collect()), key=str) == brute_warc(rows)


def test_warc_threshold_and_damage(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = {r["page_id"]: r["refers_to"] for r in warc.read(spark, *warc.write(pages, min_bytes=3)).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(warc.record(1, "u", b"abc", warc.sha1_base32(b"abd"), None, "2024-01-01T00:00:00Z"))


@pytest.fixture(scope="module")
def pieces_tools():
    import regex

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokencount.PieceCounts(path, public_tokenizers.PATTERN), regex.compile(public_tokenizers.PATTERN)


def test_edits_equal_counting_again(pieces_tools):
    counts, pattern = pieces_tools
    r = random.Random(1)
    letters = " \n\t 'srelvtdm1a,!é漢"
    make = lambda n: "".join(r.choice(letters) for _ in range(n))
    for _ in range(500):
        text = make(r.choice([0, 3, 50, 900, 2500]))
        tree = tokencount.Tree.build(text, pattern.findall, counts)
        for _ in range(3):
            cuts = sorted(r.randint(0, len(text)) for _ in range(2 * r.choice([1, 1, 2, 5, 20])))
            edits = [(a, min(b, a + r.choice([0, 1, 7, 500])), make(r.choice([0, 1, 3, 400]))) for a, b in zip(cuts[::2], cuts[1::2])]
            want = text
            for a, b, new in reversed(edits):
                want = want[:a] + new + want[b:]
            text, _ = tree.edit(text, edits, pattern, counts)
            assert text == want and (tree.total, tree.chars[1]) == (sum(map(counts.__getitem__, pattern.findall(text))), len(text))
            assert all(tree.chars[i] == tree.chars[2 * i] + tree.chars[2 * i + 1] and tree.tokens[i] == tree.tokens[2 * i] + tree.tokens[2 * i + 1] for i in range(1, tree.size))


def test_an_edit_touches_its_region_alone(pieces_tools):
    counts, pattern = pieces_tools
    text = " ".join(f"word{i}" for i in range(5000))
    tree = tokencount.Tree.build(text, pattern.findall, counts)
    text, encoded = tree.edit(text, [(20_000, 20_004, "other"), (30_000, 30_001, "x")], pattern, counts)
    assert encoded < 8 * tokencount.LEAF
    text, _ = tree.edit(text, [(20_000, 20_000, " and more words" * 5000)], pattern, counts)
    assert max(tree.tokens[tree.size :]) < 8 * tokencount.LEAF  # a long insertion gets leaves of its own
    assert tree.edit(text, [(40_000, 40_003, "y")], pattern, counts)[1] < 4 * tokencount.LEAF
    with pytest.raises(ValueError, match="overlap"):
        tree.edit(text, [(0, 3, ""), (2, 4, "")], pattern, counts)


def test_recount(spark, pieces_tools):
    counts, pattern = pieces_tools
    texts = [(1, "mail a.b@example.org or call +49 30 1234567, thanks http://a.b/c\n\n\n\nx"), (2, None), (3, ""), (4, "word " * 30_000 + "x@y.zz"), (1, "no edit"), (None, "deadbeef" * 5)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumns({"n_tokens": F.lit("clash"), "__c": F.lit(1)})
    path, p = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    n = lambda x: sum(map(counts.__getitem__, pattern.findall(x or "")))
    kept = tokencount.trees(df, path, p)
    for find in (tokencount.redactions, tokencount.tidyings):  # the second round starts from the first one's texts and trees
        after, want = [], []
        for i, t in texts:
            x = t
            for a, b, new in reversed(find(t or "")):
                x = x[:a] + new + x[b:]
            after.append((i, x))
            want.append((i, x, n(t), len(find(t or "")), n(x)))
        kept = tokencount.recount(kept.withColumn("edits", tokencount.edit_finder(find)("text")), path, p)
        got = kept.collect()
        assert sorted(((r["doc_id"], r["text"], r["n_tokens"], r["n_edits"], r["n_tokens_after"]) for r in got), key=str) == sorted(want, key=str)
        assert all((r["n_pretokens_encoded"] > 0) == (r["n_edits"] > 0) and r["n_pretokens_encoded"] < 700 and r["tree"]["tokens"][1] == r["n_tokens_after"] and r["__c"] == 1 for r in got)
        texts = after
    assert sum(x != y for (_, x), (_, y) in zip(texts, df.select("doc_id", "text").collect())) == 3
    assert tokencount.recount(kept.withColumn("edits", tokencount.edit_finder()("text")).limit(0), path, p).count() == 0
    null_edit = spark.createDataFrame([(1, "abc", [None, (1, 2, None)])], "doc_id long, text string, edits array<struct<start: int, stop: int, text: string>>")
    assert tokencount.recount(tokencount.trees(null_edit, path, p), path, p).first()["text"] == "ac"


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(word_tokenizer())
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts}
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
    for i, own in by_doc.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and sum(r["length"] for r in own) == len(ids[i])
        assert all(r["length"] == capacity for r in own[:-1])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert by_doc.keys() == ids.keys()
    total = sum(map(len, ids.values()))
    assert len(by_sequence) <= 1.02 * total / capacity + 2


def test_packing(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 400").collect()]
    texts += [(1000, None), (1001, ""), (1002, "Σίσυφος it's <|endoftext|> x y Çà " * 3000), (1003, "'LL 'Re 're's ½²x ß" * 9)]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("offset", F.lit("clash"))
    check_packing(packing.pack(df, word_tokenizer()).collect(), texts, 4096)
    check_packing(packing.pack(df, word_tokenizer(), capacity=300).collect(), texts, 300)
    assert packing.pack(df.limit(0), word_tokenizer()).count() == 0
    twice = packing.pack(df.filter("doc_id < 2").union(df.filter("doc_id < 2")), word_tokenizer()).collect()
    assert len(twice) == 4 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 4


def test_shards_do_not_collide(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 50)
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 300").collect()]
    rows = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), word_tokenizer()).collect()
    used = {}
    for r in rows:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 4096 and len(rows) >= 300


def test_shards_are_even(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 40)
    for n, parts in ((2000, 100), (1999, 7), (30, 90), (1, 1)):
        cut = stash(spark.range(n).repartition(parts), "test-cut")
        shards, dealt = packing.deal(cut)
        sizes = [r["n"] for r in dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert shards == -(-n // 40) and sum(sizes) == n and len(sizes) == shards and max(sizes) <= 40 and max(sizes) - min(sizes) <= 1
    assert packing.deal(spark.range(0))[0] == 1


def test_other_tokenizers_encode_whole_texts(tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(word_tokenizer(), encoding="utf-8") as f:
        told = json.load(f)
    told["normalizer"]["normalizers"] = told["normalizer"]["normalizers"][:2]  # keeps upper case
    other = tmp_path / "other.json"
    other.write_text(json.dumps(told), encoding="utf-8")
    text = "Hello WORLD, it's Änder 12 <|endoftext|> x"
    for path in (word_tokenizer(), str(other)):
        want = np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert packing.ChunkEncoder(path).encode(text) == want
    assert packing.ChunkEncoder(word_tokenizer()).chunked and not packing.ChunkEncoder(str(other)).chunked


def test_large_items_pair_at_most_twice():
    lengths = [70, 60, 55, 45, 41, 40, 36, 35, 20, 10, 9, 1]
    sequence, offset = packing.pack_lengths(lengths, 100)
    for s in set(sequence):
        own = [lengths[i] for i in range(len(lengths)) if sequence[i] == s]
        assert sum(own) <= 100 and sum(x > 33 for x in own) <= 2
    assert len(set(sequence)) == 5
    assert packing.pack_lengths([], 10) == ([], [])
    assert packing.pack_lengths([10, 10], 10)[0] == [0, 1]
