"""URL filters and quality rules."""

import random

from pyspark.sql import functions as F

from ledgerline.llm import quality, urlfilter
from ledgerline.llm.queries import URL_RULES


def pages(spark, *urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[2:]) if fits else (host, path, None, "allow")


def test_judge_equals_brute_force(spark):
    r = random.Random(3)
    hosts = ["com", "example.com", "www.EXAMPLE.com", "notexample.com", "a.net", "example.net", "x.example.net", "org", "a.b.c.org", "com.", "", "example.com:80", "ÉX.com", ".com"]
    paths = ["", "/", "/en", "/en/", "/en/7", "/en/71", "/de/8", "/de/9", "/es/", "?q=/en/", "#/en/", "/EN/7", "/en/7?x", "/de/8#top", "/en/\n7"]
    urls = [None, "", "example.com/en/7", "://com/en/", *(f"{r.choice(['http', 'HTTPS', ''])}://{h}{p}" for h in hosts for p in paths)]
    got = urlfilter.judge(pages(spark, *urls).withColumn("verdict", F.lit(1)), URL_RULES).orderBy("page_id").collect()
    assert [tuple(x)[1:] for x in got] == [brute(u) for u in urls]
    assert urlfilter.judge(pages(spark, "x").limit(0), URL_RULES).count() == 0


def test_joined_way_gives_the_same(spark, monkeypatch):
    urls = ["http://a.com/en/1", "http://example.com/en/7", "http://q.net/de/8", "http://example.net/de/8", "http://b.org/x", None, "http://a.com/en/1"]
    want = urlfilter.judge(pages(spark, *urls), URL_RULES).orderBy("page_id").collect()
    monkeypatch.setattr(urlfilter, "MAX_LISTED", 1)
    assert urlfilter.judge(pages(spark, *urls), URL_RULES).orderBy("page_id").collect() == want


def test_rules_of_equal_length(spark, monkeypatch):
    rules = [("block", "a.b", ""), ("allow", "b", "/x"), ("block", "c", "/yy"), ("allow", "b.c", "/y")]
    urls = ["http://a.b/x", "http://q.b/x", "http://b.c/yy", "http://d.c/yy"]
    want = [("a.b", "block"), ("b/x", "allow"), ("b.c/y", "allow"), ("c/yy", "block")]
    for most in (urlfilter.MAX_LISTED, 1):
        monkeypatch.setattr(urlfilter, "MAX_LISTED", most)
        assert [(r["rule"], r["verdict"]) for r in urlfilter.judge(pages(spark, *urls), rules).orderBy("page_id").collect()] == want


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(3000).select(F.concat(F.lit("host-"), F.col("id").cast("string")).alias("key"))
    listed = universe.filter(F.xxhash64("key") % 5 == 0)
    cascade = urlfilter.Cascade.build(listed, universe, error=0.2)
    assert len(cascade.levels) > 2
    wrong = universe.filter(cascade.has(F.col("key")) != (F.xxhash64("key") % 5 == 0))
    assert wrong.count() == 0
    assert urlfilter.Cascade.build(listed.limit(0), universe).levels == []


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, text string, lang string, source string")


def test_counts():
    words = b"a b c d e f g h".split()
    assert quality.repeated_words(words) == 0 and quality.repeated_words(words * 2) == 16
    assert quality.repeated_words(words + [b"x"] + words + [b"y"]) == 16
    assert quality.repeated_words([b"w"] * 9) == 9 and quality.repeated_words([b"w"] * 8) == 0
    assert quality.counts(None) == (0, 0, 0, 0, 0, 0) == quality.counts(b" \n\t ")
    n_words, chars, symbols, dup, _, lines = quality.counts("é# |\nx\n \nx\n\x0b\x85y".encode())
    assert (n_words, chars, symbols, dup, lines) == (5, 7, 2, 1, 4)


def test_repeated_words_against_brute_force():
    r = random.Random(5)
    for _ in range(300):
        words = [bytes([97 + r.randrange(r.choice([1, 2, 6]))]) for _ in range(r.randrange(40))]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
        assert quality.repeated_words(words) == len(hit)


def test_thresholds_adapt(spark):
    prose = lambda n, extra="": " ".join(f"word{i}x{n}" for i in range(40)) + extra
    rows = [(i, prose(i), "en", "a") for i in range(60)] + [(100 + i, prose(i, " |" * 12), "en", "b") for i in range(60)]
    rows += [(900, prose(1, " |" * 12), "en", "a"), (901, "too short", "en", "a"), (902, None, None, None), (903, prose(2), None, None), (903, prose(2), None, None)]
    got = {}
    for r in quality.judge(docs(spark, *rows).withColumn("kept", F.lit("x"))).collect():
        got.setdefault(r["doc_id"], []).append((r["base_failed"], r["kept"]))
    assert got[900] == [(False, False)]  # an outlier in source a, ordinary in b
    assert all(got[i] == [(False, True)] for i in (*range(60), *range(100, 160)))
    assert got[901] == got[902] == [(True, False)] and got[903] == [(False, True)] * 2
    assert quality.judge(docs(spark, (1, "x", "en", "a")).limit(0)).count() == 0


def test_metrics_have_thresholds_of_their_own(spark):
    """Over the 80 groups of the 0.1 tables, no bound is a constant, and three metrics' take more than ten values."""
    measured = quality.measure(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    limits = quality.bounds(quality.sketches(measured)).collect()
    distinct = {c: len({r[c] for r in limits}) for c in limits[0].asDict() if c not in ("lang", "source")}
    assert len(limits) == 80 and sum(n > 10 for n in distinct.values()) >= 3 and min(distinct.values()) > 4, distinct


def test_bounds_by_hand(spark):
    sketch = [("en", "a", "dup_lines", b, n) for b, n in ((0, 980), (100, 11), (200, 9))]  # the 0.99 quantile
    sketch += [("en", "a", "word_length", b, n) for b, n in ((4000, 300), (5000, 400), (5200, 290), (9000, 10))]  # fences: 4000 - 3 * 1200, 5200 + 3 * 1200
    sketch += [("en", "b", "dup_lines", 300, 49)]  # too few: the language's sketch, 1049 values
    got = {r["source"]: r for r in quality.bounds(spark.createDataFrame(sketch, "lang string, source string, metric string, bucket long, n long")).collect()}
    assert (got["a"]["high_dup_lines"], got["a"]["low_word_length"], got["a"]["high_word_length"]) == (100, 400, 8800)
    assert got["b"]["high_dup_lines"] == 300 and got["b"]["high_word_length"] is None


def test_sketches_merge(spark):
    values = spark.range(10_000).select((F.col("id") * F.col("id") % 7919).alias("v"))
    rank = lambda x: values.filter(F.col("v") <= x).count() / 10_000
    sketch = values.select(F.lit("en").alias("lang"), (F.col("v") % 3).alias("source"), F.lit("m").alias("metric"), quality.bucket(F.col("v")).alias("bucket"))
    sketch = sketch.groupBy("lang", "source", "metric", "bucket").agg(F.count(F.lit(1)).alias("n"))
    one = quality.quantiles(sketch, ["lang"]).first()
    assert one["total"] == 10_000 and abs(rank(one["q1"] * 33 // 32) - 0.25) < 0.03 and abs(rank(one["q3"] * 33 // 32) - 0.75) < 0.03
