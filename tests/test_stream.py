"""The streaming job against the closed form, through crashes, replays and late events."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from ledgerline.functions.rules import validate
from ledgerline.operators import aggregate, parity
from ledgerline.operators.dedup import closed_form
from ledgerline.plans import feed
from ledgerline.schema import MERCHANTS
from ledgerline.sources import dead_letters, envelope
from ledgerline.streaming.job import LedgerJob, ReferenceSet, read_log, read_range
from ledgerline.streaming.table import Conflict, VersionedTable

COMPARED = ["transaction_id", "merchant_id", "amount_minor", "currency", "status", "event_type", "lsn", "is_delete"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """The feed as a log of four files, one micro-batch each."""
    path = str(tmp_path_factory.mktemp("log"))
    rows = feed.changes(spark, SF).withColumn("n", F.floor(F.col("offset") / 250_001))
    for n in range(4):
        part = envelope.to_json(envelope.build(rows.filter(F.col("n") == n))).coalesce(1)
        part.write.mode("append").parquet(path)
    return path


def wanted(spark, log):
    """The closed form over the log's files as batches, in the order in which the stream takes them."""
    import glob
    import os

    files = sorted(glob.glob(f"{log}/part-*"), key=os.path.getmtime)
    out = None
    for n, f in enumerate(files):
        raw = spark.read.schema("value binary, partition int, offset long").parquet(f)
        flat = envelope.flatten(envelope.from_json(raw)).withColumn("batch_id", F.lit(n))
        out = flat if out is None else out.union(flat)
    return sorted(closed_form(validate(out, MERCHANTS)[0]).select(*COMPARED).collect(), key=str)


def job(spark, root, **more):
    return LedgerJob(spark, str(root), ReferenceSet(lambda: set(MERCHANTS)), **more)


def state(j):
    return sorted(j.table.read().select(*COMPARED).collect(), key=str)


def test_stream_equals_closed_form_and_replay_changes_nothing(spark, log, tmp_path):
    j = job(spark, tmp_path / "a")
    j.start(read_log(spark, log), str(tmp_path / "ck")).awaitTermination()
    assert state(j) == wanted(spark, log)
    assert j.ledger.read().count() == 4 == len(j.table.batches())
    before = aggregate.digest(parity.live(j.table.read())).collect()
    raw = read_range(spark, log, {p: (0, 10**9) for p in range(3)})
    counts = j.process(raw, 999_999_999, commit=False)
    assert counts["inserted"] == counts["updated"] == 0 and counts["skipped"] == counts["staged"] > 0
    assert aggregate.digest(parity.live(j.table.read())).collect() == before
    assert j.process(raw, 0) is None  # a batch that is committed
    assert j.ledger.read().count() == 4
    feed_rows = j.table.change_feed(first=2)
    assert feed_rows.filter("_commit_version < 2").isEmpty() and not feed_rows.filter("_change_type = 'update_preimage'").isEmpty()
    last = {r["transaction_id"]: r["lsn"] for r in j.table.change_feed().filter("_change_type <> 'update_preimage'").orderBy("_commit_version").collect()}
    assert last == {r["transaction_id"]: r["lsn"] for r in j.table.read().collect()}


@pytest.mark.parametrize("failpoint", ["after_dlq", "after_merge", "after_ledger"])
def test_crash_and_restart(spark, log, tmp_path, failpoint):
    j = job(spark, tmp_path / "a", failpoint=failpoint)
    with pytest.raises(StreamingQueryException):
        j.start(read_log(spark, log, 2), str(tmp_path / "ck")).awaitTermination()
    again = job(spark, tmp_path / "a")
    again.start(read_log(spark, log, 2), str(tmp_path / "ck")).awaitTermination()
    keys = spark.read.parquet(f"{tmp_path}/a/dead_letters").select("key").distinct().count()
    assert keys > 0
    flat = envelope.flatten(envelope.from_json(read_range(spark, log, {p: (0, 10**9) for p in range(3)})))
    valid = validate(flat, MERCHANTS)[0]
    best = {r["transaction_id"]: r["m"] for r in valid.groupBy("transaction_id").agg(F.max("lsn").alias("m")).collect()}
    assert {r["transaction_id"]: r["lsn"] for r in again.table.read().collect()} == best
    assert again.ledger.read().count() == 2
    assert again.table.version() == 2  # also after_merge: the table knows the batch, which isn't merged again


def change(spark, *rows):
    schema = "op string, transaction_id string, amount_minor long, lsn long, offset long"
    told = spark.createDataFrame(list(rows), schema).selectExpr(
        "op", "transaction_id", "'MERCH_001' merchant_id", "amount_minor", "'USD' currency", "'SETTLED' status", "'CAPTURE' event_type",
        "timestamp'2024-01-01' created_at", "timestamp'2024-01-01' updated_at", "lsn", "timestamp'2024-01-01' source_ts", "0 partition", "offset",
    )
    return envelope.to_json(envelope.build(told))


ID = "3f2b8c1e-9d4a-4b6f-8a21-0c5d7e9f1a2b"


def test_late_update_never_revives_a_deleted_row(spark, tmp_path):
    j = job(spark, tmp_path / "a")
    j.process(change(spark, ("c", ID, 1, 100, 1), ("d", ID, 1, 140, 2), ("u", ID, 9999, 120, 3)), 0)
    assert [(r["lsn"], r["is_delete"]) for r in j.table.lookup(ID).collect()] == [(140, True)]
    k = job(spark, tmp_path / "b")
    for n, (row, want) in enumerate([(("c", ID, 1, 200, 1), (200, False)), (("d", ID, 1, 240, 2), (240, True)), (("u", ID, 8888, 220, 3), (240, True))]):
        k.process(change(spark, row), n)
        assert [(r["lsn"], r["is_delete"]) for r in k.table.lookup(ID).collect()] == [want]
    assert k.table.version() == 3 and k.table.read(1).first()["lsn"] == 200


def test_empty_and_undecodable_batches(spark, tmp_path):
    j = job(spark, tmp_path / "a")
    empty = spark.createDataFrame([], "value binary, partition int, offset long")
    assert j.process(empty, 0) is None and j.ledger.read().isEmpty()
    nulls = spark.createDataFrame([(None, 0, 5)], "value binary, partition int, offset long")
    event = j.process(nulls, 1)
    assert event["merged_rows"] == 0 and event["end_offsets"] == {"0": 6} and j.ledger.read().count() == 1
    bad = spark.createDataFrame([(b"garbage", 0, 6)], "value binary, partition int, offset long")
    assert j.process(bad, 2)["dlq_rows"] == 1
    letter = spark.read.parquet(f"{tmp_path}/a/dead_letters").first()
    assert "INVALID_UUID,UNKNOWN_MERCHANT" in letter["value"]


def test_rejected_rows_heal_once_the_reference_is_fixed(spark, tmp_path):
    known = {"MERCH_009"}
    refs = ReferenceSet(lambda: set(known), ttl=0)
    j = LedgerJob(spark, str(tmp_path / "a"), refs)
    raw = change(spark, ("c", ID, 1, 100, 1))
    assert j.process(raw, 0)["dlq_rows"] == 1
    letters = dead_letters.parse(spark.read.parquet(f"{tmp_path}/a/dead_letters").withColumn("offset", F.lit(0).cast("long")))
    assert dead_letters.replay_class(letters, j.table.read(), ["MERCH_001"]).first()["replay_class"] == "REPLAYABLE"
    known.add("MERCH_001")
    j.process(raw, 1)
    assert j.table.read().count() == 1
    assert dead_letters.replay_class(letters, j.table.read(), ["MERCH_001"]).first()["replay_class"] == "ALREADY_APPLIED"


def test_two_writers_conflict_and_the_loser_merges_on_top(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    flat = envelope.flatten(envelope.from_json(change(spark, ("c", ID, 1, 100, 1))))
    t.merge(flat)
    m = t.manifest()
    with pytest.raises(Conflict):
        t._publish(m)
    stale = t.manifest
    calls = []

    def lagging(version=None):
        calls.append(version)
        return stale(0) if len(calls) == 1 else stale(version)

    t.manifest = lagging
    counts = t.merge(envelope.flatten(envelope.from_json(change(spark, ("u", ID, 2, 101, 2)))))
    assert counts["updated"] == 1 and t.version() == 2 and [r["counts"] for r in t.history().orderBy("version").collect()]


def test_reference_set(spark):
    now, fail = [0.0], [False]

    def load():
        if fail[0]:
            raise OSError("down")
        return {"a"}

    refs = ReferenceSet(load, ttl=120, clock=lambda: now[0])
    assert refs.keys() == ["a"]
    fail[0], now[0] = True, 500
    assert refs.keys() == ["a"]
    with pytest.raises(OSError):
        ReferenceSet(load).keys()
    with pytest.raises(ValueError, match="empty"):
        ReferenceSet(set).keys()


def keyed(spark, first, last, lsn):
    return spark.range(first, last).selectExpr("cast(id as string) transaction_id", f"id * 10 + {lsn} amount_minor", f"cast({lsn} as long) lsn", "false is_delete")


SMALL = "transaction_id string, amount_minor long, lsn long, is_delete boolean"


def test_buckets_grow_with_the_table(spark, tmp_path):
    schema = spark.createDataFrame([], SMALL).schema
    t = VersionedTable(spark, str(tmp_path / "t"), schema, depth=1, split=60)
    want = {}
    for n, (a, b) in enumerate([(0, 40), (20, 300), (300, 310), (0, 5), (250, 700)]):
        counts = t.merge(keyed(spark, a, b, n + 1), now=100 + n)
        fresh = sum(str(k) not in want for k in range(a, b))
        assert counts == {"staged": b - a, "inserted": fresh, "updated": b - a - fresh, "skipped": 0}
        want |= {str(k): k * 10 + n + 1 for k in range(a, b)}
        assert {r["transaction_id"]: r["amount_minor"] for r in t.read().collect()} == want
        m = t.manifest()
        assert sum(rows for _, rows in m.buckets.values()) == len(want) and max(rows for _, rows in m.buckets.values()) <= 2 * 60
        covered = sorted(v + (k << d) for name in m.buckets for d, v in [map(int, name.split("x"))] for k in range(1 << (m.depth - d)))
        assert covered == sorted(set(covered))  # no key has two buckets
    assert t.manifest().depth >= 4 and t.row("3")["lsn"] == 4 and t.row("699")["lsn"] == 5 and t.row("nobody") is None
    assert len(t.read(2).collect()) == 300
    before = t.manifest().buckets
    t.merge(keyed(spark, 1, 2, 9))
    assert sum(before.get(b) != x for b, x in t.manifest().buckets.items()) == 1  # one key: one bucket


def test_one_row_of_a_key_or_an_error(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SMALL).schema)
    t.merge(keyed(spark, 1, 2, 1).union(keyed(spark, 1, 2, 1)))  # against merge's promise
    with pytest.raises(ValueError, match="not unique"):
        t.row("1")


def test_log_is_condensed(spark, tmp_path, monkeypatch):
    from ledgerline.streaming import table

    monkeypatch.setattr(table, "LOG_EVERY", 2)
    t = VersionedTable(spark, str(tmp_path / "t"), spark.createDataFrame([], SMALL).schema)
    for n in range(5):
        t.merge(keyed(spark, n, n + 2, n + 1), ["a", "q", n], now=n)
    opened, real = [], t._load
    t._load = lambda name: opened.append(name) or real(name)
    assert [m["version"] for m in t.log()] == [1, 2, 3, 4, 5] and opened == ["log-4.json", "5.json"]
    assert t.batches().keys() == {("a", "q", n) for n in range(5)} and t.batches()["a", "q", 0]["inserted"] == 2
    assert [r["committed_at"] for r in t.history().orderBy("version").collect()] == [0, 1, 2, 3, 4]
    assert t.change_feed(since=3).select("_commit_version").distinct().count() == 2
    (tmp_path / "t" / "_manifest" / "log-4.json").unlink()
    assert len(t.log()) == 5


def test_a_store_without_atomic_rename_is_refused(spark):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.har.impl", "org.apache.hadoop.fs.HarFileSystem")
    with pytest.raises(Exception, match="no atomic rename|Invalid"):
        VersionedTable(spark, "har:///nowhere.har/t")


def test_ledger_probes_one_block(spark, tmp_path, monkeypatch):
    from ledgerline.streaming import job as jobs

    monkeypatch.setattr(jobs, "BLOCK", 3)
    done = jobs.Ledger(spark, str(tmp_path / "l"))
    assert not done.has("a", "q", 0) and done.read().isEmpty()
    for n in (0, 1, 2, 3, 5):
        done.add("a", "q", n, 7)
    done.add("a", "other", 4, 7)
    assert [done.has("a", "q", n) for n in range(7)] == [True, True, True, True, False, True, False] and not done.has("b", "q", 1) and done.has("a", "other", 4)
    block = done._folder("a", "q", 0)
    import os

    assert len([f for f in os.listdir(block) if f.startswith("part-")]) == 1  # a full block is one file
    done.add("a", "q", 1, 8)  # a crash may enter a batch twice
    assert done.read().count() == 6


def test_gauges_fail_open(spark, tmp_path):
    sent = []
    j = job(spark, tmp_path / "a", push=sent.append)
    j.process(change(spark, ("c", ID, 1, 100, 1)), 0)
    assert "ledger_input_rows 1\n" in sent[0] and 'ledger_processed_offset{partition="0"} 2' in sent[0] and sent[0].count("\n") == 8

    def down(text):
        raise OSError("no route")

    j.push = down
    assert j.process(change(spark, ("u", ID, 2, 200, 2)), 1)["updated"] == 1 and j.ledger.has("ledgerline", "default", 1)


def test_stops_on_a_signal(spark, log, tmp_path):
    import os
    import signal
    import threading

    j = job(spark, tmp_path / "a")
    threading.Timer(4, os.kill, (os.getpid(), signal.SIGTERM)).start()
    j.run(read_log(spark, log), str(tmp_path / "ck"), interval="1 seconds")
    assert not spark.streams.active and signal.getsignal(signal.SIGTERM) == signal.SIG_DFL
    rest = job(spark, tmp_path / "a")
    rest.run(read_log(spark, log), str(tmp_path / "ck"))  # goes on where it stopped, to the end
    assert state(rest) == wanted(spark, log) and rest.ledger.read().count() == 4
