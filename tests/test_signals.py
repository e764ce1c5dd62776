"""Signals against the figures that their definitions give."""

import json

from pyspark.sql import functions as F

from ledgerline.functions import signals
from ledgerline.operators import aggregate


def test_parity_badge(spark):
    cases = [  # source, lake, quarantined, rate, p95, drained: allowed is rate * p95 * 1.5, rounded up
        ((500, 470, 6, 4.0, 4.0, False), (24, 24, "in_sync")),
        ((500, 469, 6, 4.0, 4.0, False), (25, 24, "catching_up")),
        ((469, 500, 0, 4.0, 4.0, False), (-31, 24, "catching_up")),
        ((7, 7, 0, 0.5, 0.5, False), (0, 1, "in_sync")),
        ((7, 6, 0, -3.0, 9.0, False), (1, 0, "catching_up")),
        ((7, 6, 0, 9.0, 9.0, True), (1, 122, "mismatch")),
        ((7, 4, 3, 0.0, 0.0, True), (0, 0, "in_sync")),
        ((7, None, 3, 2.0, 1.0, True), (None, 3, "unknown")),
    ]
    df = spark.createDataFrame([(i, *c) for i, (c, _) in enumerate(cases)], "i int, s long, l long, q long, r double, p double, d boolean")
    got = df.select("i", signals.parity_badge(*(F.col(c) for c in "slqrpd")).alias("b")).orderBy("i").collect()
    assert [tuple(r["b"]) for r in got] == [w for _, w in cases]


def test_percentiles(spark):
    rows = spark.range(1, 41).selectExpr("cast(id * 0.25 as double) v", "id % 2 g")
    assert tuple(signals.nearest_rank(rows, "v", {"a": 0.5, "b": 0.9, "c": 0.01}).first()) == (5.0, 9.0, 0.25)
    assert tuple(signals.nearest_rank(rows.limit(0), "v", {"a": 0.5}).first()) == (0.0,)
    by = signals.nearest_rank(rows.groupBy("g"), "v", {"a": 0.5}, F.count(F.lit(1)).alias("n")).collect()
    assert {tuple(r) for r in by} == {(0, 20, 5.0), (1, 20, 4.75)}


def samples(spark, *rows):
    return spark.createDataFrame([("a", t, v) for t, v in rows], "series string, t long, v long")


def test_rates(spark):
    at = lambda df, c: {r["t"]: r[c] for r in df.collect()}
    counter = samples(spark, (3, 10), (5, 16), (9, 40), (16, 12), (17, 30))
    assert at(signals.rate(counter, 6), "rate") == {3: 0.0, 5: 3.0, 9: 5.0, 16: 0.0, 17: 18.0}  # 16 stands alone; 17 counts from 16
    assert at(signals.rate(counter, 8), "rate") == {3: 0.0, 5: 3.0, 9: 5.0, 16: 0.0, 17: 0.0}  # it fell since 9
    assert at(signals.moving_sum(counter, 12), "per_second") == {3: 10 / 12, 5: 26 / 12, 9: 66 / 12, 16: 68 / 12, 17: 98 / 12}
    assert at(signals.growth(counter, 11), "growth") == {3: 0, 5: 6, 9: 30, 16: -4, 17: -10}


def test_lag(spark):
    part = lambda **k: spark.createDataFrame([(int(p[1:]), v) for p, v in k.items()], "partition int, processed long")
    ends = part(p0=50, p4=8, p7=90, p9=3).withColumnRenamed("processed", "end_offset")
    got = signals.consumer_lag(ends, part(p0=44, p7=95), part(p0=50, p4=1)).orderBy("partition").collect()
    assert [(r["partition"], r["processed"], r["lag"]) for r in got] == [(0, 44, 6), (4, 1, 7), (7, 95, 0), (9, 0, 3)]


def test_metrics_text(spark):
    lines = ['done{partition="11",host="a"} 42', 'done{partition="3"}   2E2', 'done_sum{partition="1"} 5', 'not_done{partition="1"} 5', "# TYPE done gauge", 'done{partition="6"} many', 'done{host="a"} 5', ""]
    got = signals.metrics_text(spark.createDataFrame([(x,) for x in lines], "line string"), "done").collect()
    assert {(r["partition"], r["value"]) for r in got} == {(11, 42), (3, 200)}


def test_connector_state(spark):
    body = lambda c, *t: json.dumps({"connector": {"state": c}, "tasks": [{"state": x} for x in t]})
    rows = [(1, 200, body("RUNNING", "RUNNING")), (2, 200, body("RUNNING", "RUNNING", "FAILED")), (3, 200, body("PAUSED", "RUNNING")), (4, 404, ""), (5, 500, ""), (6, 200, "nonsense"), (7, 200, body("RUNNING"))]
    got = signals.connector_state(spark.createDataFrame(rows, "id int, http_status int, body string")).orderBy("id").collect()
    assert [r["state"] for r in got] == ["RUNNING", "FAILED", "PAUSED", "NOT_REGISTERED", "UNREACHABLE", "UNREACHABLE", "RUNNING"]


def test_progress_offsets(spark):
    doc = lambda o: json.dumps({"sources": [{"endOffset": o}]})
    rows = [(1, doc({"t": {"0": 5, "1": "x"}, "u": {"0": 9}})), (2, doc({"other": {"3": 7}})), (3, "{}"), (4, json.dumps({"sources": [{"endOffset": json.dumps({"t": {"0": 8}})}]}))]
    got = signals.progress_offsets(spark.createDataFrame(rows, "id int, body string"), "t").collect()
    assert {(r["id"], r["partition"], r["offset"]) for r in got} == {(1, "0", 5), (2, "3", 7), (4, "0", 8)}


def fired(spark, rows, hold):
    df = spark.createDataFrame([("disk", t, on, hold) for t, on in rows], "rule string, t long, active boolean, hold int")
    return sorted(((r["fired_at"], r["resolved_at"]) for r in signals.alert_intervals(df).collect()), key=str)


def test_alerts(spark):
    assert fired(spark, [(100, True), (108, True)], 9) == []
    assert fired(spark, [(100, True), (108, True), (109, True)], 9) == [(109, None)]
    assert fired(spark, [(100, True), (106, False), (107, True), (115, True)], 9) == []  # a dip begins it anew
    assert fired(spark, [(1, False), (2, True), (3, True), (4, False), (8, True)], 0) == [(2, 4), (8, None)]
    assert fired(spark, [(0, True), (12, True), (13, True), (20, False), (21, False), (22, True), (40, True), (41, False)], 9) == [(12, 20), (40, 41)]


def test_rules_hold_for_times_of_their_own(spark):
    rows = [("slow", t, True, 30) for t in range(0, 60, 10)] + [("quick", t, t != 30, 0) for t in range(0, 60, 10)]
    got = signals.alert_intervals(spark.createDataFrame(rows, "rule string, t long, active boolean, hold int"))
    assert {tuple(r) for r in got.collect()} == {("slow", 30, None), ("quick", 0, 30), ("quick", 40, None)}
    moves = [tuple(r) for r in signals.state_changes(got).orderBy("seq").collect()]
    assert moves == [(1, "quick", 0, "firing"), (2, "quick", 30, "resolved"), (3, "slow", 30, "firing"), (4, "quick", 40, "firing")]


def test_freshness_samples(spark):
    rows = [(100, 5.0, 40, False), (100, 6.0, 39, False), (100, 7.0, 99, True), (100, 8.0, None, False), (100, 9.0, 100, None)]
    got = signals.freshness_samples(spark.createDataFrame(rows, "t long, freshness double, last_batch long, caught_up boolean"))
    assert {r["freshness"] for r in got.collect()} == {5.0, 9.0}


def test_latest_batch_and_source_health(spark):
    events = spark.createDataFrame([("a", 3, 10, "x"), ("a", 9, 11, "y"), ("a", 9, 12, "z"), ("b", 1, 50, "w")], "app string, batch_id long, committed_at long, what string")
    assert {tuple(r) for r in signals.latest_batch(events, ["app"]).select("app", "batch_id", "what").collect()} == {("a", 9, "z"), ("b", 1, "w")}
    polls = spark.createDataFrame([("db", 10, None), ("db", 20, "refused"), ("log", 12, ""), ("log", 11, "slow"), ("none", 5, "gone")], "source string, t long, error string")
    assert {tuple(r) for r in signals.source_health(polls, 30).collect()} == {("db", False, "refused", 20), ("log", True, "", 18), ("none", False, "gone", None)}


def test_salted_equals_plain_and_evens_out_a_hot_key(spark):
    rows = spark.range(2000).selectExpr("case when id % 10 < 4 then 'whale' else 'm' || id % 50 end merchant_id", "id amount_minor", "'t' || id transaction_id")
    plain = lambda df: {r["merchant_id"]: (r["total_minor"], r["n"]) for r in df.collect()}
    assert plain(aggregate.salted(rows)) == plain(aggregate.by_key(rows))


def test_trend_verdicts(spark):
    rows = [(100, 1.0, 1.0, 0, 0), (100, 2.0, 1.0, 1, 1), (0, 0.0, 1.0, 5, 0), (40, 9.0, 1.0, 0, None), (60, 9.0, 0.01, -1, 0)]
    got = aggregate.trend_verdicts(spark.createDataFrame(rows, "recent long, recent_rps double, baseline_rps double, dlq long, nulls long")).collect()
    assert [tuple(r) for r in got] == [("ok", "ok", "ok", 0), ("alert", "alert", "alert", 3), ("skipped", "skipped", "ok", 0), ("ok", "skipped", "skipped", 0), ("alert", "skipped", "ok", 1)]


def test_acknowledgements(spark):
    alerts = spark.createDataFrame([("a", 10, 20), ("a", 30, None), ("b", 5, None)], "rule string, fired_at long, resolved_at long")
    acks = spark.createDataFrame([("a", 9, "early"), ("a", 12, "x"), ("a", 15, "late"), ("a", 20, "gone"), ("a", 31, "y")], "rule string, t long, actor string")
    got = {(r["rule"], r["fired_at"]): (r["acked_at"], r["acked_by"], r["state"]) for r in signals.acknowledged(alerts, acks).collect()}
    assert got == {("a", 10): (12, "x", "resolved"), ("a", 30): (31, "y", "acknowledged"), ("b", 5): (None, None, "firing")}


def test_exposition_round_trip(spark):
    text = signals.exposition({"dlq_rows": 8, "input_rows": 64.0}, {"4": 77, "12": 9})
    got = signals.metrics_text(spark.createDataFrame([(x,) for x in text.splitlines()], "line string"), "ledger_processed_offset").collect()
    assert {(r["partition"], r["value"]) for r in got} == {(4, 77), (12, 9)} and "ledger_dlq_rows 8" in text


def test_salting_evens_out_what_tasks_read(spark):
    rows = spark.range(8000).selectExpr("case when id % 10 < 4 then 'whale' else 'm' || id % 20 end merchant_id", "id amount_minor", "'t' || id transaction_id")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain, salted = (aggregate.spread(aggregate.dealt(rows, "merchant_id", n, "transaction_id")).first() for n in (1, 8))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert salted["most"] / salted["least"] < plain["most"] / plain["least"]
