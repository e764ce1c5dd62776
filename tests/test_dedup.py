"""Latest change per key, and the fold of merges against its closed form."""

from functools import reduce

from ledgerline.operators.dedup import closed_form, latest
from ledgerline.operators.merge import merged
from ledgerline.plans import feed
from ledgerline.schema import LEDGER_COLUMNS

SCHEMA = "transaction_id string, lsn long, is_delete boolean, op string, offset long, amount_minor long"


def one(spark, *changes):
    got = latest(spark.createDataFrame(list(changes), SCHEMA)).collect()
    return {r["transaction_id"]: (r["lsn"], r["offset"], r["is_delete"], r["amount_minor"]) for r in got}


def test_orders(spark):
    assert one(spark, ("a", 10, False, "c", 1, 100), ("a", 20, False, "u", 2, 100), ("a", 30, False, "u", 3, 100))["a"][0] == 30
    assert one(spark, ("a", 30, False, "u", 1, 1), ("a", 10, False, "u", 2, 1), ("a", 40, False, "u", 3, 250), ("a", 20, False, "u", 4, 1))["a"] == (40, 3, False, 250)


def test_equal_lsn_takes_the_highest_offset(spark):
    assert one(spark, ("a", 50, False, "u", 10, 1), ("a", 50, False, "u", 11, 999), ("a", 50, False, "u", 9, 1))["a"] == (50, 11, False, 999)


def test_keys_are_independent_and_deletes_win_by_lsn(spark):
    got = one(spark, ("a", 1, False, "c", 1, 1), ("a", 3, False, "u", 2, 1), ("b", 2, False, "c", 3, 1), ("c", 100, False, "c", 4, 1), ("c", 140, True, "d", 5, 1), ("c", 120, False, "u", 6, 9))
    assert {k: v[0] for k, v in got.items()} == {"a": 3, "b": 2, "c": 140}
    assert got["c"][2]


def test_null_lsn_comes_last_and_empty_stays_empty(spark):
    assert one(spark, ("a", None, False, "c", 9, 1), ("a", 1, False, "c", 1, 1))["a"][0] == 1
    assert one(spark) == {}


def test_merge_cases(spark):
    schema = "transaction_id string, lsn long, is_delete boolean"
    target = spark.createDataFrame([("equal", 5, False), ("older", 9, False), ("newer", 1, False), ("null", None, False), ("alone", 1, True)], schema)
    staged = spark.createDataFrame([("equal", 5, True), ("older", 8, True), ("newer", 2, True), ("null", 3, True), ("tombstone", 1, True)], schema)
    got = {r["transaction_id"]: (r["lsn"], r["is_delete"], r["_change"]) for r in merged(target, staged).collect()}
    assert got == {
        "equal": (5, False, "kept"), "older": (9, False, "kept"), "newer": (2, True, "update"), "null": (None, False, "kept"),
        "alone": (1, True, "kept"), "tombstone": (1, True, "insert"),
    }


def test_rows_without_a_key_stay(spark):
    schema = "transaction_id string, lsn long, is_delete boolean"
    target = spark.createDataFrame([(None, 5, False), ("x", 1, None)], schema)
    staged = spark.createDataFrame([(None, 9, True), ("x", 2, False)], schema)
    got = sorted(map(tuple, merged(target, staged).collect()), key=str)
    assert got == sorted([(None, 5, False, "kept"), (None, 9, True, "insert"), ("x", 2, False, "update")], key=str)


def test_fold_equals_closed_form(spark):
    valid = feed.valid(spark, "/root/testdata/sf0.001").persist()
    batches = sorted(r[0] for r in valid.select("batch_id").distinct().collect())
    start = spark.createDataFrame([], valid.select(*LEDGER_COLUMNS).schema)
    step = lambda t, b: spark.createDataFrame(merged(t, latest(valid.filter(f"batch_id = {b}"))).drop("_change").collect(), start.schema)
    folded = reduce(step, batches, start)
    assert sorted(folded.collect(), key=str) == sorted(closed_form(valid).collect(), key=str)
