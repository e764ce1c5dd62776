"""Validation: the truth table of each rule, and the split."""

import pytest

from ledgerline.functions.rules import validate

GOOD = "3f2b8c1e-9d4a-4b6f-8a21-0c5d7e9f1a2b"
KNOWN = ["MERCH_002", "MERCH_011"]
SCHEMA = "transaction_id string, merchant_id string, amount_minor long, currency string, is_delete boolean, lsn long"


def rows(spark, *changes):
    base = {"transaction_id": GOOD, "merchant_id": "MERCH_002", "amount_minor": 250, "currency": "CHF", "is_delete": False, "lsn": 1}
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], SCHEMA)


CASES = [
    ({"amount_minor": -1}, "NEGATIVE_AMOUNT"),
    ({"amount_minor": 0}, ""),
    ({"amount_minor": None}, ""),
    ({"currency": "XYZ"}, "INVALID_CURRENCY"),
    ({"currency": "INR"}, ""),
    ({"currency": None}, ""),
    ({"transaction_id": "deadbeef"}, "INVALID_UUID"),
    ({"transaction_id": None}, "INVALID_UUID"),
    ({"transaction_id": GOOD.upper()}, "INVALID_UUID"),
    ({"transaction_id": GOOD.replace("-4b6f", "-1b6f")}, "INVALID_UUID"),
    ({"merchant_id": "SHOP_9"}, "UNKNOWN_MERCHANT"),
    ({"merchant_id": None}, "UNKNOWN_MERCHANT"),
    ({}, ""),
    ({"is_delete": None, "amount_minor": -3}, "NEGATIVE_AMOUNT"),
    ({"is_delete": True, "amount_minor": -42, "currency": "XYZ"}, ""),
    ({"is_delete": True, "transaction_id": "bad"}, "INVALID_UUID"),
    ({"is_delete": True, "merchant_id": "SHOP_9"}, ""),
    ({"amount_minor": -1, "currency": "XYZ", "transaction_id": "bad", "merchant_id": "X"}, "NEGATIVE_AMOUNT,INVALID_CURRENCY,INVALID_UUID,UNKNOWN_MERCHANT"),
]


@pytest.mark.parametrize("as_table", [False, True])
def test_truth_table(spark, as_table):
    changes = rows(spark, *({**c, "lsn": i} for i, (c, _) in enumerate(CASES)))
    known = spark.createDataFrame([(m,) for m in KNOWN], "merchant_id string") if as_table else KNOWN
    valid, invalid = validate(changes, known)
    found = {r["lsn"]: "" for r in valid.collect()} | {r["lsn"]: r["rejection_reason"] for r in invalid.collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_columns(spark):
    changes = rows(spark, {}, {"amount_minor": -1})
    valid, invalid = validate(changes, KNOWN)
    assert valid.columns == changes.columns
    assert invalid.columns == [*changes.columns, "rejection_reason"]


def test_empty_registry_raises(spark):
    with pytest.raises(ValueError, match="must not be empty"):
        validate(rows(spark, {}), [])
    with pytest.raises(ValueError, match="must not be empty"):
        validate(rows(spark, {}), spark.createDataFrame([], "merchant_id string"))
