"""Schemas and fixed values of the change ledger."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "transaction_id"
ORDER = "lsn"

#: Business columns of a row image.
IMAGE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount_minor", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)

#: A change as it comes from the log.
ENVELOPE = T.StructType(
    [
        T.StructField("before", IMAGE),
        T.StructField("after", IMAGE),
        T.StructField("source", T.StructType([T.StructField("lsn", T.LongType()), T.StructField("ts_ms", T.LongType())])),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

#: A flattened change.
FLAT = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount_minor", T.LongType()),
        T.StructField("currency", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("lsn", T.LongType()),
        T.StructField("source_ts", T.TimestampType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("is_delete", T.BooleanType()),
    ]
)

#: A row of the ledger table; tombstones stay.
LEDGER_COLUMNS = ["transaction_id", "merchant_id", "amount_minor", "currency", "status", "event_type", "created_at", "updated_at", "lsn", "source_ts", "is_delete"]
LEDGER = T.StructType([f for f in FLAT if f.name in LEDGER_COLUMNS])

#: Fixed values of the validation rules.
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "AUD", "CHF", "SGD", "HKD", "INR"]
UUID_V4 = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
MERCHANTS = [f"MERCH_{i:03d}" for i in range(1, 21)]
