"""A deterministic change feed over the `events` table, and the tables derived from it.

The expressions are plain SQL that Spark and other engines read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage
from ..functions.rules import judged
from ..operators import dedup
from ..schema import LEDGER_COLUMNS, MERCHANTS

#: Column: expression. `h` is the hash that ids are cut from.
HASHED = {"entity_id": "user_id * 8 + event_id % 8", "h": "md5('tx-' || cast(user_id * 8 + event_id % 8 as string))"}
FEED = {
    "event_id": "event_id",
    "entity_id": "entity_id",
    "op": "case when event_id % 50 = 0 then 'r' when event_type = 'error' then 'd' when event_type = 'signup' then 'c' else 'u' end",
    "transaction_id": (
        "case when event_id % 211 = 0 then null when event_id % 101 = 0 then 'not-a-uuid-' || cast(event_id as string) "
        "else substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-4' || substr(h, 14, 3) || '-8' || substr(h, 18, 3) || '-' || substr(h, 21, 12) end"
    ),
    "merchant_id": "'MERCH_' || lpad(cast(1 + user_id % 22 as string), 3, '0')",
    "amount_minor": "cast(cast(value as decimal(18,2)) * 100 as bigint) * (case when event_id % 97 = 0 then -1 else 1 end)",
    "currency": (
        "case when event_id % 83 = 0 then 'XYZ' when event_id % 89 = 0 then null when event_id % 4 = 0 then 'USD' "
        "when event_id % 4 = 1 then 'EUR' when event_id % 4 = 2 then 'GBP' else 'JPY' end"
    ),
    "status": "case when event_id % 3 = 0 then 'PENDING' when event_id % 3 = 1 then 'SETTLED' else 'FAILED' end",
    "event_type": (
        "case when event_id % 4 = 0 then 'AUTHORIZATION' when event_id % 4 = 1 then 'CAPTURE' when event_id % 4 = 2 then 'REFUND' else 'CHARGEBACK' end"
    ),
    "created_at": "ts",
    "updated_at": "ts",
    "lsn": "1000000 + cast(floor(event_id / 200) as bigint)",
    "source_ts": "ts",
    "part": "cast(user_id % 3 as int)",
    "off": "(event_id * 7919) % 1000003",
    "is_delete": "event_id % 50 <> 0 and event_type = 'error'",
    "batch_id": "cast(floor(((event_id * 7919) % 1000003) / 125000) as bigint)",
}


def derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as an expression over `events`; ids' hash is made once."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hashed = events.selectExpr("*", *(f"{e} as {c}" for c, e in HASHED.items()))
    feed = hashed.selectExpr(*(f"{e} as {c}" for c, e in FEED.items()))
    times = {c: F.col(c).cast("timestamp") for c in ("created_at", "updated_at", "source_ts")}
    return feed.withColumnsRenamed({"part": "partition", "off": "offset"}).withColumns(times)


_stored: dict[tuple, tuple[str, StructType]] = {}


def told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed with `rejection_reason`, derived once in an application: what all others are cut from, as a table in the shared folder."""
    at, store = storage.file_system(spark, f"{sf_dir}/events.parquet")
    source = store.getFileStatus(at)
    key = (spark.sparkContext.applicationId, sf_dir, source.getModificationTime(), source.getLen())
    if key not in _stored or not storage.exists(spark, _stored[key][0]):
        rows, path = judged(derived(spark, sf_dir), MERCHANTS), storage.fresh_path(spark, "feed")
        rows.write.parquet(path)
        _stored[key] = (path, rows.schema)
    path, schema = _stored[key]
    return spark.read.schema(schema).parquet(path)


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return told(spark, sf_dir).drop("rejection_reason")


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return told(spark, sf_dir).filter("rejection_reason = ''").drop("rejection_reason")


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return told(spark, sf_dir).filter("rejection_reason <> ''")


def ledger(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    return dedup.closed_form(valid(spark, sf_dir), columns=[*LEDGER_COLUMNS, *extra])


SOURCE_COLUMNS = ["transaction_id", "merchant_id", "amount_minor", "currency", "status", "event_type"]


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source side that differs from the live ledger in every way that parity tells apart."""
    live = ledger(spark, sf_dir, ("entity_id",)).filter("not is_delete")
    own = live.filter("entity_id % 17 <> 0").withColumn("amount_minor", F.expr("amount_minor + case when entity_id % 19 = 0 then 1 else 0 end"))
    unknown = live.filter("entity_id % 23 = 0").withColumn("transaction_id", F.concat(F.lit("extra-"), F.col("entity_id").cast("string")))
    dead = rejected(spark, sf_dir).filter("transaction_id is not null").join(live.select("transaction_id"), "transaction_id", "left_anti")
    first = dead.groupBy("transaction_id").agg(F.min_by(F.struct(*SOURCE_COLUMNS[1:]), "offset").alias("v")).select("transaction_id", "v.*")
    return own.select(*SOURCE_COLUMNS).union(unknown.select(*SOURCE_COLUMNS)).union(first.select(*SOURCE_COLUMNS))


def sql() -> str:
    """WITH-clauses of the same tables for an SQL engine: feed f, valid v, rejected x, ledger l, live k, source s."""
    known = ", ".join(f"'{m}'" for m in MERCHANTS)
    return f"""
WITH f AS (
  SELECT {", ".join(f"{e} AS {c}" for c, e in FEED.items())}
  FROM (SELECT *, {", ".join(f"{e} AS {c}" for c, e in HASHED.items())} FROM events)),
t AS (
  SELECT *, concat_ws(',',
    CASE WHEN NOT is_delete AND amount_minor < 0 THEN 'NEGATIVE_AMOUNT' END,
    CASE WHEN NOT is_delete AND currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CAD', 'AUD', 'CHF', 'SGD', 'HKD', 'INR') THEN 'INVALID_CURRENCY' END,
    CASE WHEN transaction_id IS NULL OR NOT regexp_full_match(transaction_id, '[0-9a-f]{{8}}-[0-9a-f]{{4}}-4[0-9a-f]{{3}}-[89ab][0-9a-f]{{3}}-[0-9a-f]{{12}}') THEN 'INVALID_UUID' END,
    CASE WHEN NOT is_delete AND (merchant_id IS NULL OR merchant_id NOT IN ({known})) THEN 'UNKNOWN_MERCHANT' END) AS rejection_reason
  FROM f),
v AS (SELECT * FROM t WHERE rejection_reason = ''),
x AS (SELECT * FROM t WHERE rejection_reason <> ''),
l AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY lsn DESC, batch_id, off DESC) = 1),
k AS (SELECT * FROM l WHERE NOT is_delete),
s AS (
  SELECT transaction_id, merchant_id, amount_minor + CASE WHEN entity_id % 19 = 0 THEN 1 ELSE 0 END AS amount_minor, currency, status, event_type FROM k WHERE entity_id % 17 <> 0
  UNION ALL SELECT 'extra-' || entity_id, merchant_id, amount_minor, currency, status, event_type FROM k WHERE entity_id % 23 = 0
  UNION ALL (SELECT transaction_id, merchant_id, amount_minor, currency, status, event_type FROM x
    WHERE transaction_id IS NOT NULL AND transaction_id NOT IN (SELECT transaction_id FROM k)
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY off) = 1)),
d AS (SELECT DISTINCT transaction_id FROM x WHERE transaction_id IS NOT NULL),
b AS (
  SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY transaction_id, batch_id ORDER BY lsn DESC, off DESC) = 1),
bh AS (
  SELECT *, max(lsn) OVER w AS high FROM b WINDOW w AS (PARTITION BY transaction_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
ba AS (
  SELECT *, lag(lsn) OVER w AS p_lsn, lag(amount_minor) OVER w AS p_amount, lag(merchant_id) OVER w AS p_merchant, lag(is_delete) OVER w AS p_delete
  FROM bh WHERE high IS NULL OR lsn > high WINDOW w AS (PARTITION BY transaction_id ORDER BY batch_id)),
c AS (
  SELECT transaction_id, merchant_id, amount_minor, lsn, is_delete, CASE WHEN p_lsn IS NULL THEN 'insert' ELSE 'update_postimage' END AS change_type, batch_id + 1 AS commit_version FROM ba
  UNION ALL SELECT transaction_id, p_merchant, p_amount, p_lsn, p_delete, 'update_preimage', batch_id + 1 FROM ba WHERE p_lsn IS NOT NULL)
"""
