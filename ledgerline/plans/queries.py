"""Registered queries of the ledger: each an operator over the derived feed, and SQL that an independent engine answers alike."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import signals
from ..functions.rules import validate
from ..operators import aggregate, dedup, parity
from ..schema import IMAGE, MERCHANTS
from ..sources import avro, dead_letters, envelope
from ..streaming import audit
from . import feed, stored
from .stored import NOW

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

#: The columns that most results show.
SHORT = ["transaction_id", "merchant_id", "amount_minor", "currency", "status", "event_type", "lsn", "is_delete"]
_SHORT = ", ".join(SHORT)


def query(sql: str | None):
    """Register a query under its function's name, with SQL over the feed's clauses."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = feed.sql() + sql
        return f

    return add


def _seconds(c: str) -> Column:
    return F.unix_seconds(F.col(c).cast("timestamp")).alias(f"{c}_s")


# The feed and the ledger


@query(f"SELECT event_id, op, {_SHORT}, part AS kafka_partition, off AS kafka_offset, batch_id, CAST(floor(epoch(source_ts)) AS BIGINT) AS source_ts_s FROM f")
def cdc_feed(spark, sf_dir):
    return feed.changes(spark, sf_dir).select("event_id", "op", *SHORT, F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), "batch_id", _seconds("source_ts"))


@query(f"SELECT {_SHORT}, CAST(floor(epoch(source_ts)) AS BIGINT) AS source_ts_s FROM l")
def ledger_state(spark, sf_dir):
    return feed.ledger(spark, sf_dir).select(*SHORT, _seconds("source_ts"))


@query(f"SELECT event_id, {_SHORT} FROM v")
def validate_valid(spark, sf_dir):
    return validate(feed.changes(spark, sf_dir), MERCHANTS)[0].select("event_id", *SHORT)


@query(f"SELECT event_id, {_SHORT}, rejection_reason FROM x")
def validate_invalid(spark, sf_dir):
    known = spark.createDataFrame([(m,) for m in MERCHANTS], "merchant_id string")
    return validate(feed.changes(spark, sf_dir), known)[1].select("event_id", *SHORT, "rejection_reason")


@query("SELECT rejection_reason, count(*) AS n FROM x GROUP BY 1")
def rejection_counts(spark, sf_dir):
    return feed.rejected(spark, sf_dir).groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, merchant_id, amount_minor, currency, lsn, rejection_reason, '2024-01-01T00:00:00Z' AS rejected_at, transaction_id IS NOT NULL AS has_id FROM x")
def dlq_payload(spark, sf_dir):
    """The payload's fields, read back from it."""
    sent = dead_letters.payload(feed.rejected(spark, sf_dir), "2024-01-01T00:00:00Z")
    body = F.from_json("value", "event_id long, transaction_id string, merchant_id string, amount_minor long, currency string, lsn long, rejection_reason string, rejected_at string")
    return sent.select(body.alias("b")).select("b.event_id", "b.merchant_id", "b.amount_minor", "b.currency", "b.lsn", "b.rejection_reason", "b.rejected_at", F.col("b.transaction_id").isNotNull().alias("has_id"))


@query("SELECT transaction_id FROM d")
def dlq_keys(spark, sf_dir):
    return dead_letters.keys(feed.rejected(spark, sf_dir))


@query(f"SELECT {_SHORT}, off AS kafka_offset FROM v WHERE batch_id = 0 QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY lsn DESC, off DESC) = 1")
def dedup_latest(spark, sf_dir):
    return dedup.latest(feed.valid(spark, sf_dir).filter("batch_id = 0")).select(*SHORT, F.col("offset").alias("kafka_offset"))


@query(f"SELECT {_SHORT}, off AS kafka_offset, batch_id FROM b")
def dedup_each_batch(spark, sf_dir):
    """What every batch stages, of all batches at once."""
    return dedup.latest(feed.valid(spark, sf_dir), "transaction_id", "batch_id").select(*SHORT, F.col("offset").alias("kafka_offset"), "batch_id")


# Parity


def _sides(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    return feed.source(spark, sf_dir), parity.live(feed.ledger(spark, sf_dir)), dead_letters.keys(feed.rejected(spark, sf_dir))


@query("SELECT * FROM s")
def source_snapshot(spark, sf_dir):
    return feed.source(spark, sf_dir)


@query(f"SELECT {_SHORT} FROM k")
def live_rows(spark, sf_dir):
    return parity.live(feed.ledger(spark, sf_dir)).select(*SHORT)


@query("SELECT * FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM k)")
def parity_missing(spark, sf_dir):
    source, lake, _ = _sides(spark, sf_dir)
    return parity.missing(source, lake)


@query("SELECT * FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM k) AND transaction_id IN (SELECT transaction_id FROM d)")
def parity_quarantined(spark, sf_dir):
    return parity.quarantined(*_sides(spark, sf_dir))


@query("SELECT * FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM k) AND transaction_id NOT IN (SELECT transaction_id FROM d)")
def parity_unaccounted(spark, sf_dir):
    return parity.unaccounted(*_sides(spark, sf_dir))


@query(f"SELECT {_SHORT} FROM k WHERE transaction_id NOT IN (SELECT transaction_id FROM s)")
def parity_extra(spark, sf_dir):
    source, lake, _ = _sides(spark, sf_dir)
    return parity.extra(source, lake).select(*SHORT)


_DIFFERS = " OR ".join(f"s.{c} <> k.{c}" for c in parity.COMPARED)
_DIFFERS_NULL = " OR ".join(f"s.{c} IS DISTINCT FROM k.{c}" for c in parity.COMPARED)


@query(f"SELECT s.transaction_id, s.amount_minor AS source_amount, k.amount_minor AS lake_amount FROM s JOIN k USING (transaction_id) WHERE {_DIFFERS}")
def parity_mismatch(spark, sf_dir):
    source, lake, _ = _sides(spark, sf_dir)
    return parity.mismatch(source, lake)


@query(f"SELECT s.transaction_id, s.amount_minor AS source_amount, k.amount_minor AS lake_amount FROM s JOIN k USING (transaction_id) WHERE {_DIFFERS_NULL}")
def parity_mismatch_nullsafe(spark, sf_dir):
    source, lake, _ = _sides(spark, sf_dir)
    return parity.mismatch(source, lake, null_safe=True)


@query("SELECT transaction_id, count(*) AS n FROM v GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return parity.duplicates(feed.valid(spark, sf_dir))


@query(f"""
, r AS (SELECT
  (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM k) AS lake_rows,
  (SELECT count(*) FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM k)) AS missing,
  (SELECT count(*) FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM k) AND transaction_id IN (SELECT transaction_id FROM d)) AS quarantined,
  (SELECT count(*) FROM k WHERE transaction_id NOT IN (SELECT transaction_id FROM s)) AS extra,
  (SELECT count(*) FROM s JOIN k USING (transaction_id) WHERE {_DIFFERS}) AS mismatched,
  (SELECT count(*) FROM (SELECT 1 FROM k GROUP BY transaction_id HAVING count(*) > 1)) AS duplicate_keys)
SELECT *, missing - quarantined AS unaccounted,
  CASE WHEN missing - quarantined <= 0 AND extra = 0 AND mismatched = 0 AND duplicate_keys = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM r""")
def parity_report(spark, sf_dir):
    return parity.report(*_sides(spark, sf_dir))


@query("SELECT count(*) AS n_rows, CAST(coalesce(sum(amount_minor), 0) AS BIGINT) AS total_minor FROM k")
def table_digest(spark, sf_dir):
    return aggregate.digest(parity.live(feed.ledger(spark, sf_dir)))


@query("SELECT count(*) FILTER (NOT is_delete) AS live, count(*) FILTER (is_delete) AS tombstones, coalesce(max(lsn), 0) AS max_lsn FROM l")
def lake_stats(spark, sf_dir):
    return aggregate.lake_stats(feed.ledger(spark, sf_dir))


@query(f"SELECT {_SHORT} FROM l WHERE transaction_id = (SELECT min(transaction_id) FROM l WHERE is_delete)")
def point_lookup(spark, sf_dir):
    """From the stored table: the key's bucket alone is read, and a key with several rows raises."""
    table = stored.table(spark, sf_dir)
    key = table.read().filter("is_delete").agg(F.min("transaction_id")).first()[0]
    if key is not None:
        table.row(key)
    return table.lookup(key or "").select(*SHORT)


@query(f"SELECT transaction_id FROM d WHERE transaction_id IN (SELECT transaction_id FROM s) AND regexp_full_match(transaction_id, '{dead_letters.ANY_UUID[1:-1]}')")
def source_key_semi(spark, sf_dir):
    source, _, dead = _sides(spark, sf_dir)
    return dead_letters.present(dead, source)


# Snapshot, aggregates


@query("SELECT op, count(*) AS n FROM f GROUP BY 1")
def op_counts(spark, sf_dir):
    return feed.changes(spark, sf_dir).groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT DISTINCT transaction_id FROM v WHERE op = 'r' AND transaction_id NOT IN (SELECT transaction_id FROM k)")
def snapshot_missing(spark, sf_dir):
    taken = feed.valid(spark, sf_dir).filter("op = 'r'").select("transaction_id").distinct()
    return parity.missing(taken, parity.live(feed.ledger(spark, sf_dir)))


def _transition(snapshot: str) -> str:
    return f""", e AS (SELECT max(lsn) FILTER ({snapshot}) AS snapshot_max_lsn, min(lsn) FILTER (NOT ({snapshot})) AS stream_min_lsn FROM f)
SELECT *, CASE WHEN snapshot_max_lsn IS NULL OR stream_min_lsn IS NULL THEN 'skipped' WHEN snapshot_max_lsn < stream_min_lsn THEN 'clean' ELSE 'not clean' END AS verdict FROM e"""


@query(_transition("op = 'r'"))
def snapshot_transition(spark, sf_dir):
    return aggregate.snapshot_transition(feed.changes(spark, sf_dir), F.col("op") == "r")


@query(_transition("lsn < 1000005"))
def snapshot_transition_clean(spark, sf_dir):
    return aggregate.snapshot_transition(feed.changes(spark, sf_dir), F.col("lsn") < 1000005)


_BY_KEY = "SELECT merchant_id, CAST(sum(amount_minor) AS BIGINT) AS total_minor, count(*) AS n FROM c WHERE change_type <> 'update_preimage' GROUP BY 1"


def _images(spark, sf_dir) -> DataFrame:
    return dedup.change_feed(feed.valid(spark, sf_dir)).filter("_change_type in ('insert', 'update_postimage')")


@query(_BY_KEY)
def agg_naive(spark, sf_dir):
    return aggregate.by_key(_images(spark, sf_dir))


@query(_BY_KEY)
def agg_salted(spark, sf_dir):
    return aggregate.salted(_images(spark, sf_dir))


@query("SELECT merchant_id, CAST(sum(amount_minor) AS BIGINT) AS total_minor, count(*) AS n FROM k GROUP BY 1")
def agg_live(spark, sf_dir):
    return aggregate.salted(parity.live(feed.ledger(spark, sf_dir)))


@query(_BY_KEY + " ORDER BY total_minor DESC NULLS LAST, merchant_id LIMIT 5")
def top_merchants(spark, sf_dir):
    return aggregate.top(aggregate.by_key(_images(spark, sf_dir)))


# Envelopes and the wire


@query("""SELECT event_id, op, CASE WHEN op = 'd' THEN transaction_id END AS before_id, CASE WHEN op <> 'd' THEN transaction_id END AS after_id,
  CASE WHEN op = 'd' THEN amount_minor END AS before_amount, CASE WHEN op <> 'd' THEN amount_minor END AS after_amount, lsn FROM f""")
def build_envelope(spark, sf_dir):
    rows = feed.changes(spark, sf_dir)
    built = envelope.build(rows.withColumn("offset", F.col("event_id")))
    return built.select(
        F.col("offset").alias("event_id"), "e.op", F.col("e.before.transaction_id").alias("before_id"), F.col("e.after.transaction_id").alias("after_id"),
        F.col("e.before.amount_minor").alias("before_amount"), F.col("e.after.amount_minor").alias("after_amount"), F.col("e.source.lsn").alias("lsn"),
    )


@query(f"SELECT {_SHORT}, part AS kafka_partition, off AS kafka_offset, CAST(floor(epoch(source_ts)) AS BIGINT) AS source_ts_s, CAST(floor(epoch(created_at)) AS BIGINT) AS created_at_s FROM f")
def flatten_envelope(spark, sf_dir):
    """There and back: built, written as JSON, parsed, flattened."""
    flat = envelope.flatten(envelope.from_json(envelope.to_json(envelope.build(feed.changes(spark, sf_dir)))))
    return flat.select(*SHORT, F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), _seconds("source_ts"), _seconds("created_at"))


@query("SELECT event_id, CAST(1 + event_id % 1000 AS INTEGER) AS schema_id, 'm' || merchant_id AS payload FROM f")
def wire_header_split(spark, sf_dir):
    framed = feed.changes(spark, sf_dir).select(
        "event_id", envelope.frame((1 + F.col("event_id") % 1000).cast("int"), F.concat(F.lit("m"), "merchant_id").cast("binary")).alias("value")
    )
    ident, payload = envelope.header(F.col("value"))
    return framed.select("event_id", ident.alias("schema_id"), payload.cast("string").alias("payload"))


@query("SELECT event_id, transaction_id, CASE WHEN event_id % 2 = 1 THEN currency END AS currency FROM f")
def union_schema_versions(spark, sf_dir):
    rows = feed.changes(spark, sf_dir).select("event_id", "transaction_id", "currency")
    return envelope.union_versions([rows.filter("event_id % 2 = 1"), rows.filter("event_id % 2 = 0").drop("currency")])


def _writer_schema(more: list[dict]) -> str:
    text = lambda n: {"name": n, "type": ["null", "string"], "default": None}
    number = lambda n: {"name": n, "type": ["null", "long"], "default": None}
    image = [number(f.name) if f.name == "amount_minor" else text(f.name) for f in IMAGE]
    source = {"type": "record", "name": "Source", "fields": [number("lsn"), number("ts_ms")]}
    row = {"type": "record", "name": "Row", "fields": [*image, *more]}
    fields = [{"name": "before", "type": ["null", row]}, {"name": "after", "type": ["null", "Row"]}, {"name": "source", "type": ["null", source]}, text("op"), number("ts_ms")]
    return json.dumps({"type": "record", "name": "Change", "fields": fields})


#: Two versions of a writer's schema: the second has a field that readers ignore.
WRITERS = {1: _writer_schema([]), 2: _writer_schema([{"name": "channel", "type": ["null", "string"], "default": None}])}


class _Writers:
    """A registry of these."""

    @staticmethod
    def by_id(schema_id: int) -> str:
        return WRITERS[schema_id]


_DECODED = f"SELECT {_SHORT}, part AS kafka_partition, off AS kafka_offset, CAST(floor(epoch(source_ts)) AS BIGINT) AS source_ts_s FROM f"


@query(_DECODED)
def decode_by_writer_schema(spark, sf_dir):
    """Envelopes written in Avro by two schemas, each read by its own."""
    built = envelope.build(feed.changes(spark, sf_dir))
    wire = avro.encode(built, (1 + F.col("offset") % 2).cast("int"), WRITERS)
    return envelope.flatten(avro.decode(wire, _Writers())).select(*SHORT, F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), _seconds("source_ts"))


@query(_DECODED)
def decode_single_schema(spark, sf_dir):
    built = envelope.build(feed.changes(spark, sf_dir))
    flat = envelope.flatten(avro.decode_single(avro.encode(built, F.lit(1), WRITERS), WRITERS[1]))
    return flat.select(*SHORT, F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), _seconds("source_ts"))


# Merge and change feed


@query(f"SELECT {_SHORT} FROM v WHERE batch_id <= 1 QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY lsn DESC, batch_id, off DESC) = 1")
def merge_upsert(spark, sf_dir):
    """The stored table as its second merge left it."""
    return stored.table(spark, sf_dir).read(2).select(*SHORT)


@query(f"SELECT {_SHORT} FROM l")
def merge_all_batches(spark, sf_dir):
    """The stored table after all its merges."""
    return stored.table(spark, sf_dir).read().select(*SHORT)


@query("SELECT DISTINCT batch_id, batch_id < 5 AS committed FROM f")
def ledger_probe(spark, sf_dir):
    """What the stored batch ledger answers for each batch, one probe each."""
    done = stored.ledger(spark, sf_dir)
    asked = [r["batch_id"] for r in feed.changes(spark, sf_dir).select("batch_id").distinct().collect()]  # BATCHES at most
    told = [(n, done.has(stored.APP, stored.QUERY, n)) for n in asked]
    return spark.createDataFrame(told, "batch_id long, committed boolean")


@query("SELECT DISTINCT batch_id, batch_id + 1 AS version FROM v")
def recorded_batches(spark, sf_dir):
    """The batches that the table's own log has, whether or not they reached the batch ledger."""
    log = stored.table(spark, sf_dir).log()
    return spark.createDataFrame([(m["batch"][2], m["version"]) for m in log if m["batch"]], "batch_id long, version long")


@query("SELECT transaction_id, amount_minor, lsn, is_delete, change_type, commit_version FROM c WHERE commit_version >= 3")
def cdf_by_version(spark, sf_dir):
    images = stored.table(spark, sf_dir).change_feed(first=3)
    return images.select("transaction_id", "amount_minor", "lsn", "is_delete", F.col("_change_type").alias("change_type"), F.col("_commit_version").alias("commit_version"))


_STAMPED = f", ct AS (SELECT *, {NOW - 30} - 60 * (9 - commit_version) AS t FROM c)"


def _stamped(spark, sf_dir) -> DataFrame:
    """The stored table's change feed with commit times."""
    return stored.table(spark, sf_dir).change_feed().withColumnRenamed("_commit_timestamp", "t")


@query(_STAMPED + f" SELECT change_type, count(*) AS n FROM ct WHERE t >= {NOW} - 240 GROUP BY 1")
def cdf_window_counts(spark, sf_dir):
    images = stored.table(spark, sf_dir).change_feed(since=NOW - 240)
    return images.groupBy(F.col("_change_type").alias("change_type")).agg(F.count(F.lit(1)).alias("n"))


@query(_STAMPED + " SELECT commit_version, t AS committed_at, count(*) FILTER (change_type = 'insert') AS inserted, count(*) FILTER (change_type = 'update_postimage') AS updated FROM ct GROUP BY ALL")
def table_history(spark, sf_dir):
    rows = stored.table(spark, sf_dir).history().filter(F.col("version") <= stored.BATCHES)
    counts = F.from_json("counts", "inserted long, updated long")
    return rows.select(F.col("version").alias("commit_version"), "committed_at", counts["inserted"].alias("inserted"), counts["updated"].alias("updated"))


@query("SELECT event_id, part AS kafka_partition, off AS kafka_offset FROM f WHERE part = 0 AND off >= 100 AND off < 200000 OR part = 1 AND off >= 50000 AND off < 400000")
def replay_range_scan(spark, sf_dir):
    rows = feed.changes(spark, sf_dir)
    wanted = F.lit(False)
    for p, (a, b) in {0: (100, 200_000), 1: (50_000, 400_000)}.items():
        wanted = wanted | ((F.col("partition") == p) & (F.col("offset") >= a) & (F.col("offset") < b))
    return rows.filter(wanted).select("event_id", F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"))


@query("SELECT count(*) AS n_rows, CAST(coalesce(sum(amount_minor), 0) AS BIGINT) AS total_minor, CAST(0 AS BIGINT) AS changed FROM k")
def replay_noop_digest(spark, sf_dir):
    """The whole log merged once more into the stored table, as one batch: what changes, and the digest after it."""
    table = stored.table(spark, sf_dir)
    counts = table.merge(dedup.latest(feed.valid(spark, sf_dir)), now=NOW - 30)
    return aggregate.digest(parity.live(table.read())).withColumn("changed", F.lit(counts["inserted"] + counts["updated"]).cast("long"))


@query("SELECT count(*) AS n FROM f WHERE transaction_id IS NULL AND batch_id >= 4")
def null_key_count(spark, sf_dir):
    return feed.changes(spark, sf_dir).filter("transaction_id is null and batch_id >= 4").agg(F.count(F.lit(1)).alias("n"))


_THROUGHPUT = f""", tw AS (SELECT count(*) FILTER (t >= {NOW} - 240) AS recent, count(*) FILTER (t < {NOW} - 240) AS baseline
  FROM ct WHERE change_type <> 'update_preimage' AND t >= {NOW} - 480)"""


@query(_STAMPED + _THROUGHPUT + " SELECT recent, baseline, recent / 240.0::DOUBLE AS recent_rps, baseline / 240.0::DOUBLE AS baseline_rps FROM tw")
def throughput_windows(spark, sf_dir):
    return aggregate.throughput(_stamped(spark, sf_dir), NOW, 240)


@query(_STAMPED + _THROUGHPUT + """
, st AS (SELECT recent, recent / 240.0::DOUBLE AS r, baseline / 240.0::DOUBLE AS b, (SELECT count(*) FROM x) AS dlq, (SELECT count(*) FROM f WHERE transaction_id IS NULL) AS nulls FROM tw),
vd AS (SELECT
  CASE WHEN recent = 0 THEN 'skipped' WHEN dlq / greatest(recent, 1) >= 0.001 THEN 'alert' ELSE 'ok' END AS dlq_verdict,
  CASE WHEN b < 0.1 THEN 'skipped' WHEN r BETWEEN b * 0.5 AND b * 1.5 THEN 'ok' WHEN recent > 50 THEN 'alert' ELSE 'skipped' END AS throughput_verdict,
  CASE WHEN nulls > 0 THEN 'alert' ELSE 'ok' END AS null_verdict FROM st)
SELECT *, CAST((dlq_verdict = 'alert')::INT + (throughput_verdict = 'alert')::INT + (null_verdict = 'alert')::INT AS INTEGER) AS alerts FROM vd""")
def trend_verdicts(spark, sf_dir):
    images = _stamped(spark, sf_dir)
    stats = aggregate.throughput(images, NOW, 240)
    dead = feed.rejected(spark, sf_dir).agg(F.count(F.lit(1)).alias("dlq"))
    nulls = feed.changes(spark, sf_dir).agg(F.count_if(F.col("transaction_id").isNull()).alias("nulls"))
    return aggregate.trend_verdicts(stats.join(dead, F.lit(True)).join(nulls, F.lit(True)))  # one row each


# Dead letters


def _letters(spark, sf_dir) -> DataFrame:
    return feed.rejected(spark, sf_dir).filter("transaction_id is not null")


@query("""SELECT off AS kafka_offset,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'key-' || event_id ELSE coalesce(transaction_id, 'key-' || event_id) END AS transaction_id,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 0 ELSE coalesce(amount_minor, 0) END AS amount_minor,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN '' ELSE coalesce(currency, '') END AS currency,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 'c' ELSE op END AS op,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN 0 ELSE lsn END AS lsn FROM x""")
def dlq_parse(spark, sf_dir):
    good = F.to_json(F.struct("transaction_id", "amount_minor", "currency", "op", "lsn"))
    value = F.when(F.col("event_id") % 7 == 0, "not json").when(F.col("event_id") % 11 == 0, "[1]").otherwise(good)
    messages = feed.rejected(spark, sf_dir).select("offset", F.concat(F.lit("key-"), F.col("event_id").cast("string")).alias("key"), value.alias("value"))
    return dead_letters.parse(messages).select(F.col("offset").alias("kafka_offset"), "transaction_id", "amount_minor", "currency", "op", "lsn")


_OPEN = ", o AS (SELECT x.*, l.lsn AS lake_lsn FROM x LEFT JOIN l USING (transaction_id) WHERE x.transaction_id IS NOT NULL AND (l.lsn IS NULL OR l.lsn < x.lsn))"


@query(_OPEN + " SELECT transaction_id, lsn, lake_lsn, rejection_reason, off AS kafka_offset FROM o")
def dlq_open(spark, sf_dir):
    return dead_letters.open_letters(_letters(spark, sf_dir), feed.ledger(spark, sf_dir)).select("transaction_id", "lsn", "lake_lsn", "rejection_reason", F.col("offset").alias("kafka_offset"))


@query(_OPEN + """ SELECT (SELECT count(*) FROM x WHERE transaction_id IS NOT NULL) AS messages, (SELECT count(*) FROM (SELECT DISTINCT transaction_id, lsn FROM o)) AS open,
  (SELECT count(DISTINCT transaction_id) FROM o WHERE lake_lsn IS NULL AND transaction_id IN (SELECT transaction_id FROM s)) AS missing""")
def dlq_open_counts(spark, sf_dir):
    return dead_letters.open_counts(_letters(spark, sf_dir), feed.ledger(spark, sf_dir), feed.source(spark, sf_dir))


@query(_OPEN + " SELECT DISTINCT transaction_id FROM o WHERE lake_lsn IS NULL AND transaction_id IN (SELECT transaction_id FROM s)")
def dlq_open_missing(spark, sf_dir):
    return dead_letters.missing_open(_letters(spark, sf_dir), feed.ledger(spark, sf_dir), feed.source(spark, sf_dir))


@query("SELECT event_id, rejection_reason FROM x WHERE contains(rejection_reason, 'MERCHANT')")
def dlq_by_reason(spark, sf_dir):
    return dead_letters.with_reason(feed.rejected(spark, sf_dir), "merchant").select("event_id", "rejection_reason")


@query("""
, y AS (SELECT * FROM x WHERE transaction_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY transaction_id, lsn ORDER BY off) = 1),
z AS (SELECT *, row_number() OVER (ORDER BY off) AS n FROM y WHERE off >= 200000),
nx AS (SELECT max(off) FILTER (n = 26) AS n FROM z)
SELECT z.off AS kafka_offset, transaction_id, lsn, coalesce(CAST(nx.n AS VARCHAR), '') AS next_cursor FROM z, nx WHERE z.n <= 25""")
def dlq_page(spark, sf_dir):
    rows = dead_letters.page(dead_letters.collapsed(_letters(spark, sf_dir)), 200_000, 25)
    return rows.select(F.col("offset").alias("kafka_offset"), "transaction_id", "lsn", "next_cursor")


@query("""
, ms AS (SELECT off, transaction_id, lsn FROM x), hi AS (SELECT max(off) + 1 AS e FROM ms),
sc AS (SELECT * FROM ms WHERE off >= 300000 ORDER BY off LIMIT 40)
SELECT off AS kafka_offset, coalesce(transaction_id, 'none') AS transaction_id, lsn, (SELECT max(off) + 1 FROM sc) AS next, (SELECT e FROM hi) AS "end" FROM sc""")
def dlq_scan(spark, sf_dir):
    """A range of the dead-letter log, parsed, with where to go on and the log's end."""
    sent = feed.rejected(spark, sf_dir).select("offset", F.lit("none").alias("key"), F.to_json(F.struct("transaction_id", "lsn")).alias("value"))
    rows = dead_letters.scan(sent, 300_000, 40)
    return rows.select(F.col("offset").alias("kafka_offset"), "transaction_id", "lsn", "next", "end")


@query("SELECT min(off) AS low, max(off) + 1 AS high, max(off) + 1 - min(off) AS messages FROM x")
def dlq_watermarks(spark, sf_dir):
    return dead_letters.watermarks(feed.rejected(spark, sf_dir))


#: Today's rules of the revalidation: two more merchants are known.
_MORE = ["MERCH_021", "MERCH_022"]
_REVALID = """, rv AS (SELECT *, concat_ws(',',
    CASE WHEN NOT is_delete AND amount_minor < 0 THEN 'NEGATIVE_AMOUNT' END,
    CASE WHEN NOT is_delete AND contains(rejection_reason, 'CURRENCY') THEN 'INVALID_CURRENCY' END,
    CASE WHEN contains(rejection_reason, 'UUID') THEN 'INVALID_UUID' END) AS now_reason FROM x WHERE transaction_id IS NOT NULL)"""


@query(_REVALID + " SELECT event_id, now_reason AS rejection_reason FROM rv")
def revalidate_dlq(spark, sf_dir):
    return dead_letters.revalidated(_letters(spark, sf_dir), MERCHANTS + _MORE).select("event_id", "rejection_reason")


@query(_REVALID + """ SELECT rv.event_id, l.lsn AS lake_lsn, CASE WHEN l.lsn >= rv.lsn THEN 'ALREADY_APPLIED' WHEN now_reason <> '' THEN 'STILL_INVALID' ELSE 'REPLAYABLE' END AS replay_class
  FROM rv LEFT JOIN l USING (transaction_id)""")
def replay_classify(spark, sf_dir):
    return dead_letters.replay_class(_letters(spark, sf_dir), feed.ledger(spark, sf_dir), MERCHANTS + _MORE).select("event_id", "lake_lsn", "replay_class")


# Signals


@query("SELECT part AS kafka_partition, max(off) + 1 AS end_offset FROM f GROUP BY 1")
def end_offsets(spark, sf_dir):
    return signals.end_offsets(feed.changes(spark, sf_dir)).withColumnRenamed("partition", "kafka_partition")


@query("""SELECT t.batch_id, count(*) AS input_rows, count(*) FILTER (rejection_reason = '') AS valid_rows, count(*) FILTER (rejection_reason <> '') AS dlq_rows,
  CAST(floor(epoch(max(source_ts) FILTER (rejection_reason = ''))) AS BIGINT) AS max_source_s, max(m.merged_rows) AS merged_rows
  FROM t LEFT JOIN (SELECT batch_id, count(*) AS merged_rows FROM b GROUP BY 1) m USING (batch_id) GROUP BY 1""")
def batch_progress(spark, sf_dir):
    fine = F.col("rejection_reason") == ""
    return feed.told(spark, sf_dir).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("input_rows"), F.count_if(fine).alias("valid_rows"), F.count_if(~fine).alias("dlq_rows"),
        F.unix_seconds(F.max(F.when(fine, F.col("source_ts"))).cast("timestamp")).alias("max_source_s"),
        F.count_distinct(F.when(fine, F.col("transaction_id"))).alias("merged_rows"),
    )


@query("""SELECT part AS kafka_partition, batch_id, count(*) AS input_rows, max(off) + 1 AS processed FROM f GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY part ORDER BY batch_id DESC) = 1""")
def latest_batch(spark, sf_dir):
    """Of each partition's progress events the one of the greatest batch."""
    events = feed.changes(spark, sf_dir).groupBy("batch_id", F.col("partition").alias("kafka_partition")).agg(F.count(F.lit(1)).alias("input_rows"), (F.max("offset") + 1).alias("processed"))
    return signals.latest_batch(events.withColumn("committed_at", F.col("batch_id")), ["kafka_partition"]).drop("committed_at")


@query("""SELECT 's' || user_id % 6 AS source, arg_max(CASE WHEN event_id % 7 = 0 THEN 'timeout' WHEN user_id % 6 = 5 THEN 'refused' ELSE '' END, event_id) = '' AS ok,
  arg_max(CASE WHEN event_id % 7 = 0 THEN 'timeout' WHEN user_id % 6 = 5 THEN 'refused' ELSE '' END, event_id) AS error,
  10000000 - max(event_id) FILTER (event_id % 7 <> 0 AND user_id % 6 <> 5) AS age_s FROM events GROUP BY user_id % 6""")
def source_health(spark, sf_dir):
    """Polls of six sources, one of which never answers."""
    error = F.when(F.col("event_id") % 7 == 0, "timeout").when(F.col("user_id") % 6 == 5, "refused")
    polls = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.concat(F.lit("s"), (F.col("user_id") % 6).cast("string")).alias("source"), F.col("event_id").alias("t"), error.alias("error"))
    return signals.source_health(polls, 10_000_000)


@query("SELECT part AS kafka_partition, max(off) + 1 AS processed FROM f WHERE batch_id < 5 GROUP BY 1")
def processed_offsets(spark, sf_dir):
    """From progress events, one per batch and partition: the highest of each partition."""
    events = feed.changes(spark, sf_dir).filter("batch_id < 5").groupBy("batch_id", "partition").agg((F.max("offset") + 1).alias("processed"))
    return events.groupBy(F.col("partition").alias("kafka_partition")).agg(F.max("processed").alias("processed"))


@query("SELECT batch_id, CAST(part AS VARCHAR) AS kafka_partition, max(off) + 1 AS kafka_offset FROM f GROUP BY 1, 2")
def progress_offsets_parse(spark, sf_dir):
    ends = feed.changes(spark, sf_dir).groupBy("batch_id", "partition").agg((F.max("offset") + 1).alias("o"))
    maps = ends.groupBy("batch_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), F.col("o")))).alias("m"))
    topic = F.when(F.col("batch_id") % 2 == 0, "transactions").otherwise("other")
    body = F.to_json(F.struct(F.array(F.struct(F.create_map(topic, F.col("m")).alias("endOffset"))).alias("sources")))
    found = signals.progress_offsets(maps.select(F.col("batch_id").alias("id"), body.alias("body")), "transactions")
    return found.select(F.col("id").alias("batch_id"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"))


@query("SELECT CAST(event_id AS INTEGER) AS kafka_partition, CAST(lsn AS BIGINT) AS value FROM f WHERE event_id % 5 NOT IN (3, 4)")
def metrics_text_parse(spark, sf_dir):
    """A line per change; every fifth is another metric, every fifth has no number."""
    name = F.when(F.col("event_id") % 5 == 3, "processed_offset_total").otherwise("processed_offset")
    value = F.when(F.col("event_id") % 5 == 4, "NaNa").when(F.col("event_id") % 5 == 1, F.concat((F.col("lsn")).cast("string"), F.lit("e0"))).otherwise(F.col("lsn").cast("string"))
    line = F.concat(name, F.lit('{job="ledger",partition="'), F.col("event_id").cast("string"), F.lit('"} '), value)
    return signals.metrics_text(feed.changes(spark, sf_dir).select(line.alias("line")), "processed_offset").withColumnRenamed("partition", "kafka_partition")


_LAG = """, en AS (SELECT part, max(off) + 1 AS e FROM f GROUP BY 1), ev AS (SELECT part, max(off) + 1 AS p FROM f WHERE batch_id < 5 AND part <> 1 GROUP BY 1),
ga AS (SELECT part, max(off) + 1 AS p FROM f WHERE batch_id < 3 GROUP BY 1),
lg AS (SELECT part AS kafka_partition, e AS end_offset, coalesce(ev.p, ga.p, 0) AS processed, greatest(e - coalesce(ev.p, ga.p, 0), 0) AS lag FROM en LEFT JOIN ev USING (part) LEFT JOIN ga USING (part))"""


def _lag(spark, sf_dir) -> DataFrame:
    rows = feed.changes(spark, sf_dir)
    upto = lambda n: rows.filter(F.col("batch_id") < n).groupBy("partition").agg((F.max("offset") + 1).alias("processed"))
    return signals.consumer_lag(signals.end_offsets(rows), upto(5).filter("partition <> 1"), upto(3))


@query(_LAG + " SELECT * FROM lg")
def consumer_lag(spark, sf_dir):
    return _lag(spark, sf_dir).withColumnRenamed("partition", "kafka_partition")


@query(_LAG + " SELECT max(lag) AS max_lag, max(lag) - min(lag) AS spread, CAST(sum(lag) AS BIGINT) AS total FROM lg")
def lag_spread(spark, sf_dir):
    return _lag(spark, sf_dir).agg(F.max("lag").alias("max_lag"), (F.max("lag") - F.min("lag")).alias("spread"), F.sum("lag").alias("total"))


def _samples(spark, sf_dir) -> DataFrame:
    """Sixteen series of a counter that sometimes falls."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select((F.col("user_id") % 16).alias("series"), F.col("event_id").alias("t"), (F.col("event_id") * 3 + (F.col("event_id") % 5) * 40).alias("v"))


_SAMPLES = ", sm AS (SELECT user_id % 16 AS series, event_id AS t, event_id * 3 + (event_id % 5) * 40 AS v FROM events)"
_W = "OVER (PARTITION BY series ORDER BY t RANGE BETWEEN {} PRECEDING AND CURRENT ROW)"


@query(_SAMPLES + f""", r AS (SELECT series, t, v, first_value(v) {_W.format(60)} AS fv, first_value(t) {_W.format(60)} AS ft FROM sm)
SELECT series, t, greatest(coalesce(CASE WHEN t > ft THEN (v - fv) / (t - ft) END, 0.0), 0.0)::DOUBLE AS rate FROM r""")
def events_in_rate(spark, sf_dir):
    return signals.rate(_samples(spark, sf_dir), 60)


@query(_SAMPLES + f" SELECT series, t, CAST(sum(v) {_W.format(30)} AS BIGINT) / 30.0::DOUBLE AS per_second FROM sm")
def events_out_rate(spark, sf_dir):
    return signals.moving_sum(_samples(spark, sf_dir), 30)


@query(_SAMPLES + f" SELECT series, t, v - first_value(v) {_W.format(60)} AS growth FROM sm")
def dlq_growth(spark, sf_dir):
    return signals.growth(_samples(spark, sf_dir), 60)


@query("SELECT batch_id, count(*) FILTER (rejection_reason <> '') / greatest(count(*), 1)::DOUBLE AS rate, count(*) FILTER (rejection_reason <> '') / greatest(count(*), 1)::DOUBLE >= 0.001 AS alert FROM t GROUP BY 1")
def dlq_rate(spark, sf_dir):
    ratio = F.count_if(F.col("rejection_reason") != "") / F.greatest(F.count(F.lit(1)), F.lit(1))
    return feed.told(spark, sf_dir).groupBy("batch_id").agg(ratio.alias("rate")).withColumn("alert", F.col("rate") >= 0.001)


_LAST = "(SELECT CAST(floor(epoch(max(source_ts))) AS BIGINT) FROM v)"


@query(f"SELECT batch_id, greatest({_LAST} - CAST(floor(epoch(max(source_ts))) AS BIGINT), 0) AS freshness_s FROM v GROUP BY 1")
def freshness(spark, sf_dir):
    """Behind the newest committed source time of all batches, by batch."""
    rows = feed.valid(spark, sf_dir).select("batch_id", F.unix_seconds(F.col("source_ts").cast("timestamp")).alias("s"))
    newest = rows.agg(F.max("s").alias("now"))
    each = rows.groupBy("batch_id").agg(F.max("s").alias("m")).join(newest, F.lit(True))  # one row
    return each.select("batch_id", F.greatest(F.col("now") - F.col("m"), F.lit(0)).alias("freshness_s"))


@query("""SELECT event_id // 60 AS minute, count(*) AS samples, quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95
  FROM events WHERE event_id % 90 <= 60 AND event_id % 8 <> 0 GROUP BY 1""")
def freshness_percentiles(spark, sf_dir):
    """Over the whole table, minute by minute: of the samples that tell of latency, the nearest-rank percentiles."""
    n = F.col("event_id")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(n.alias("t"), F.col("value").alias("freshness"), (n - n % 90).alias("last_batch"), (n % 8 == 0).alias("caught_up"))
    told = signals.freshness_samples(rows).withColumn("minute", F.expr("t div 60"))
    return signals.nearest_rank(told.groupBy("minute"), "freshness", {"p50": 0.5, "p95": 0.95}, F.count(F.lit(1)).alias("samples"))


@query(_SAMPLES + f" SELECT series, t, count(*) {_W.format(100)} AS n FROM sm")
def sliding_window_samples(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("series").orderBy("t").rangeBetween(-100, 0)
    return _samples(spark, sf_dir).select("series", "t", F.count(F.lit(1)).over(w).alias("n"))


@query("""SELECT event_id, coalesce(event_id % 3 = 0 AND (CASE WHEN event_id % 13 = 0 THEN true ELSE event_id % 40 >= 15 END) AND event_id % 50 >= 15
  AND (CASE WHEN event_id % 17 = 0 THEN false ELSE event_id % 60 >= 15 END), false) AS drained FROM events""")
def drained_flag(spark, sf_dir):
    n = F.col("event_id")
    at = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        n, (n % 3).alias("lag"), F.lit(1000).alias("now"), F.when(n % 13 != 0, 1000 - n % 40).alias("batch"), (1000 - n % 50).alias("end"), F.when(n % 17 != 0, 1000 - n % 60).alias("source")
    )
    return at.select("event_id", signals.drained(*(F.col(c) for c in ("lag", "now", "batch", "end", "source"))).alias("drained"))


@query("""
, i AS (SELECT event_id, CASE WHEN event_id % 29 <> 0 THEN 1000 + event_id % 100 END AS src, 1000 AS lake, event_id % 7 AS q, (event_id % 5) * 2.0::DOUBLE AS r, (event_id % 4) * 0.5::DOUBLE AS p, event_id % 6 = 0 AS dr FROM events),
j AS (SELECT *, src - lake - q AS diff, CAST(ceil(greatest(r, 0.0) * greatest(p, 0.0) * 1.5) AS BIGINT) AS allowed FROM i)
SELECT event_id, diff, allowed, CASE WHEN src IS NULL THEN 'unknown' WHEN dr AND diff <> 0 THEN 'mismatch' WHEN abs(diff) <= allowed THEN 'in_sync' ELSE 'catching_up' END AS state FROM j""")
def parity_badge(spark, sf_dir):
    n = F.col("event_id")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    badge = signals.parity_badge(
        F.when(n % 29 != 0, 1000 + n % 100), F.lit(1000), n % 7, (n % 5) * F.lit(2.0), (n % 4) * F.lit(0.5), n % 6 == 0
    )
    return rows.select("event_id", badge.alias("b")).select("event_id", "b.diff", "b.allowed", "b.state")


@query(_STAMPED + f", ls AS (SELECT commit_version, max(t) AS t FROM ct GROUP BY 1) SELECT commit_version, {NOW} - t AS age_s, CASE WHEN {NOW} - t >= 300 THEN 'red' WHEN {NOW} - t >= 100 THEN 'yellow' ELSE 'green' END AS level FROM ls")
def inconsistency_window(spark, sf_dir):
    each = _stamped(spark, sf_dir).groupBy(F.col("_commit_version").alias("commit_version")).agg(F.max("t").alias("t"))
    age = F.lit(NOW) - F.col("t")
    return each.select("commit_version", age.alias("age_s"), F.when(age >= 300, "red").when(age >= 100, "yellow").otherwise("green").alias("level"))


@query("""SELECT event_id AS id, CASE WHEN event_id % 10 = 0 THEN 'NOT_REGISTERED' WHEN event_id % 10 = 1 THEN 'UNREACHABLE' WHEN event_id % 10 = 2 THEN 'PAUSED'
  WHEN event_id % 10 = 3 THEN 'FAILED' WHEN event_id % 10 = 4 THEN 'UNREACHABLE' ELSE 'RUNNING' END AS state FROM events""")
def connector_state(spark, sf_dir):
    n = F.col("event_id") % 10
    own = F.when(n == 2, "PAUSED").otherwise("RUNNING")
    tasks = F.when(n == 3, F.lit('[{"state":"RUNNING"},{"state":"FAILED"},{"state":"PAUSED"}]')).otherwise(F.lit('[{"state":"RUNNING"}]'))
    body = F.when(n == 4, "garbage").otherwise(F.concat(F.lit('{"connector":{"state":"'), own, F.lit('"},"tasks":'), tasks, F.lit("}")))
    status = F.when(n == 0, 404).when(n == 1, 503).otherwise(200)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), status.alias("http_status"), body.alias("body"))
    return signals.connector_state(rows)


# Alerts and paging

#: Name: condition over a snapshot row (lag, state, freshness, caught_up, growth, parity), and the seconds for which it must hold.
RULES = {
    "consumer_lag_high": ("lag > 1000", 30),
    "connector_not_running": ("state <> '' and state <> 'RUNNING'", 10),
    "freshness_high": ("not caught_up and freshness > 120", 30),
    "dlq_growth": ("growth >= 5", 0),
    "parity_mismatch": ("parity = 'mismatch'", 0),
}
SNAPSHOT = {
    "t": "event_id",
    "series": "user_id % 4",
    "lag": "(event_id * 7) % 1500",
    "state": "case when event_id % 90 < 25 then 'PAUSED' when event_id % 90 between 40 and 45 then 'FAILED' else 'RUNNING' end",
    "freshness": "(event_id * 2) % 200",
    "caught_up": "event_id % 700 < 200",
    "growth": "(event_id * 11) % 9",
    "parity": "case when event_id % 31 = 0 then 'mismatch' else 'in_sync' end",
}
_SNAP = ", sn AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in SNAPSHOT.items()) + " FROM events)"
_ACTIVE = ", ac AS (" + " UNION ALL ".join(f"SELECT '{r}-' || series AS rule, t, {e} AS active, {hold} AS hold FROM sn" for r, (e, hold) in RULES.items()) + ")"


def _evaluated(spark, sf_dir) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*(f"{e} as {c}" for c, e in SNAPSHOT.items()))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.expr(e).alias("active"), F.lit(hold).alias("hold")) for r, (e, hold) in RULES.items()))
    each = rows.select("series", "t", F.inline(rules))
    return each.select(F.concat("rule", F.lit("-"), F.col("series").cast("string")).alias("rule"), "t", "active", "hold")


@query(_SNAP + _ACTIVE + " SELECT rule, count(*) AS samples, count(*) FILTER (active) AS active FROM ac GROUP BY 1")
def alert_rules_eval(spark, sf_dir):
    return _evaluated(spark, sf_dir).groupBy("rule").agg(F.count(F.lit(1)).alias("samples"), F.count_if("active").alias("active"))


_ALERTS = _SNAP + _ACTIVE + """
, g AS (SELECT *, count(*) FILTER (NOT active) OVER (PARTITION BY rule ORDER BY t) AS run,
         min(CASE WHEN NOT active THEN t END) OVER (PARTITION BY rule ORDER BY t ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS off FROM ac),
h AS (SELECT *, min(t) OVER (PARTITION BY rule, run) AS began FROM g WHERE active),
al AS (SELECT rule, min(t) AS fired_at, min(off) AS resolved_at FROM h WHERE t - began >= hold GROUP BY rule, run)"""


@query(_ALERTS + " SELECT * FROM al")
def alert_intervals(spark, sf_dir):
    return signals.alert_intervals(_evaluated(spark, sf_dir))


@query(_ALERTS + """, mv AS (SELECT rule, fired_at AS t, 'firing' AS state FROM al UNION ALL SELECT rule, resolved_at, 'resolved' FROM al WHERE resolved_at IS NOT NULL),
nm AS (SELECT row_number() OVER (ORDER BY t, rule, state) AS seq, * FROM mv) SELECT * FROM nm WHERE seq > 20""")
def alerts_since_seq(spark, sf_dir):
    """State changes after a sequence number that a client has seen."""
    return signals.state_changes(signals.alert_intervals(_evaluated(spark, sf_dir))).filter("seq > 20")


@query(_ALERTS + """, ck AS (SELECT rule, t, 'op' || t % 3 AS actor FROM ac WHERE active AND t % 7 = 0),
aa AS (SELECT al.rule, fired_at, resolved_at, min(t) AS acked_at FROM al LEFT JOIN ck ON ck.rule = al.rule AND t >= fired_at AND (resolved_at IS NULL OR t < resolved_at) GROUP BY ALL)
SELECT *, 'op' || acked_at % 3 AS acked_by, CASE WHEN resolved_at IS NOT NULL THEN 'resolved' WHEN acked_at IS NOT NULL THEN 'acknowledged' ELSE 'firing' END AS state FROM aa""")
def alert_states(spark, sf_dir):
    """Alerts with the first acknowledgement that came while they were live."""
    rows = _evaluated(spark, sf_dir)
    acks = rows.filter("active and t % 7 = 0").select("rule", "t", F.concat(F.lit("op"), (F.col("t") % 3).cast("string")).alias("actor"))
    return signals.acknowledged(signals.alert_intervals(rows), acks)


@query("""
, au AS (SELECT event_id AS id, user_id AS actor, event_type AS action FROM events WHERE event_id < 900 ORDER BY event_id DESC LIMIT 21),
ra AS (SELECT *, row_number() OVER (ORDER BY id DESC) AS n FROM au)
SELECT id, actor, action, CASE WHEN (SELECT count(*) FROM ra) = 21 THEN (SELECT id FROM ra WHERE n = 20) ELSE 0 END AS next_cursor FROM ra WHERE n <= 20""")
def audit_page(spark, sf_dir):
    log = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("id"), F.col("user_id").alias("actor"), F.col("event_type").alias("action"))
    return audit.page(log, 900, 20)
