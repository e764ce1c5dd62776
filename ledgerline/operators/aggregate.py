"""Keyed aggregates over change feeds, plain and salted, and digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_key(rows: DataFrame, key: str = "merchant_id") -> DataFrame:
    """total_minor and n per key. Partial sums are made before the shuffle."""
    return rows.groupBy(key).agg(F.sum("amount_minor").alias("total_minor"), F.count(F.lit(1)).alias("n"))


def salted(rows: DataFrame, key: str = "merchant_id", salts: int = 8, on: str = "transaction_id") -> DataFrame:
    """The same in two phases: rows of a hot key are dealt to `salts` tasks, whose sums are then added."""
    part = dealt(rows, key, salts, on).groupBy(key, "_salt").agg(F.sum("amount_minor").alias("_sum"), F.count(F.lit(1)).alias("_n"))
    return part.groupBy(key).agg(F.sum("_sum").alias("total_minor"), F.sum("_n").alias("n"))


def dealt(rows: DataFrame, key: str, salts: int, on: str) -> DataFrame:
    """Rows dealt by key and salt; with one salt, by key alone."""
    return rows.select(key, "amount_minor", F.pmod(F.hash(on), F.lit(salts)).alias("_salt")).repartition(key, "_salt")


def top(totals: DataFrame, k: int = 5, key: str = "merchant_id") -> DataFrame:
    return totals.orderBy(F.col("total_minor").desc_nulls_last(), F.col(key)).limit(k)


def digest(live: DataFrame) -> DataFrame:
    return live.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("amount_minor"), F.lit(0)).alias("total_minor"))


def lake_stats(lake: DataFrame) -> DataFrame:
    """live, tombstones, max_lsn (0 of an empty table)."""
    return lake.agg(
        F.count_if(~F.col("is_delete")).alias("live"), F.count_if("is_delete").alias("tombstones"), F.coalesce(F.max("lsn"), F.lit(0)).alias("max_lsn")
    )


def snapshot_transition(changes: DataFrame, snapshot) -> DataFrame:
    """Did the stream begin behind the snapshot? snapshot: which rows belong to it. Nothing to compare: `skipped`."""
    ends = changes.agg(F.max(F.when(snapshot, F.col("lsn"))).alias("snapshot_max_lsn"), F.min(F.when(~snapshot, F.col("lsn"))).alias("stream_min_lsn"))
    both = F.col("snapshot_max_lsn").isNotNull() & F.col("stream_min_lsn").isNotNull()
    return ends.withColumn("verdict", F.when(~both, "skipped").when(F.col("snapshot_max_lsn") < F.col("stream_min_lsn"), "clean").otherwise("not clean"))


def throughput(feed: DataFrame, now: int, lookback: int) -> DataFrame:
    """Rows and rows a second of the last `lookback` seconds and of as many before; t is the commit time in seconds."""
    t = F.col("t")
    wanted = feed.filter(F.col("_change_type").isin("insert", "update_postimage", "delete") & (t >= now - 2 * lookback))
    counted = wanted.agg(F.count_if(t >= now - lookback).alias("recent"), F.count_if(t < now - lookback).alias("baseline"))
    return counted.select("recent", "baseline", (F.col("recent") / float(lookback)).alias("recent_rps"), (F.col("baseline") / float(lookback)).alias("baseline_rps"))


def trend_verdicts(stats: DataFrame, dlq_rate: float = 0.001, tolerance: float = 0.5) -> DataFrame:
    """stats: recent, recent_rps, baseline_rps, dlq, nulls. Verdicts and their number of alerts; observers only."""
    recent, base, now = F.col("recent"), F.col("baseline_rps"), F.col("recent_rps")
    dead = F.when(F.col("dlq") < 0, "alert").when(recent.isNull() | (recent == 0), "skipped").when(F.col("dlq") / F.greatest(recent, F.lit(1)) >= dlq_rate, "alert").otherwise("ok")
    outside = (now < base * (1 - tolerance)) | (now > base * (1 + tolerance))
    flow = F.when(recent.isNull() | (base < 0.1), "skipped").when(~outside, "ok").when(recent > 50, "alert").otherwise("skipped")
    nulls = F.when(F.col("nulls").isNull(), "skipped").when(F.col("nulls") > 0, "alert").otherwise("ok")
    told = stats.select(dead.alias("dlq_verdict"), flow.alias("throughput_verdict"), nulls.alias("null_verdict"))
    return told.withColumn("alerts", sum((F.when(F.col(c) == "alert", 1).otherwise(0) for c in told.columns), F.lit(0)))


def spread(rows: DataFrame) -> DataFrame:
    """min, median and max of the rows that the partitions with any have: how evenly an exchange deals."""
    each = rows.groupBy(F.spark_partition_id().alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.min("n").alias("least"), F.expr("percentile_disc(0.5) within group (order by n)").alias("median"), F.max("n").alias("most"))
