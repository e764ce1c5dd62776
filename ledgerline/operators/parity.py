"""Does the lake equal its source? Each check is one join on the key; null keys match nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARED = ["merchant_id", "amount_minor", "currency", "status", "event_type"]


def live(lake: DataFrame) -> DataFrame:
    """Rows that aren't tombstones; an unknown flag is not live."""
    return lake.filter(F.col("is_delete") == F.lit(False))


def missing(source: DataFrame, lake: DataFrame) -> DataFrame:
    return source.join(lake.select("transaction_id"), "transaction_id", "left_anti")


def extra(source: DataFrame, lake: DataFrame) -> DataFrame:
    return lake.join(source.select("transaction_id"), "transaction_id", "left_anti")


def quarantined(source: DataFrame, lake: DataFrame, dead_keys: DataFrame) -> DataFrame:
    return missing(source, lake).join(dead_keys, "transaction_id", "left_semi")


def unaccounted(source: DataFrame, lake: DataFrame, dead_keys: DataFrame) -> DataFrame:
    return missing(source, lake).join(dead_keys, "transaction_id", "left_anti")


def mismatch(source: DataFrame, lake: DataFrame, null_safe: bool = False) -> DataFrame:
    """Keys in both with a different value: transaction_id and both sides' amounts. Null against a value differs only if null_safe."""
    s, k = source.alias("s"), lake.alias("k")
    differs: Column = F.lit(False)
    for c in COMPARED:
        a, b = F.col(f"s.{c}"), F.col(f"k.{c}")
        differs = differs | (~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False)))
    both = s.join(k, F.col("s.transaction_id") == F.col("k.transaction_id")).filter(differs)
    return both.select("s.transaction_id", F.col("s.amount_minor").alias("source_amount"), F.col("k.amount_minor").alias("lake_amount"))


def duplicates(rows: DataFrame) -> DataFrame:
    return rows.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def report(source: DataFrame, lake: DataFrame, dead_keys: DataFrame, tolerance: int = 0) -> DataFrame:
    """One row of counters and a verdict, from a single full outer join of both sides and the dead-letter keys."""
    columns = F.struct(*COMPARED)
    s = source.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("_s"), F.first(columns).alias("_sv"))
    k = lake.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("_k"), F.first(columns).alias("_kv"))
    d = dead_keys.select("transaction_id").distinct().withColumn("_d", F.lit(True))
    both = s.join(k, "transaction_id", "full_outer").join(d, "transaction_id", "left")
    differs = F.lit(False)
    for c in COMPARED:
        differs = differs | F.coalesce(F.col(f"_sv.{c}") != F.col(f"_kv.{c}"), F.lit(False))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    gone = F.col("_k").isNull()
    counted = both.agg(
        total("_s").alias("source_rows"),
        total("_k").alias("lake_rows"),
        total(F.when(gone, F.col("_s"))).alias("missing"),
        total(F.when(gone & F.col("_d"), F.col("_s"))).alias("quarantined"),
        total(F.when(F.col("_s").isNull(), F.col("_k"))).alias("extra"),
        total(F.when(differs, 1)).alias("mismatched"),
        total(F.when(F.col("_k") > 1, 1)).alias("duplicate_keys"),
    )
    rest = F.col("missing") - F.col("quarantined")
    fine = (F.greatest(rest - tolerance, F.lit(0)) == 0) & (F.col("extra") == 0) & (F.col("mismatched") == 0) & (F.col("duplicate_keys") == 0)
    return counted.withColumn("unaccounted", rest).withColumn("verdict", F.when(fine, "PASS").otherwise("FAIL"))
