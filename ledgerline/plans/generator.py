"""A deterministic change workload: inserts, updates and deletes, with an optional hot merchant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _draw(n: int, *what) -> F.Column:
    """An evenly spread number below n that depends on the arguments alone."""
    return F.pmod(F.xxhash64(*what), F.lit(n))


def workload(spark: SparkSession, operations: int, seed: int = 0, whale: bool = False) -> DataFrame:
    """Flat changes of about 70 % inserts, 20 % updates and 10 % deletes of earlier ids, in lsn order.

    With `whale`, 40 % of the rows belong to one merchant and 3 % have large amounts.
    """
    n, s = F.col("id"), F.lit(seed)
    kind = _draw(10, s, F.lit("op"), n)
    op = F.when((n == 0) | (kind < 7), "c").when(kind < 9, "u").otherwise("d")
    own = F.when(op == "c", n).otherwise(_draw(1 << 30, s, F.lit("of"), n) % F.greatest(n, F.lit(1)))
    h = F.md5(F.concat_ws("-", s.cast("string"), own.cast("string")))
    cut = lambda a, size: F.substring(h, a, size)
    ident = F.concat(cut(1, 8), F.lit("-"), cut(9, 4), F.lit("-4"), cut(14, 3), F.lit("-8"), cut(18, 3), F.lit("-"), cut(21, 12))
    merchant = 1 + _draw(20, s, F.lit("merchant"), own)
    if whale:
        merchant = F.when(_draw(100, s, F.lit("whale"), own) < 40, 7).otherwise(merchant)
    amount = 100 + _draw(99_801, s, F.lit("amount"), n)
    if whale:
        amount = F.when(_draw(100, s, F.lit("large"), n) < 3, 500_000 + _draw(4_500_001, s, F.lit("amount"), n)).otherwise(amount)
    pick = lambda values, *what: F.element_at(F.array(*map(F.lit, values)), (1 + _draw(len(values), s, *what)).cast("int"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + n)
    return spark.range(operations).select(
        op.alias("op"), ident.alias("transaction_id"), F.concat(F.lit("MERCH_"), F.lpad(merchant.cast("string"), 3, "0")).alias("merchant_id"), amount.alias("amount_minor"),
        pick(["USD", "EUR", "GBP", "JPY"], F.lit("currency"), own).alias("currency"), pick(["PENDING", "SETTLED", "FAILED"], F.lit("status"), n).alias("status"),
        pick(["AUTHORIZATION", "CAPTURE", "REFUND", "CHARGEBACK"], F.lit("event"), own).alias("event_type"), at.alias("created_at"), at.alias("updated_at"),
        (1_000_000 + n).alias("lsn"), at.alias("source_ts"), (n % 3).cast("int").alias("partition"), n.alias("offset"), (op == "d").alias("is_delete"),
    )


def sample(rows: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """n rows at random, or all if there are fewer: each partition's first n of a random order, then the first n of these."""
    return rows.orderBy(F.rand(seed)).limit(n)
