"""Validation rules of a change, as column expressions, and the split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CURRENCIES, UUID_V4

#: Reference keys beyond which rules look them up by a join rather than in a literal set.
LITERAL_KEYS = 5000


def rejection(known_merchant: Column, currencies: Sequence[str] = tuple(CURRENCIES)) -> Column:
    """The reasons against a change, comma-joined in a fixed order; empty if there is none.

    Deletes are held to the id rule alone. A null amount or currency passes; a null merchant or id doesn't; a null
    is_delete counts as false.
    """
    kept = ~F.coalesce(F.col("is_delete"), F.lit(False))
    return F.concat_ws(
        ",",
        F.when(kept & (F.col("amount_minor") < 0), "NEGATIVE_AMOUNT"),
        F.when(kept & ~F.col("currency").isin(*currencies), "INVALID_CURRENCY"),
        F.when(~F.coalesce(F.col("transaction_id").rlike(UUID_V4), F.lit(False)), "INVALID_UUID"),
        F.when(kept & ~F.coalesce(known_merchant, F.lit(False)), "UNKNOWN_MERCHANT"),
    )


def judged(changes: DataFrame, merchants: Sequence[str] | DataFrame) -> DataFrame:
    """The changes with their `rejection_reason` (empty if valid).

    merchants: ids, or a table with `merchant_id` for sets of any size. A small set becomes a literal of the plan; a table is
    joined, broadcast by Spark itself if its size allows. An empty set raises: all rows would be rejected.
    """
    if isinstance(merchants, DataFrame):
        known = merchants.select(F.col("merchant_id").alias("_known")).filter("_known is not null").distinct()
        if known.isEmpty():
            raise ValueError("the merchant set must not be empty")
        told = changes.join(known, F.col("merchant_id") == F.col("_known"), "left")
        return told.withColumn("rejection_reason", rejection(F.col("_known").isNotNull())).drop("_known")
    if not merchants:
        raise ValueError("the merchant set must not be empty")
    if len(merchants) > LITERAL_KEYS:
        return judged(changes, changes.sparkSession.createDataFrame([(m,) for m in merchants], "merchant_id string"))
    return changes.withColumn("rejection_reason", rejection(F.col("merchant_id").isin(*sorted(merchants))))


def validate(changes: DataFrame, merchants: Sequence[str] | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows with the columns of the input, and rejected rows with `rejection_reason` too."""
    told = judged(changes, merchants)
    return told.filter("rejection_reason = ''").select(*changes.columns), told.filter("rejection_reason <> ''")
