"""Latest change per key, and the ledger's closed form."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import LEDGER_COLUMNS


def latest(changes: DataFrame, key: str = "transaction_id", *within: str) -> DataFrame:
    """Each key's change with the highest lsn (a null one last), then the highest offset; one for each value of `within`, if given."""
    order = [F.col("lsn").desc(), *([F.col("offset").desc()] if "offset" in changes.columns else [])]
    return changes.withColumn("_rank", F.row_number().over(Window.partitionBy(key, *within).orderBy(*order))).filter("_rank = 1").drop("_rank")


def closed_form(valid: DataFrame, key: str = "transaction_id", columns: list[str] = LEDGER_COLUMNS) -> DataFrame:
    """What merging batch after batch leaves: per key the first by lsn descending, batch_id, offset descending.

    Within a batch the highest offset wins; across batches a merge needs a strictly higher lsn, so the first batch does.
    One window with a rank limit: the ranks are cut before and after the one shuffle.
    """
    order = [F.col("lsn").desc(), F.col("batch_id").asc(), F.col("offset").desc()]
    ranked = valid.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rank = 1").select(*columns)


def change_feed(valid: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Row images that merging batch after batch emits: LEDGER_COLUMNS, _change_type, _commit_version (batch_id + 1).

    A batch's latest change per key applies if no earlier batch had one as high: then it's an insert, or an update with the image
    before (the last that applied) and after.
    """
    per_batch = Window.partitionBy(key, "batch_id").orderBy(F.col("lsn").desc(), F.col("offset").desc())
    staged = valid.withColumn("_rank", F.row_number().over(per_batch)).filter("_rank = 1").drop("_rank")
    before = Window.partitionBy(key).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, -1)
    applied = staged.withColumn("_high", F.max("lsn").over(before)).withColumn("_nth", F.count(F.lit(1)).over(before))
    applied = applied.filter((F.col("_nth") == 0) | (F.col("lsn") > F.col("_high")))
    image = F.struct(*LEDGER_COLUMNS)
    order = Window.partitionBy(key).orderBy("batch_id")
    told = applied.withColumn("_image", image).withColumn("_previous", F.lag("_image").over(order))
    version = (F.col("batch_id") + 1).alias("_commit_version")
    rows = told.select(
        version,
        F.inline(
            F.array_compact(
                F.array(
                    F.when(F.col("_previous").isNotNull(), F.struct(F.lit("update_preimage").alias("_change_type"), F.col("_previous").alias("_row"))),
                    F.struct(F.when(F.col("_previous").isNull(), "insert").otherwise("update_postimage").alias("_change_type"), F.col("_image").alias("_row")),
                )
            )
        ),
    )
    return rows.select("_row.*", "_change_type", "_commit_version")
