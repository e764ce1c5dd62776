"""The sequence-guarded merge as one join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merged(target: DataFrame, staged: DataFrame, key: str = "transaction_id") -> DataFrame:
    """target after the merge, with `_change`: kept, insert or update.

    A staged row replaces its target row if its lsn is strictly higher, and is inserted if there is none, tombstones
    included. A null lsn on either side never updates, and null keys match nothing: both rows stay. staged has one row per key; other columns than target's are ignored.
    """
    t, s = target.withColumn("_held", F.lit(True)).alias("t"), staged.select(*target.columns).alias("s")
    new = F.col("t._held").isNull()  # not the key: a target row may have none
    newer = F.coalesce(F.col("s.lsn") > F.col("t.lsn"), F.lit(False))
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    change = F.when(new, "insert").when(newer, "update").otherwise("kept")
    take = [F.when(new | newer, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns]
    return joined.select(*take, change.alias("_change"))
