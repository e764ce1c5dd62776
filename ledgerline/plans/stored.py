"""The ledger in storage: the feed's batches merged into a versioned table and entered in a batch ledger, once in an application."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.dedup import latest
from ..streaming.job import Ledger
from ..streaming.table import VersionedTable
from . import feed

#: A fixed present of the queries: seconds. The last of the batches is committed 30 s before it, one a minute.
NOW = 1_700_000_000
BATCHES = 9
APP, QUERY = "ledgerline", "feed"

#: Rows and seconds of the merges that were made, for the bench.
timings: list[tuple[int, float]] = []
_paths: dict[tuple[str, str], str] = {}


def _path(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _paths or not storage.exists(spark, _paths[key]):
        path = storage.fresh_path(spark, "ledger")
        rows, kept, done = feed.valid(spark, sf_dir), VersionedTable(spark, f"{path}/table"), Ledger(spark, f"{path}/batches")
        for n in range(BATCHES):
            at = NOW - 30 - 60 * (BATCHES - 1 - n)
            began = time.perf_counter()
            counts = kept.merge(latest(rows.filter(F.col("batch_id") == n)), [APP, QUERY, n], now=at)
            timings.append((counts["staged"], round(time.perf_counter() - began, 3)))
            if n < 5:  # as if the job had stopped between the table and its ledger
                done.add(APP, QUERY, n, at)
        _paths[key] = path
    return _paths[key]


def table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Version n + 1 is batch n."""
    return VersionedTable(spark, f"{_path(spark, sf_dir)}/table")


def ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """The first five batches are entered."""
    return Ledger(spark, f"{_path(spark, sf_dir)}/batches")
