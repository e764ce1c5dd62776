"""Helpers shared by the training-data operators: session settings, shared storage and text primitives."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import fresh_path, remove

#: Bounds on what one Arrow batch brings to a Python worker; texts may be long, so bytes bind before rows do.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    """Bound Arrow batches. Plans run after an operator returns, so the settings stay on the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


@contextmanager
def shuffle_files_freed(spark: SparkSession):
    """Within it, an execution's shuffle files go when it ends, so that disk holds one phase at a time."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


class Stash:
    """A table written to the shared folder: it cuts lineage and survives lost executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = fresh_path(self.spark, name)
        with shuffle_files_freed(self.spark):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        if (made := _made.get()) is not None:
            made.append(self)

    def drop(self) -> None:
        remove(self.spark, self.path)


_made: ContextVar[list[Stash] | None] = ContextVar("made", default=None)


def stash(df: DataFrame, name: str) -> DataFrame:
    return Stash(df, name).df


@contextmanager
def tidy() -> Iterator[Callable[[DataFrame, str], Stash]]:
    """Stashes that are made within it go when it ends, but for those made by the function it gives.

    Operators return frames that read their last stashes. Whoever writes such a frame out can thereby free them.
    """
    outer, made = _made.get(), []
    token = _made.set(made)

    def keep(df: DataFrame, name: str) -> Stash:
        kept = Stash(df, name)
        made.remove(kept)
        if outer is not None:
            outer.append(kept)
        return kept

    try:
        yield keep
    finally:
        _made.reset(token)
        for s in made:
            s.drop()


def unused(docs: DataFrame, *names: str) -> list[str]:
    """Column names like these that the table lacks, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def held_out(doc_id) -> F.Column:
    """True for documents that no model learns from: crc32 of the id as text, modulo 4, is 2 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def input_bytes(docs: DataFrame, column: str) -> tuple[int, int]:
    """Rows and UTF-8 bytes of a column, by one narrow aggregate."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


#: ASCII upper case becomes lower case and everything in ASCII but letters and digits becomes a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def folded_words(text: bytes | None) -> list[bytes]:
    """Words without case and ASCII punctuation, of UTF-8 bytes."""
    return text.translate(FOLD).split() if text else []
