"""What operators did, and which requests they made before: kept in files, so that both outlive the driver."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import exists, file_system
from .replay import PENDING, Outcome


class AuditLog:
    """Entries that are only ever added: id (rises with time), actor, action, target, result, error, idempotency_key, details (JSON)."""

    SCHEMA = "id long, actor string, action string, target string, result string, error string, idempotency_key string, details string"

    def __init__(self, spark: SparkSession, path: str, clock: Callable[[], float] = time.time):
        self.spark, self.path, self._clock, self._last = spark, path, clock, 0

    def add(self, actor: str, action: str, target: str, result: str, error: str = "", key: str = "", details: dict | None = None) -> int:
        """The entry's id: microseconds, made different from the last one's."""
        self._last = max(self._last + 1, int(self._clock() * 1e6))
        row = (self._last, actor, action, target, result, error, key, json.dumps(details or {}))
        self.spark.createDataFrame([row], self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
        return self._last

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def page(self, cursor: int = 0, limit: int = 50) -> DataFrame:
        return page(self.read(), cursor, limit)


def page(log: DataFrame, cursor: int = 0, limit: int = 50, most: int = 200) -> DataFrame:
    """Entries newest first, below a cursor (0: from the newest); `next_cursor` is that of the next page, 0 if there is none.

    A limit outside 1..most is 50. One row more than the page tells whether there are others.
    """
    limit = limit if 0 < limit <= most else 50
    ahead = (log.filter(F.col("id") < cursor) if cursor > 0 else log).orderBy(F.col("id").desc()).limit(limit + 1)
    rows = F.array_sort(F.collect_list(F.struct((-F.col("id")).alias("_place"), F.struct("*").alias("_row"))))  # limit + 1 rows
    packed = ahead.agg(rows.alias("_rows"))
    last = F.when(F.size("_rows") > limit, F.get("_rows", F.lit(limit - 1))["_row"]["id"]).otherwise(0)
    return packed.select(F.explode(F.slice("_rows", 1, limit)).alias("_r"), last.alias("next_cursor")).select("_r._row.*", "next_cursor")


class DurableKeys:
    """Idempotency keys in a folder: results by (actor, key), which other drivers see and a restart keeps.

    A request takes its key by creating a file that must be new; its result is a second file. One that a crash left open is free
    again after `expires` seconds.
    """

    def __init__(self, spark: SparkSession, path: str, expires: float = 120, clock: Callable[[], float] = time.time):
        self.spark, self.path, self._expires, self._clock = spark, path, expires, clock

    def _file(self, actor: str, key: str, kind: str):
        return file_system(self.spark, f"{self.path}/{hashlib.sha256(json.dumps([actor, key]).encode()).hexdigest()}.{kind}")

    @staticmethod
    def _write(at, store, what: dict) -> bool:
        """False if the file is there."""
        try:
            out = store.create(at, False)
        except Exception:
            if store.exists(at):
                return False
            raise
        out.write(bytearray(json.dumps(what).encode()))
        out.close()
        return True

    @staticmethod
    def _read(at, store) -> dict | None:
        if not store.exists(at):
            return None
        stream = store.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()) or b"null")
        finally:
            stream.close()

    def begin(self, actor: str, key: str, request: str) -> tuple[str, Outcome | None]:
        """fresh, replayed (with the result), in_progress or conflict."""
        digest = hashlib.sha256(request.encode()).hexdigest()
        opened = self._file(actor, key, "open")
        for _ in range(3):
            if done := self._read(*self._file(actor, key, "done")):
                return ("replayed", Outcome(**done["outcome"])) if done["digest"] == digest else ("conflict", None)
            if self._write(*opened, {"digest": digest, "began": self._clock()}):
                return "fresh", None
            held = self._read(*opened)
            if held and held["digest"] != digest and self._clock() - held["began"] < self._expires:
                return "conflict", None
            if not held or self._clock() - held["began"] < self._expires:
                return "in_progress", None
            opened[1].delete(opened[0], False)
        return "in_progress", None

    def end(self, actor: str, key: str, outcome: Outcome | None) -> None:
        """Keep a final result; a pending or failed one releases the key."""
        opened = self._file(actor, key, "open")
        held = self._read(*opened)
        if held and outcome is not None and outcome.status != PENDING:
            self._write(*self._file(actor, key, "done"), {"digest": held["digest"], "outcome": asdict(outcome)})
        opened[1].delete(opened[0], False)
