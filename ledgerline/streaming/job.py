"""The ledger's streaming job: decode, validate, quarantine, deduplicate, merge, record, report.

Exactly once by two means that work alone as well. The merge takes strictly higher sequence numbers only, so merging a batch
again changes nothing; and a batch ledger, keyed by application, query and batch id, skips batches that are
committed. Dead letters are at least once: a crash between them and the ledger writes them again.
"""

from __future__ import annotations

import hashlib
import json
import signal
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.rules import validate
from ..functions.signals import end_offsets, exposition
from ..operators.dedup import latest
from ..sources import dead_letters, envelope
from ..storage import exists, file_system
from .table import VersionedTable


class ReferenceSet:
    """Keys that a loader gives, kept for `ttl` seconds. A failed refresh keeps the old ones; no keys at all is an error."""

    def __init__(self, load: Callable[[], set[str]], ttl: float = 120, clock: Callable[[], float] = time.monotonic):
        self._load, self._ttl, self._clock = load, ttl, clock
        self._keys: set[str] | None = None
        self._at = 0.0

    def keys(self, force: bool = False) -> list[str]:
        if force or self._keys is None or self._clock() - self._at > self._ttl:
            try:
                got = self._load()
                if not got:
                    raise ValueError("the reference set is empty")
                self._keys, self._at = set(got), self._clock()
            except Exception:
                if self._keys is None:
                    raise
        return sorted(self._keys)


class Crash(Exception):
    """Raised by a failpoint."""


#: Batches of a query whose ledger rows share a folder, which a probe reads.
BLOCK = 100


@dataclass
class Ledger:
    """Committed batches as a table: app_id, query_id, batch_id, committed_at (epoch seconds).

    Each query's rows lie in folders of BLOCK batches, so that a probe opens one small folder whatever the number of batches; a
    full folder becomes one file. Rows that a crash leaves twice count once.
    """

    spark: SparkSession
    path: str
    schema: str = "app_id string, query_id string, batch_id long, committed_at long"

    def _folder(self, app: str, query: str, block: int) -> str:
        return f"{self.path}/{hashlib.sha1(json.dumps([app, query]).encode()).hexdigest()[:16]}/{block}"

    def has(self, app: str, query: str, batch: int) -> bool:
        folder = self._folder(app, query, batch // BLOCK)
        if not exists(self.spark, folder):
            return False
        rows = self.spark.read.schema(self.schema).parquet(folder)
        return not rows.filter((F.col("app_id") == app) & (F.col("query_id") == query) & (F.col("batch_id") == batch)).isEmpty()

    def add(self, app: str, query: str, batch: int, now: int) -> None:
        row = self.spark.createDataFrame([(app, query, batch, now)], self.schema).coalesce(1)
        row.write.mode("append").parquet(self._folder(app, query, batch // BLOCK))
        if batch % BLOCK == 0 and batch:
            self.compact(app, query, batch // BLOCK - 1)

    def compact(self, app: str, query: str, block: int) -> None:
        """One file instead of a block's many: it is added first, then the others go."""
        folder = self._folder(app, query, block)
        if not exists(self.spark, folder):
            return
        at, store = file_system(self.spark, folder)
        before = [s.getPath() for s in store.listStatus(at) if s.getPath().getName().startswith("part-")]
        if len(before) > 1:
            self.spark.read.schema(self.schema).parquet(folder).dropDuplicates(["batch_id"]).coalesce(1).write.mode("append").parquet(folder)
            for p in before:
                store.delete(p, False)

    def read(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path).dropDuplicates(["app_id", "query_id", "batch_id"])


@dataclass
class LedgerJob:
    """One application: the table, its batch ledger, dead letters and progress events are folders below `root`."""

    spark: SparkSession
    root: str
    merchants: ReferenceSet
    app_id: str = "ledgerline"
    query_id: str = "default"
    decode: Callable[[DataFrame], DataFrame] = envelope.from_json
    failpoint: str | None = None  # after_dlq, after_merge or after_ledger: crash there, once
    clock: Callable[[], float] = time.time
    push: Callable[[str], None] | None = None  # where gauges go, as text; its failures are told and forgotten
    table: VersionedTable = field(init=False)
    ledger: Ledger = field(init=False)
    _merged: dict | None = field(init=False, default=None)  # batches that the table has recorded, read once

    def __post_init__(self):
        self.table = VersionedTable(self.spark, f"{self.root}/table")
        self.ledger = Ledger(self.spark, f"{self.root}/ledger")

    def _crash(self, name: str) -> None:
        if self.failpoint == name:
            self.failpoint = None
            raise Crash(name)

    def process(self, raw: DataFrame, batch_id: int, commit: bool = True) -> dict | None:
        """One batch of (value, partition, offset). A batch without rows does nothing; one whose rows don't decode is recorded."""
        began = self.clock()
        raw = raw.persist()
        try:
            n_raw = raw.count()
            if not n_raw or (commit and self.ledger.has(self.app_id, self.query_id, batch_id)):
                return None
            flat = envelope.flatten(self.decode(raw)).persist()
            try:
                valid, invalid = validate(flat, self.merchants.keys())
                n_dead = invalid.count()
                if n_dead:
                    stamp = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(self.clock()))
                    letters = dead_letters.payload(invalid, stamp).withColumn("batch_id", F.lit(batch_id).cast("long"))
                    letters.write.mode("append").parquet(f"{self.root}/dead_letters")
                self._crash("after_dlq")
                staged = latest(valid)
                mark = [self.app_id, self.query_id, batch_id] if commit else None
                counts = self._recorded(mark) or self.table.merge(staged, mark, now=int(self.clock()))
                self._crash("after_merge")
                if not commit:
                    return counts
                self.ledger.add(self.app_id, self.query_id, batch_id, int(self.clock()))
                self._crash("after_ledger")
                newest = valid.agg(F.date_format(F.max("source_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("m")).first()["m"] if counts["staged"] else None
                event = {
                    "app_id": self.app_id,
                    "batch_id": batch_id,
                    "input_rows": n_raw,
                    "merged_rows": counts["staged"],
                    "dlq_rows": n_dead,
                    "duration_seconds": round(self.clock() - began, 3),
                    "max_source_ts": newest,
                    "committed_at": int(self.clock()),
                    "end_offsets": {str(r["partition"]): r["end_offset"] for r in end_offsets(raw).collect()},
                }
                self._report(event)
                return event | counts
            finally:
                flat.unpersist()
        finally:
            raw.unpersist()

    def _recorded(self, mark: list | None) -> dict[str, int] | None:
        """Counts of a batch that was merged before a crash kept it from the ledger: the table knows, so it isn't merged again."""
        if mark is None:
            return None
        if self._merged is None:
            self._merged = self.table.batches()
        return self._merged.get(tuple(mark))

    def _report(self, event: dict) -> None:
        """Progress is for observers: a failure to write it is no failure of the batch."""
        try:
            self.spark.createDataFrame([(event["batch_id"], json.dumps(event))], "batch_id long, body string").coalesce(1).write.mode("append").parquet(f"{self.root}/progress")
        except Exception as why:
            print(f"progress event {event['batch_id']} is lost: {why}")
        if self.push is not None:
            gauges = {k: event[k] for k in ("batch_id", "input_rows", "merged_rows", "dlq_rows", "duration_seconds", "committed_at")}
            try:
                self.push(exposition(gauges | {"dlq_ratio": event["dlq_rows"] / max(event["input_rows"], 1)}, event["end_offsets"]))
            except Exception as why:
                print(f"the gauges of batch {event['batch_id']} are lost: {why}")

    def start(self, stream: DataFrame, checkpoint: str, interval: str | None = None) -> StreamingQuery:
        """Run over a stream of (value, partition, offset): each `interval`, or all that is there if none is given."""
        writer = stream.writeStream.foreachBatch(lambda batch, n: self.process(batch, n)).option("checkpointLocation", checkpoint)
        return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()

    def run(self, stream: DataFrame, checkpoint: str, interval: str | None = None, stop_timeout: int = 60) -> None:
        """Start, and stop gracefully on SIGTERM or SIGINT: the batch at work has `stop_timeout` seconds to end."""
        self.spark.conf.set("spark.sql.streaming.stopTimeout", f"{stop_timeout}s")
        asked = threading.Event()
        before = {s: signal.signal(s, lambda *_: asked.set()) for s in (signal.SIGTERM, signal.SIGINT)}
        try:
            query = self.start(stream, checkpoint, interval)
            while not query.awaitTermination(1):
                if asked.is_set():
                    query.stop()
                    break
        finally:
            for s, handler in before.items():
                signal.signal(s, handler)


def read_log(spark: SparkSession, path: str, files_per_batch: int = 1) -> DataFrame:
    """A change log in Parquet files (value, partition, offset) as a stream."""
    return spark.readStream.schema("value binary, partition int, offset long").option("maxFilesPerTrigger", files_per_batch).parquet(path)


def read_range(spark: SparkSession, path: str, ranges: dict[int, tuple[int, int]]) -> DataFrame:
    """A bounded part of a log: for each partition the offsets from a first up to, without, a last one."""
    log = spark.read.schema("value binary, partition int, offset long").parquet(path)
    wanted = F.lit(False)
    for p, (a, b) in ranges.items():
        wanted = wanted | ((F.col("partition") == p) & (F.col("offset") >= a) & (F.col("offset") < b))
    return log.filter(wanted)
