"""Progress of streaming queries as a table, and statistics of the lake that are kept per version."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..operators import aggregate
from .table import VersionedTable


class ProgressLog(StreamingQueryListener):
    """Keeps the last `most` progress documents of the session's queries; add it by spark.streams.addListener."""

    def __init__(self, most: int = 1000):
        self._rows: list[tuple[int, str]] = []
        self._most, self._lock = most, threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._lock:
            self._rows.append((event.progress.batchId, event.progress.json))
            del self._rows[: -self._most]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        """id (the batch), body."""
        with self._lock:
            return spark.createDataFrame(list(self._rows), "id long, body string")

    def last_input_rows(self) -> int | None:
        with self._lock:
            return json.loads(self._rows[-1][1])["numInputRows"] if self._rows else None


class LakeStats:
    """live, tombstones, max_lsn, version and commit time; computed again only for another version."""

    def __init__(self, table: VersionedTable):
        self.table, self._kept, self._lock = table, None, threading.Lock()

    def get(self) -> dict:
        with self._lock:
            m = self.table.manifest()
            if self._kept is None or self._kept["version"] != m.version:
                row = aggregate.lake_stats(self.table.read(m.version)).first()
                self._kept = row.asDict() | {"version": m.version, "last_commit": m.committed_at}
            return self._kept
