"""Replaying single dead letters: checks, publication with the original sequence number, and what came of it."""

from __future__ import annotations

import hashlib
import json
import time
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import dead_letters, envelope
from .table import VersionedTable

NOT_FOUND, ALREADY_APPLIED, STILL_INVALID, APPLIED, PENDING = "NOT_FOUND", "ALREADY_APPLIED", "STILL_INVALID", "APPLIED", "PENDING"


@dataclass
class Outcome:
    status: str
    lake_lsn: int | None = None
    detail: str = ""


class Idempotency:
    """Results by (actor, key). The same key with another request is a conflict; one in progress is told so until it expires."""

    def __init__(self, most: int = 1000, expires: float = 120, clock: Callable[[], float] = time.monotonic):
        self._kept: OrderedDict[tuple[str, str], tuple[str, float, Outcome | None]] = OrderedDict()
        self._most, self._expires, self._clock = most, expires, clock

    def begin(self, actor: str, key: str, request: str) -> tuple[str, Outcome | None]:
        """fresh, replayed (with the result), in_progress or conflict."""
        digest = hashlib.sha256(request.encode()).hexdigest()
        found = self._kept.get((actor, key))
        if found and found[0] != digest:
            return "conflict", None
        if found and found[2] is not None:
            return "replayed", found[2]
        if found and self._clock() - found[1] < self._expires:
            return "in_progress", None
        self._kept[actor, key] = (digest, self._clock(), None)
        return "fresh", None

    def end(self, actor: str, key: str, outcome: Outcome | None) -> None:
        """Keep a final result; a pending or failed one releases the key."""
        if outcome is None or outcome.status == PENDING:
            self._kept.pop((actor, key), None)
            return
        digest, began, _ = self._kept[actor, key]
        self._kept[actor, key] = (digest, began, outcome)
        while len(self._kept) > self._most:
            self._kept.popitem(last=False)


@dataclass
class Replayer:
    """letters: the parsed dead letters, as a function; publish: appends raw log rows (value, partition, offset)."""

    spark: SparkSession
    table: VersionedTable
    letters: Callable[[], DataFrame]
    merchants: Callable[[], list[str]]
    publish: Callable[[DataFrame], None]
    wait: float = 75
    poll: float = 1
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    keys: Idempotency = field(default_factory=Idempotency)  # or audit.DurableKeys, which a restart keeps
    audit: Callable[..., object] | None = None  # told of each replay: audit.AuditLog.add

    def replay(self, ident: str, actor: str = "", key: str = "") -> Outcome:
        if key:
            state, kept = self.keys.begin(actor, key, json.dumps(["replay", ident]))
            if state == "replayed":
                return kept
            if state != "fresh":
                raise RuntimeError(f"idempotency key {key}: {state}")
        outcome = None
        try:
            outcome = self._replay(ident)
            return outcome
        finally:
            if key:
                self.keys.end(actor, key, outcome)
            if self.audit is not None:
                told = outcome or Outcome("FAILED")
                self.audit(actor, "replay", ident, told.status, "" if told.status == APPLIED else told.detail, key, {"lake_lsn": told.lake_lsn})

    def _lsn(self, transaction_id: str) -> int | None:
        row = self.table.row(transaction_id)
        return row["lsn"] if row else None

    def _replay(self, ident: str) -> Outcome:
        letters = self.letters()
        found = letters.filter(F.col("offset") == int(ident)).limit(1) if ident.isdigit() else letters.limit(0)
        letter = found.first()
        if letter is None:
            return Outcome(NOT_FOUND, detail=f"no dead letter {ident!r}")
        own, lsn = letter["transaction_id"], letter["lsn"]
        held = self._lsn(own)
        if held is not None and held >= lsn:
            return Outcome(ALREADY_APPLIED, held, "the lake holds it; nothing is published")
        reasons = dead_letters.revalidated(found, self.merchants()).first()["rejection_reason"]
        if reasons:
            return Outcome(STILL_INVALID, held, reasons)
        before = letters.agg(F.max("offset")).first()[0]
        self.publish(as_change(found))
        end = self.clock() + self.wait
        while True:
            held = self._lsn(own)
            if held is not None and held >= lsn:
                return Outcome(APPLIED, held)
            again = self.letters().filter((F.col("offset") > before) & (F.col("transaction_id") == own) & (F.col("lsn") == lsn)).first()
            if again is not None:
                return Outcome(PENDING, held, f"rejected again: {again['rejection_reason']}")
            if self.clock() >= end:
                return Outcome(PENDING, held, "published, but not in the lake yet")
            self.sleep(self.poll)


def as_change(letters: DataFrame) -> DataFrame:
    """Log rows of parsed letters: their own op, values and sequence number."""
    none = F.lit(None).cast("timestamp")
    flat = letters.select(
        "op", "transaction_id", "merchant_id", "amount_minor", "currency", "status", "event_type", none.alias("created_at"), none.alias("updated_at"),
        "lsn", none.alias("source_ts"), F.lit(0).alias("partition"), "offset",
    )
    return envelope.to_json(envelope.build(flat))
