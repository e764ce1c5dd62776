"""Change envelopes: flattening, building, and the wire form's header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ENVELOPE, IMAGE


def flatten(decoded: DataFrame, envelope: str = "e") -> DataFrame:
    """Flat changes of FLAT's columns from an envelope struct and its partition and offset.

    Business values come from the image after, or else before, so that a delete keeps its key. Times of images are ISO-8601
    text (malformed: null); the source's is epoch milliseconds. is_delete is null where op is.
    """
    e = F.col(envelope)
    value = lambda c: F.coalesce(e["after"][c], e["before"][c])
    plain = [value(c).alias(c) for c in ("transaction_id", "merchant_id", "amount_minor", "currency", "status", "event_type")]
    times = [F.try_to_timestamp(value(c)).alias(c) for c in ("created_at", "updated_at")]
    return decoded.select(
        e["op"].alias("op"),
        *plain,
        *times,
        e["source"]["lsn"].alias("lsn"),
        F.timestamp_millis(e["source"]["ts_ms"]).alias("source_ts"),
        F.col("partition"),
        F.col("offset"),
        (e["op"] == "d").alias("is_delete"),
    )


def build(changes: DataFrame) -> DataFrame:
    """The inverse: `e`, partition, offset. A delete has an image before alone, other changes one after."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
    image = F.struct(*(iso(f.name) if f.name.endswith("_at") else F.col(f.name) for f in IMAGE))
    gone = F.col("op") == "d"
    ms = F.unix_millis("source_ts")
    body = F.struct(
        F.when(gone, image).alias("before"),
        F.when(~gone, image).alias("after"),
        F.struct(F.col("lsn").alias("lsn"), ms.alias("ts_ms")).alias("source"),
        F.col("op").alias("op"),
        ms.alias("ts_ms"),
    )
    return changes.select(body.alias("e"), "partition", "offset")


def to_json(enveloped: DataFrame) -> DataFrame:
    return enveloped.select(F.to_json("e").cast("binary").alias("value"), "partition", "offset")


def from_json(raw: DataFrame) -> DataFrame:
    """JSON envelopes; rows without a value are dropped (log tombstones). Malformed ones become envelopes of nulls."""
    parsed = F.from_json(F.col("value").cast("string"), ENVELOPE)
    return raw.filter("value is not null").select(parsed.alias("e"), "partition", "offset")


def header(value: Column) -> tuple[Column, Column]:
    """Schema id (big-endian bytes 2 to 5) and payload (from byte 6) of a wire value; the first byte isn't looked at."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int"), F.substring(value, F.lit(6), F.greatest(F.length(value) - 5, F.lit(0)))


def frame(schema_id: Column, payload: Column) -> Column:
    """A wire value: zero, the schema id, the payload."""
    return F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(schema_id.cast("long")), 8, "0"), F.hex(payload)))


def union_versions(frames: list[DataFrame]) -> DataFrame:
    """Rows of several schema versions; what a version lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
