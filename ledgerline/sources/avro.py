"""Avro binary records without a native reader: a small decoder and encoder, applied to Arrow batches by writer schema."""

from __future__ import annotations

import io
import json
import struct
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..schema import ENVELOPE
from . import envelope
from .registry import SchemaRegistry


class Codec:
    """Values of one writer schema."""

    def __init__(self, schema: str | dict):
        self.named: dict[str, Any] = {}
        self.schema = json.loads(schema) if isinstance(schema, str) else schema
        self._learn(self.schema, "")

    def _learn(self, s, space: str) -> None:
        if isinstance(s, list):
            for x in s:
                self._learn(x, space)
        elif isinstance(s, dict):
            space = s.get("namespace", space)
            if "name" in s and s["type"] in ("record", "enum", "fixed"):
                self.named[s["name"]] = self.named[f"{space}.{s['name']}".lstrip(".")] = s
            for x in s.get("fields", []):
                self._learn(x["type"], space)
            for part in ("items", "values"):
                if part in s:
                    self._learn(s[part], space)
            if isinstance(s.get("type"), (dict, list)):
                self._learn(s["type"], space)

    # Reading

    @staticmethod
    def _long(data: io.BytesIO) -> int:
        shift = n = 0
        while True:
            byte = data.read(1)
            if not byte:
                raise EOFError("the record ends early")
            n |= (byte[0] & 0x7F) << shift
            if byte[0] < 0x80:
                return (n >> 1) ^ -(n & 1)
            shift += 7

    def _bytes(self, data: io.BytesIO, n: int) -> bytes:
        got = data.read(n)
        if n < 0 or len(got) != n:
            raise EOFError("the record ends early")
        return got

    def _blocks(self, data: io.BytesIO) -> Iterator[None]:
        while n := self._long(data):
            if n < 0:
                n = -n
                self._long(data)
            yield from (None for _ in range(n))

    def read(self, data: io.BytesIO, s: Any = None) -> Any:
        s = self.schema if s is None else s
        if isinstance(s, list):
            return self.read(data, s[self._long(data)])
        kind = s["type"] if isinstance(s, dict) else s
        if isinstance(kind, (dict, list)):
            return self.read(data, kind)
        match kind:
            case "null":
                return None
            case "boolean":
                return self._bytes(data, 1) != b"\0"
            case "int" | "long":
                return self._long(data)
            case "float":
                return struct.unpack("<f", self._bytes(data, 4))[0]
            case "double":
                return struct.unpack("<d", self._bytes(data, 8))[0]
            case "bytes":
                return self._bytes(data, self._long(data))
            case "string":
                return self._bytes(data, self._long(data)).decode()
            case "fixed":
                return self._bytes(data, s["size"])
            case "enum":
                return s["symbols"][self._long(data)]
            case "array":
                return [self.read(data, s["items"]) for _ in self._blocks(data)]
            case "map":
                return {self.read(data, "string"): self.read(data, s["values"]) for _ in self._blocks(data)}
            case "record":
                return {f["name"]: self.read(data, f["type"]) for f in s["fields"]}
        return self.read(data, self.named[kind])

    # Writing

    @staticmethod
    def _put_long(n: int) -> bytes:
        n = (n << 1) ^ (n >> 63)
        out = bytearray()
        while n > 0x7F:
            out.append(n & 0x7F | 0x80)
            n >>= 7
        out.append(n)
        return bytes(out)

    def write(self, value: Any, s: Any = None) -> bytes:
        s = self.schema if s is None else s
        if isinstance(s, list):
            at = next(i for i, x in enumerate(s) if (x == "null") == (value is None))
            return self._put_long(at) + self.write(value, s[at])
        kind = s["type"] if isinstance(s, dict) else s
        if isinstance(kind, (dict, list)):
            return self.write(value, kind)
        match kind:
            case "null":
                return b""
            case "boolean":
                return bytes([bool(value)])
            case "int" | "long":
                return self._put_long(value)
            case "float" | "double":
                return struct.pack("<f" if kind == "float" else "<d", value)
            case "bytes" | "string":
                raw = value.encode() if kind == "string" else value
                return self._put_long(len(raw)) + raw
            case "fixed":
                return value
            case "enum":
                return self._put_long(s["symbols"].index(value))
            case "array" | "map":
                items = value if kind == "array" else value.items()
                body = b"".join(self.write(x, s["items"]) if kind == "array" else self.write(x[0], "string") + self.write(x[1], s["values"]) for x in items)
                return (self._put_long(len(value)) + body if value else b"") + b"\0"
            case "record":
                return b"".join(self.write(value[f["name"]] if f["name"] in value else f.get("default"), f["type"]) for f in s["fields"])
        return self.write(value, self.named[kind])


def _project(value: Any, to: StructType) -> Any:
    """The fields that the target schema names; others are ignored, absent ones are null. Values of another type are an error."""
    if value is None:
        return None
    out = {}
    for f in to:
        x = value.get(f.name)
        if x is not None and not isinstance(f.dataType, StructType):
            wanted = int if isinstance(f.dataType, LongType) else str
            if not isinstance(x, wanted) or isinstance(x, bool):
                raise TypeError(f"{f.name} is {type(x).__name__}")
        out[f.name] = _project(x, f.dataType) if isinstance(f.dataType, StructType) else x
    return out


def decode(raw: DataFrame, registry: SchemaRegistry) -> DataFrame:
    """Wire values (value, partition, offset) to `e`, partition, offset, each by its writer schema.

    The batch's schema ids, few, are gathered first, so that executors need no registry. Values that don't decode become
    envelopes of nulls and are rejected later, by validation. Null values are dropped.
    """
    ident, payload = envelope.header(F.col("value"))
    split = raw.filter("value is not null").select(ident.alias("_id"), payload.alias("_body"), "partition", "offset")
    ids = [r["_id"] for r in split.select("_id").distinct().collect() if r["_id"] is not None]
    return _decoded(split, {i: registry.by_id(i) for i in ids})


def decode_single(raw: DataFrame, schema: str) -> DataFrame:
    """The same with one schema for all values, whatever their headers say."""
    _, payload = envelope.header(F.col("value"))
    return _decoded(raw.filter("value is not null").select(F.lit(0).alias("_id"), payload.alias("_body"), "partition", "offset"), {0: schema})


def _decoded(split: DataFrame, schemas: dict[int, str]) -> DataFrame:
    kind = to_arrow_type(ENVELOPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs = {i: Codec(s) for i, s in schemas.items()}
        for batch in batches:
            found = []
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    found.append(_project(codecs[i].read(io.BytesIO(body)), ENVELOPE))
                except (KeyError, EOFError, ValueError, IndexError, TypeError, AttributeError):
                    found.append({})
            yield pa.record_batch([pa.array(found, kind), batch.column(2), batch.column(3)], names=["e", "partition", "offset"])

    return split.mapInArrow(run, StructType([StructField("e", ENVELOPE), StructField("partition", IntegerType()), StructField("offset", LongType())]))


def encode(enveloped: DataFrame, schema_id: Column, schemas: dict[int, str]) -> DataFrame:
    """`e`, partition, offset to wire values, each by the schema of its id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codecs = {i: Codec(s) for i, s in schemas.items()}
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            wire = [b"\0" + i.to_bytes(4, "big") + codecs[i].write(e) for e, i in rows]
            yield pa.record_batch([pa.array(wire, pa.binary()), batch.column(2), batch.column(3)], names=["value", "partition", "offset"])

    return enveloped.select("e", schema_id.alias("_id"), "partition", "offset").mapInArrow(run, "value binary, partition int, offset long")
