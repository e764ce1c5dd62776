"""A versioned table on plain Parquet files, with guarded merges and a change feed.

Version N is the manifest `_manifest/N.json`. It names, for each hash bucket of the key, the folder with the bucket's rows and their number, and
holds the change files, the counts and the batch that made it. Data files never change. A commit publishes its manifest under a name that must be
new, so of two writers one wins and the other merges again on top. That needs an atomic rename, which HDFS and local file systems have and object
stores don't; tables there are refused.

A merge rewrites the buckets that the batch touches alone. Buckets grow by extendible hashing: bucket (d, v) has the keys whose hash ends
in the d bits of v, and one that would have more than `split` rows is written as two or more of greater depth. So a merge costs what it
touches, in tasks of bounded size, however large the table is.

What commits did, without their buckets, is also kept in a log that is written every `LOG_EVERY` versions: history, change feed and
batches open it and the few manifests behind it.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections import defaultdict
from dataclasses import asdict, dataclass, field
from urllib.parse import urlparse

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.merge import merged
from ..schema import KEY, LEDGER


class Conflict(Exception):
    """Another writer has published this version."""


@dataclass
class Manifest:
    version: int
    committed_at: int
    buckets: dict[str, list]  # name: folder (none if empty), rows
    depth: int = 0  # of the deepest bucket
    changes: str | None = None
    batch: list | None = None
    counts: dict[str, int] = field(default_factory=dict)

    def entry(self) -> dict:
        return {k: v for k, v in asdict(self).items() if k not in ("buckets", "depth")}


#: File systems whose rename is atomic and fails if the name is taken.
RENAMING = {"", "file", "hdfs", "viewfs", "webhdfs", "swebhdfs"}
LOG_EVERY = 100


def _name(depth: int, value: int) -> str:
    return f"{depth}x{value}"


class VersionedTable:
    """Rows of `schema`, unique by `key`; all methods read committed versions alone. A new table's buckets have `depth` bits."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType = LEDGER, key: str = KEY, depth: int = 2, split: int = 2_000_000):
        self.spark, self.path, self.schema, self.key, self.depth, self.split = spark, path.rstrip("/"), schema, key, depth, split
        self._jvm = spark._jvm
        at = self._at("_manifest")
        self._fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if (scheme := self._fs.getScheme()) not in RENAMING:
            raise ValueError(f"{path}: {scheme} has no atomic rename, so two writers could both commit")
        self._fs.mkdirs(at)

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    # Manifests

    def version(self) -> int:
        """The newest version; 0: nothing is committed."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("_manifest"))]
        return max((int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()), default=0)

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.version() if version is None else version
        if not version:
            return Manifest(0, 0, {})
        return Manifest(**self._load(f"{version}.json"))

    def _load(self, name: str):
        stream = self._fs.open(self._at("_manifest", name))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _store(self, name: str, what, over: bool = False):
        at = self._at("_manifest", name)
        out = self._fs.create(at, over)
        out.write(bytearray(json.dumps(what).encode()))
        out.close()
        return at

    def _publish(self, m: Manifest) -> None:
        """Written under a private name, then given its own unless somebody has it."""
        draft, final = self._store(f".{uuid.uuid4().hex}", asdict(m)), self._at("_manifest", f"{m.version}.json")
        parsed = urlparse(self.path)
        try:
            if parsed.scheme in ("", "file"):
                folder = f"{parsed.path}/_manifest"
                os.link(f"{folder}/{draft.getName()}", f"{folder}/{m.version}.json")
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.spark._jsc.hadoopConfiguration())
                context.rename(draft, final, self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as why:
            if isinstance(why, FileExistsError) or self._fs.exists(final):
                raise Conflict(f"version {m.version} exists") from None
            raise
        finally:
            self._fs.delete(draft, False)

    def log(self) -> list[dict]:
        """What each version did, oldest first."""
        newest = self.version()
        done = newest - newest % LOG_EVERY
        while done and not self._fs.exists(self._at("_manifest", f"log-{done}.json")):  # its writer may have died before it
            done -= LOG_EVERY
        told = self._load(f"log-{done}.json") if done else []
        return told + [self.manifest(v).entry() for v in range(done + 1, newest + 1)]

    def history(self) -> DataFrame:
        rows = [(m["version"], m["committed_at"], json.dumps(m["counts"])) for m in self.log()]
        return self.spark.createDataFrame(rows, "version long, committed_at long, counts string")

    # Reading

    def _folders(self, m: Manifest, wanted: list[str] | None = None) -> DataFrame:
        found = sorted({m.buckets[b][0] for b in (m.buckets if wanted is None else wanted) if b in m.buckets} - {None})
        if not found:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{p}" for p in found))

    def read(self, version: int | None = None) -> DataFrame:
        return self._folders(self.manifest(version))

    def lookup(self, key: str) -> DataFrame:
        """A key's row, from its bucket alone."""
        m = self.manifest()
        low = self.spark.range(1).select(self._low(F.lit(key), m.depth).alias("v")).first()["v"]
        return self._folders(m, [_name(*self._owner(m, low))]).filter(F.col(self.key) == key)

    def row(self, key: str) -> Row | None:
        """The same as a row; raises if the table, against its promise, has several."""
        found = self.lookup(key).limit(2).collect()
        if len(found) > 1:
            raise ValueError(f"{key} is not unique")
        return found[0] if found else None

    def change_feed(self, first: int | None = None, since: int | None = None) -> DataFrame:
        """Row images of the versions from `first`, or committed at `since` (epoch seconds) or later."""
        chosen = [m["changes"] for m in self.log() if m["changes"] and m["version"] >= (first or 1) and (since is None or m["committed_at"] >= since)]
        schema = StructType([*self.schema.fields]).add("_change_type", "string").add("_commit_version", "long").add("_commit_timestamp", "long")
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{p}" for p in chosen))

    def batches(self) -> dict[tuple, dict[str, int]]:
        """Batches that commits have recorded, with their counts."""
        return {tuple(m["batch"]): m["counts"] for m in self.log() if m["batch"]}

    # Merging

    @staticmethod
    def _low(key, depth: int) -> F.Column:
        """The last bits of a key's hash."""
        return F.xxhash64(key).bitwiseAND(F.lit((1 << depth) - 1))

    def _owner(self, m: Manifest, low: int) -> tuple[int, int]:
        """The bucket of keys with these last bits (as many as the manifest's depth has); a new one of the least depth if there is none."""
        for d in range(m.depth, self.depth - 1, -1):
            if _name(d, low & ((1 << d) - 1)) in m.buckets:
                return d, low & ((1 << d) - 1)
        return self.depth, low & ((1 << self.depth) - 1)

    def merge(self, staged: DataFrame, batch: list | None = None, retries: int = 5, now: int | None = None) -> dict[str, int]:
        """Merge rows with one row per key; counts of staged, inserted, updated and skipped. An empty batch commits nothing."""
        staged = staged.select(*self.schema.fieldNames()).persist()
        try:
            if staged.isEmpty():
                return {"staged": 0, "inserted": 0, "updated": 0, "skipped": 0}
            for _ in range(retries):
                try:
                    return self._merge_once(staged, batch, now)
                except Conflict:
                    continue
            raise Conflict(f"{retries} attempts met other writers")
        finally:
            staged.unpersist()

    def _merge_once(self, staged: DataFrame, batch, now) -> dict[str, int]:
        base = self.manifest()
        base.depth = max(base.depth, self.depth)
        incoming: dict[tuple[int, int], int] = defaultdict(int)
        for r in staged.groupBy(self._low(F.col(self.key), base.depth).alias("v")).agg(F.count(F.lit(1)).alias("n")).collect():  # at most 2^depth
            incoming[self._owner(base, r["v"])] += r["n"]
        deeper = {}  # bucket: the depth of what it is written as
        for (d, v), n in incoming.items():
            rows = n + base.buckets.get(_name(d, v), [None, 0])[1]
            deeper[d, v] = d + max(0, (-(-rows // self.split) - 1).bit_length())
        target = self._folders(base, [_name(*b) for b in incoming])

        version, tag = base.version + 1, uuid.uuid4().hex[:8]
        data, changes = f"data/{version}-{tag}", f"changes/{version}-{tag}"
        parts = sum(1 << (to - d) for (d, _), to in deeper.items())
        self._named(merged(target, staged, self.key), base.depth, deeper).repartition(parts, "_b").write.partitionBy("_b").parquet(f"{self.path}/{data}")
        each = self.spark.read.parquet(f"{self.path}/{data}").groupBy(F.col("_b").cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n"))
        held = {r["b"]: r["n"] for r in each.collect()}

        written = self.spark.read.schema(StructType([*self.schema.fields]).add("_change", "string")).parquet(*(f"{self.path}/{data}/_b={b}" for b in held))
        stamp = int(time.time()) if now is None else now
        new = written.filter("_change <> 'kept'")
        old = target.join(new.filter("_change = 'update'").select(self.key), self.key, "left_semi").withColumn("_change_type", F.lit("update_preimage"))
        after = new.withColumn("_change_type", F.when(F.col("_change") == "update", "update_postimage").otherwise("insert")).drop("_change")
        feed = old.unionByName(after).withColumn("_commit_version", F.lit(version).cast("long")).withColumn("_commit_timestamp", F.lit(stamp).cast("long"))
        feed.write.parquet(f"{self.path}/{changes}")
        got = {r["_change"]: r["n"] for r in new.groupBy("_change").agg(F.count(F.lit(1)).alias("n")).collect()}
        counts = {"staged": sum(incoming.values()), "inserted": got.get("insert", 0), "updated": got.get("update", 0)}
        counts["skipped"] = counts["staged"] - counts["inserted"] - counts["updated"]
        buckets = {b: x for b, x in base.buckets.items() if b not in {_name(*k) for k in incoming}}
        for (d, v), to in deeper.items():
            for b in (_name(to, w) for w in range(v, 1 << to, 1 << d)):
                buckets[b] = [f"{data}/_b={b}", held[b]] if b in held else [None, 0]
        self._publish(Manifest(version, stamp, buckets, max(base.depth, *deeper.values()), changes, batch, counts))
        if version % LOG_EVERY == 0:
            self._store(f"log-{version}.json", self.log(), over=True)
        return counts

    def _named(self, rows: DataFrame, depth: int, deeper: dict[tuple[int, int], int]) -> DataFrame:
        """rows with `_b`, the name of the bucket that each goes to."""
        if len(set(deeper.values())) == 1:
            to = next(iter(deeper.values()))
            return rows.withColumn("_b", F.concat(F.lit(f"{to}x"), self._low(F.col(self.key), to).cast("string")))
        told = [(low, to) for (d, v), to in deeper.items() for low in range(v, 1 << depth, 1 << d)]  # at most 2^depth
        depths = F.broadcast(self.spark.createDataFrame(told, "_low long, _to int"))
        joined = rows.withColumn("_low", self._low(F.col(self.key), depth)).join(depths, "_low")
        value = F.xxhash64(self.key).bitwiseAND(F.expr("shiftleft(1L, _to) - 1"))
        return joined.withColumn("_b", F.concat(F.col("_to").cast("string"), F.lit("x"), value.cast("string"))).drop("_low", "_to")
