"""WARC archives, index first: written with an index of offsets, read by coalesced byte ranges.

Writing gives one gzip member per record and, beside the archives, an index row with file, offset, length, url and
digest. Reading selects index rows, sorts them by file and offset, joins neighbours into ranges of bounded size
whose gaps are small, and asks for each range once.

Archives go through pyarrow.fs (local, HDFS and object stores) to the folder of `spark.checkpoint.dir`; a task's
file bears its attempt, and only the index says which attempt counts, so a lost executor leaves at most an unused file.

Of records with equal payloads of at least `min_bytes`, that with the smallest page_id is a response and the others
revisit it. Defined results: null html: empty payload. Null url: no target header. Rows that repeat both the
smallest page_id and the payload are all responses, as are rows of a payload with no page_id at all; a null page_id
otherwise revisits. Empty table: empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_path, prepare, stash
from .urlfilter import Level

#: An archive is closed beyond this size; a range ends beyond RANGE bytes or at a gap over GAP.
MAX_FILE = 1 << 30
RANGE = 8 << 20
GAP = 64 << 10
#: Bytes of archives that a reading task has at most, and at least while there are idle cores.
MOST_READ = 128 << 20
LEAST_READ = 8 << 20
#: Rows of 60 bytes that are broadcast at most, and digests that a Bloom filter is sized for at most.
BROADCAST_ROWS = 500_000
FILTERED = 2_000_000

INDEX = "page_id long, url string, payload_digest string, payload_bytes long, record_type string, refers_to long, file string, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
_INDEX_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_INDEX_NAMES = [c.split()[0] for c in INDEX.split(", ")]


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _line(value: str) -> str:
    """A header value: control characters and spaces are percent-encoded."""
    return "".join(c if "!" <= c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, not compressed: an HTTP response with its payload, or a revisit with the header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None, str | None, bytes]:
    """A record's page_id, payload length, digest, type, refers_to, target and payload; raises if a payload isn't its digest's."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda name: None if (x := fields.get(name, "<urn:page:None>")[10:-1]) == "None" else int(x)
    return number("WARC-Record-ID"), size, digest, kind, number("WARC-Refers-To"), fields.get("WARC-Target-URI"), payload


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _writer(folder: str, date: str, level: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = file_system(folder)
        out, name, at, k = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, refers_to in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                    if out is None or at > MAX_FILE:
                        if out is not None:
                            out.close()
                        name, at, k = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{k:03d}.warc.gz", 0, k + 1
                        store.create_dir(root, recursive=True)
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (html.as_py() or "").encode("utf-8", "replace")
                    digest = sha1_base32(payload)
                    member = gzip.compress(record(page_id, url, payload, digest, refers_to, date), level, mtime=0)
                    out.write(member)
                    rows.append((page_id, url, digest, len(payload), "response" if refers_to is None else "revisit", refers_to, name, at, len(member)))
                    at += len(member)
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_TYPES)], names=_INDEX_NAMES)
        finally:
            if out is not None:
                out.close()

    return run


def _with_first(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """rows with `_first` of their digest. Payloads travel only if their digest may be shared and the shared ones are too many to broadcast."""
    n = shared.count()
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(shared), "_digest", "left")
    maybe = Level.of(shared.select(F.col("_digest").alias("key")), 0, min(n, FILTERED), 0.01).has(F.col("_digest"))
    own = rows.filter(~maybe).withColumn("_first", F.lit(None).cast("long"))
    return rows.filter(maybe).join(shared, "_digest", "left").unionByName(own)


def write(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 6) -> tuple[str, DataFrame]:
    """pages: page_id, url, html. The archives' folder and their index."""
    spark = pages.sparkSession
    prepare(spark)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn("_digest", F.sha1(F.col("html").cast("binary")))
    large = rows.filter(F.octet_length("html") >= min_bytes) if min_bytes else rows
    # One row per payload that several records have.
    shared = stash(large.groupBy("_digest").agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "shared-payloads")
    told = _with_first(rows, shared)
    refers_to = F.when(F.coalesce(F.col("page_id") != F.col("_first"), F.col("_first").isNotNull()), F.col("_first"))
    folder = fresh_path(spark, "warc")
    index = told.select("page_id", "url", "html", refers_to.alias("refers_to")).mapInArrow(_writer(folder, date, level), INDEX)
    return folder, stash(index, "warc-index")


def _reader(folder: str, gap: int, most: int, with_payload: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        name, source = None, None
        pending: list[tuple[str, int, int]] = []

        def fetch() -> pa.RecordBatch:
            nonlocal name, source
            first = pending[0][1]
            if pending[0][0] != name:
                name, source = pending[0][0], store.open_input_file(f"{root}/{pending[0][0]}")
            data = source.read_at(pending[-1][1] + pending[-1][2] - first, first)
            found = [parse(zlib.decompress(data[o - first : o - first + n], 31)) for _, o, n in pending]
            pending.clear()
            ids, sizes, digests, kinds, refers, urls, payloads = zip(*found)
            return pa.record_batch(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(kinds, pa.string()),
                    pa.array(refers, pa.int64()), pa.array(urls, pa.string()), pa.array(payloads if with_payload else [None] * len(ids), pa.binary()),
                ],
                names=[c.split()[0] for c in RECORD.split(", ")],
            )

        for batch in batches:
            for f, o, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if pending and (f != pending[0][0] or o - (pending[-1][1] + pending[-1][2]) > gap or o + n - pending[0][1] > most):
                    yield fetch()
                pending.append((f, o, n))
        if pending:
            yield fetch()

    return run


def read(spark, folder: str, selected: DataFrame, gap: int = GAP, most: int = RANGE, with_payload: bool = False) -> DataFrame:
    """The records of the selected index rows (file, offset, length), by coalesced ranges in file order. Tasks are dealt by archive bytes."""
    prepare(spark)
    chosen = selected.select("file", "offset", "length")
    size = chosen.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(-(-size // MOST_READ), min(spark.sparkContext.defaultParallelism, -(-size // LEAST_READ)), 1)
    placed = chosen.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return placed.mapInArrow(_reader(folder, gap, most, with_payload), RECORD)
