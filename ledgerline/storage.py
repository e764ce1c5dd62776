"""The folder that driver and executors share: where derived tables and intermediates are kept while an application runs."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import warnings
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def _on_one_machine(spark: SparkSession) -> bool:
    """Whether executors run on the driver's machine: in local mode, and as the processes that `local-cluster` starts there."""
    return _is_local(spark) or spark.sparkContext.master.startswith("local-cluster[")


def file_system(spark: SparkSession, path: str):
    """A Hadoop path and its file system, by the session's settings."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _setting(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, with its scheme: `spark.checkpoint.dir`, or in local mode alone a temporary one.

    A path without a scheme belongs to the default file system. On a cluster of machines, one that would thereby become a folder of each
    of them raises, as does any cluster without the setting; a `file:` path that is written out must be a mount. The executors of a
    `local-cluster` see the driver's folders, so there such a path is shared. `probe` checks every `file:` folder outside local mode. What
    raises here isn't known to be shared by its name; `home` asks the executors then.
    """
    found = _setting(spark)
    if found is None:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        own = getattr(shared_dir, "own", None)
        if own is None:
            own = shared_dir.own = tempfile.mkdtemp(prefix="ledgerline-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        found = f"file://{own}"
    at, store = file_system(spark, found)
    whole = store.makeQualified(at).toString()
    if whole.startswith("file:") and not found.startswith("file:") and not _on_one_machine(spark):
        raise RuntimeError(f"spark.checkpoint.dir is {found}, a folder of each machine; name its file system, or file:// if it is mounted everywhere")
    return whole.replace("file:/", "file:///", 1) if whole.startswith("file:/") and not whole.startswith("file://") else whole


def probe(spark: SparkSession, folder: str, files: int = 16) -> None:
    """Raise unless executors read what the driver has put into the folder: a missing mount would otherwise lose rows silently."""
    at, store = file_system(spark, f"{folder}/probe-{uuid.uuid4().hex[:12]}")
    try:
        for i in range(files):
            out = store.create(spark._jvm.org.apache.hadoop.fs.Path(at, str(i)))
            out.write(bytearray(b"seen\n"))
            out.close()
        seen = spark.read.text(at.toString()).count()
    except Exception as why:
        raise RuntimeError(f"executors can't read {folder}; set spark.checkpoint.dir to a folder that all of them share") from why
    finally:
        store.delete(at, True)
    if seen != files:
        raise RuntimeError(f"executors see {seen} of {files} files in {folder}; set spark.checkpoint.dir to a folder that all of them share")


def probe_back(spark: SparkSession, folder: str) -> None:
    """Raise unless the driver sees what executors put into the folder, several files for each of their cores."""
    path, files = f"{folder}/probe-{uuid.uuid4().hex[:12]}", _probes(spark)
    at, store = file_system(spark, path)
    try:
        spark.range(0, files, 1, files).selectExpr("cast(id as string) as value").write.text(path)
        seen = sum(x.getPath().getName().startswith("part-") for x in store.listStatus(at))
    except Exception as why:
        raise RuntimeError(f"executors can't write to {folder}") from why
    finally:
        store.delete(at, True)
    if seen != files:
        raise RuntimeError(f"the driver sees {seen} of {files} files that executors wrote to {folder}")


def _probes(spark: SparkSession) -> int:
    return max(16, 4 * spark.sparkContext.defaultParallelism)


def _others(spark: SparkSession) -> list[str]:
    """Folders that executors may share although no setting says so: of the setting's own path, the warehouse, and on one machine a temporary one."""
    found, setting = [], _setting(spark)
    if setting is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(setting)
        if at.toUri().getScheme() is None and at.isAbsolute():
            found.append(f"file://{at.toUri().getPath()}")
    at, store = file_system(spark, spark.conf.get("spark.sql.warehouse.dir"))
    found.append(store.makeQualified(at).toString())
    if _on_one_machine(spark):
        found.append(f"file://{tempfile.gettempdir()}")
    return found


def _made(spark: SparkSession, folder: str, named: bool) -> str:
    """A new folder for this application in a shared one. Another user's `ledgerline`, or another driver's part of it, is left alone."""
    for top in ("ledgerline", f"ledgerline-{uuid.uuid4().hex[:12]}"):
        own = f"{folder.rstrip('/')}/{top}/{spark.sparkContext.applicationId}-{_DRIVER}"
        at, store = file_system(spark, own)
        with suppress(Py4JJavaError):
            if store.mkdirs(at):
                break
    else:
        raise RuntimeError(f"no folder can be made in {folder}")
    store.deleteOnExit(at)
    try:
        if own.startswith("file:") and not _is_local(spark):
            if named:
                probe(spark, own)
            else:
                probe(spark, own, _probes(spark))
                probe_back(spark, own)
    except RuntimeError:
        store.delete(at, True)
        raise
    return own


def home(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when the driver's JVM ends.

    The folder that `shared_dir` gives comes first. Where that refuses, or the folder turns out not to be shared or can't be written to, the
    first of `_others` is taken that all executors show to be shared, by files that go both ways. If there is none, the first refusal raises.
    """
    key = (spark.sparkContext.applicationId, _setting(spark))
    own = _homes.get(key)
    if own is not None and exists(spark, own):
        return own
    refused = None
    for place in [shared_dir, *_others(spark)]:
        try:
            named = callable(place)
            own = _made(spark, place(spark) if named else place, named)
        except Exception as why:
            refused = refused or why
            continue
        if refused is not None:
            warnings.warn(f"{refused}; {own} is used, which all executors see", stacklevel=2)
        _homes[key] = own
        return own
    raise refused


_homes: dict[tuple[str, str | None], str] = {}
#: Masters of processes number their applications alike: two that start in the same second have one id.
_DRIVER = uuid.uuid4().hex[:8]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{home(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    at, store = file_system(spark, path)
    store.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at, store = file_system(spark, path)
    return store.exists(at)


def clear(spark: SparkSession) -> None:
    """Delete what is kept for frames that were returned; those can't be read any more."""
    remove(spark, home(spark))
