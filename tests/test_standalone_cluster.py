"""Queries on clusters whose settings don't say what their executors share: of a standalone master whose `spark.checkpoint.dir` has no scheme, and without the setting."""

import json
import os
import socket
import subprocess
import sys
import time
from pathlib import Path

import pyspark
import pytest

from ledgerline import storage

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

#: Each was refused there before it came to read a row.
NAMES = [
    "pipeline",
    "op6_simhash_near_dedup",
    "op7_suffix_array_dedup",
    "agg_live",
    "decode_by_writer_schema",
    "dlq_page",
    "freshness",
    "merge_upsert",
    "parity_report",
    "replay_range_scan",
    "throughput_windows",
    "batch_progress",
    "dedup_latest",
    "dlq_rate",
    "lake_stats",
    "op_counts",
    "processed_offsets",
    "snapshot_transition",
    "union_schema_versions",
    "cdf_by_version",
    "dlq_open",
    "duplicate_keys",
    "ledger_state",
    "parity_mismatch_nullsafe",
    "rejection_counts",
    "source_snapshot",
    "wire_header_split",
]

CHILD = """
import json, sys, warnings
warnings.simplefilter("ignore")
from pyspark.sql import SparkSession
conf, sf_dir, *names = sys.argv[1:]
spark = SparkSession.builder.config(map=json.loads(conf)).getOrCreate()
import __spark_entry__
from ledgerline import storage
found = {}
for name in names:
    try:
        found[name] = __spark_entry__.queries()[name](spark, sf_dir).count()
    except Exception as why:
        found[name] = str(why)[:300]
print("FOUND", json.dumps(found | {"home": storage.home(spark)}), flush=True)
spark.stop()
"""


def ran(top: Path, master: str, names: list[str], **conf: str) -> dict:
    """What the queries give in a session of its own, with the installed Spark but for its settings and its folder of logs."""
    for p in (top, top / "home", top / "conf"):
        p.mkdir(exist_ok=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name not in ("work", "conf"):
            (top / "home" / p.name).symlink_to(p)
    conf = {"spark.master": master, "spark.executor.memory": "1g", "spark.executor.cores": "1", "spark.sql.warehouse.dir": f"{top}/warehouse", "spark.sql.session.timeZone": "UTC",
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1"} | conf
    env = os.environ | {"PYTHONPATH": ROOT, "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_HOME": f"{top}/home", "SPARK_CONF_DIR": f"{top}/conf", "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
    run = subprocess.run([sys.executable, "-c", CHILD, json.dumps(conf), SF, *names], cwd=ROOT, env=env, capture_output=True, text=True, timeout=600)
    lines = [x for x in run.stdout.splitlines() if x.startswith("FOUND ")]
    assert lines, run.stderr[-2000:]
    return json.loads(lines[0].removeprefix("FOUND "))


@pytest.fixture(scope="module")
def found(tmp_path_factory):
    top = tmp_path_factory.mktemp("standalone")
    home = os.path.dirname(pyspark.__file__)
    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        port = s.getsockname()[1]
    master = f"spark://127.0.0.1:{port}"
    env = os.environ | {"SPARK_HOME": home, "SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYTHONPATH": ROOT}
    started = []
    try:
        for args in (["master.Master", "--port", str(port)], *(["worker.Worker", "--cores", "1", "--memory", "1g", "--work-dir", f"{top}/work{k}", master] for k in range(2))):
            command = [f"{home}/bin/spark-class", f"org.apache.spark.deploy.{args[0]}", "--host", "127.0.0.1", "--webui-port", "0", *args[1:]]
            started.append(subprocess.Popen(command, env=env, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL))
            time.sleep(3)
        yield ran(top, master, NAMES, **{"spark.checkpoint.dir": f"{top}/shared"}) | {"top": str(top)}
    finally:
        for p in reversed(started):
            p.terminate()
        for p in started:
            p.wait(30)


@pytest.mark.parametrize("name", NAMES)
def test_runs_there_as_in_local_mode(spark, found, name):
    import __spark_entry__

    assert found[name] == __spark_entry__.queries()[name](spark, SF).count()


def test_its_own_folder_is_taken(found):
    assert found["home"].startswith(f"file://{found['top']}/shared/ledgerline/app-")


def test_without_the_setting_the_warehouse_is_taken(spark, tmp_path):
    import __spark_entry__

    names = ["ledger_state", "op6_simhash_near_dedup"]
    found = ran(tmp_path / "unset", "local-cluster[2,1,1024]", names)
    assert {n: found[n] for n in names} == {n: __spark_entry__.queries()[n](spark, SF).count() for n in names}
    assert found["home"].startswith(f"file:{tmp_path}/unset/warehouse/ledgerline/app-")


def test_folders_are_taken_that_executors_show_to_be_shared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_is_local", lambda _: False)
    monkeypatch.setattr(storage, "_homes", {})
    monkeypatch.setattr(storage, "_setting", lambda _: str(tmp_path))
    with pytest.warns(UserWarning, match="which all executors see"):
        own = storage.home(spark)
    assert own.startswith(f"file://{tmp_path}/ledgerline/") and os.listdir(own.removeprefix("file://")) == []
    assert storage.home(spark) == own
    monkeypatch.setattr(storage, "_setting", lambda _: None)
    with pytest.warns(UserWarning, match="set spark.checkpoint.dir"):
        assert storage.home(spark).startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_no_folder_is_taken_that_they_do_not_share(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_is_local", lambda _: False)
    monkeypatch.setattr(storage, "_homes", {})
    monkeypatch.setattr(storage, "_setting", lambda _: str(tmp_path))

    def lost(session, folder):
        raise RuntimeError("the driver sees 0 of 16 files")

    monkeypatch.setattr(storage, "probe_back", lost)
    with pytest.raises(RuntimeError, match="a folder of each machine"):
        storage.home(spark)
    assert os.listdir(tmp_path / "ledgerline") == []


def test_probe_back_sees_files_that_stay_with_an_executor(spark, tmp_path):
    class Elsewhere:  # an executor of a machine without the mount
        _jvm, _jsc, sparkContext = spark._jvm, spark._jsc, spark.sparkContext

        def range(self, *_):
            return self

        def selectExpr(self, _):
            return self

        @property
        def write(self):
            return self

        def text(self, path):
            spark.range(0, 1, 1, 1).selectExpr("cast(id as string)").write.text(path)

    storage.probe_back(spark, f"file://{tmp_path}")
    with pytest.raises(RuntimeError, match="sees 1 of 16 files"):
        storage.probe_back(Elsewhere(), f"file://{tmp_path}")
    assert os.listdir(tmp_path) == []


def test_another_users_part_of_the_folder_is_left_alone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_homes", {})
    monkeypatch.setattr(storage, "_setting", lambda _: str(tmp_path))
    (tmp_path / "ledgerline").write_text("a file, in which no folder can be made, as in one that another user owns")
    own = storage.home(spark)
    assert own.startswith(f"file://{tmp_path}/ledgerline-") and os.path.isdir(own.removeprefix("file://"))
