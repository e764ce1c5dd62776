"""Queries on a cluster of processes whose `spark.checkpoint.dir` has no scheme, as the installed Spark's defaults have it."""

import json
import os
import subprocess
import sys

import pytest

from ledgerline import storage

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

#: Each failed there before it came to read a row.
NAMES = [
    "pipeline",
    "op6_simhash_near_dedup",
    "op7_suffix_array_dedup",
    "agg_live",
    "batch_progress",
    "cdf_by_version",
    "decode_by_writer_schema",
    "dedup_latest",
    "dlq_open",
    "dlq_page",
    "dlq_rate",
    "duplicate_keys",
    "freshness",
    "lake_stats",
    "ledger_state",
    "merge_upsert",
    "op_counts",
    "parity_mismatch_nullsafe",
    "parity_report",
    "processed_offsets",
    "rejection_counts",
    "replay_range_scan",
    "snapshot_transition",
    "source_snapshot",
    "throughput_windows",
    "union_schema_versions",
    "wire_header_split",
]

CHILD = """
import json, os, sys
import pyspark
os.environ |= {"SPARK_HOME": os.path.dirname(pyspark.__file__), "SPARK_SCALA_VERSION": "2.13", "PYSPARK_PYTHON": sys.executable}
from pyspark.sql import SparkSession
shared, sf_dir, *names = sys.argv[1:]
conf = {"spark.master": "local-cluster[2,1,1024]", "spark.executor.memory": "1g", "spark.checkpoint.dir": shared, "spark.worker.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse",
        "spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.host": "127.0.0.1"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
import __spark_entry__
found = {}
for name in names:
    try:
        found[name] = __spark_entry__.queries()[name](spark, sf_dir).count()
    except Exception as why:
        found[name] = str(why)[:300]
print("FOUND", json.dumps(found), flush=True)
spark.stop()
"""


@pytest.fixture(scope="module")
def found(tmp_path_factory):
    shared = tmp_path_factory.mktemp("unschemed")
    args = [sys.executable, "-c", CHILD, str(shared), SF, *NAMES]
    run = subprocess.run(args, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT, "SPARK_LOCAL_IP": "127.0.0.1"}, capture_output=True, text=True, timeout=600)
    lines = [x for x in run.stdout.splitlines() if x.startswith("FOUND ")]
    assert lines, run.stderr[-2000:]
    return json.loads(lines[0].removeprefix("FOUND "))


@pytest.mark.parametrize("name", NAMES)
def test_runs_there_as_in_local_mode(spark, found, name):
    import __spark_entry__

    assert found[name] == __spark_entry__.queries()[name](spark, SF).count()


class Named:
    """A session of another master."""

    def __init__(self, spark, master):
        self._jvm, self._jsc, self.conf = spark._jvm, spark._jsc, spark.conf
        self.sparkContext = type("Context", (), {"master": master})


def test_only_executors_of_this_machine_share_its_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_setting", lambda _: str(tmp_path))
    for master in ("local", "local[2]", "local-cluster[3,2,3000]"):
        assert storage.shared_dir(Named(spark, master)) == f"file://{tmp_path}"
    for master in ("spark://host:7077", "yarn", "k8s://https://host:443"):
        with pytest.raises(RuntimeError, match="a folder of each machine"):
            storage.shared_dir(Named(spark, master))
    monkeypatch.setattr(storage, "_setting", lambda _: None)
    with pytest.raises(RuntimeError, match="set spark.checkpoint.dir"):  # a temporary folder of the driver's may be its own
        storage.shared_dir(Named(spark, "local-cluster[3,2,3000]"))
