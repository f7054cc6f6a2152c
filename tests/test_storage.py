"""The shared folder: refused where executors can't see it, emptied when the driver ends."""

import os
import subprocess
import sys

import pytest

from omicspark.storage import bounded, free_name, shared_dir


class Session:
    def __init__(self, **conf):
        self._conf = dict(conf)
        self.conf = self

    def get(self, key, default=None):
        return self._conf.get(key, default)

    def set(self, key, value):
        self._conf[key] = value


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x", ""])
def test_a_cluster_names_its_folder(master):
    with pytest.raises(RuntimeError, match="share"):
        shared_dir(Session(**{"spark.master": master}))
    assert shared_dir(Session(**{"spark.master": master, "spark.checkpoint.dir": "hdfs://n/x/"})) == "hdfs://n/x"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_runs_may_make_one(master, tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    session = Session(**{"spark.master": master})
    assert shared_dir(session).startswith(f"file://{tmp_path}/spark-") and shared_dir(session) == shared_dir(session)


def test_tables_go_with_the_driver(tmp_path):
    code = """
import os, sys
from pyspark.sql import SparkSession
from omicspark.storage import materialize
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://" + sys.argv[1]).getOrCreate()
assert materialize(spark.range(5), "t").count() == 5
print("kept", len(os.listdir(sys.argv[1] + "/omicspark")))
"""
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], capture_output=True, text=True, timeout=120, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "kept 1" in done.stdout and os.listdir(tmp_path / "omicspark") == []


def test_names_and_bounds(spark):
    df = spark.createDataFrame([(1, 2)], "a int, A_ int")
    assert free_name(df, "a") == "a__" and free_name(df, "b") == "b"
    assert bounded(df, 1, "rows").count() == 1
    with pytest.raises(ValueError, match="over 0 rows"):
        bounded(df, 0, "rows")
