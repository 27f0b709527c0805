"""Where written intermediate tables go."""

import os
import subprocess
import sys
import tempfile

import pytest

from verilens.session import CHECKPOINT_DIR, NoSharedFolder, shared_dir, stored


class _Session:
    """The two settings that ``shared_dir`` reads."""

    def __init__(self, master, folder=None):
        self.values, self.sparkContext = {CHECKPOINT_DIR: folder} if folder else {}, type("Context", (), {"master": master, "applicationId": "app"})
        self.conf = type("Conf", (), {"get": lambda _, k, d=None: self.values.get(k, d)})()


def test_a_cluster_must_name_a_folder():
    for master in ("yarn", "k8s://host", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(NoSharedFolder):
            shared_dir(_Session(master))
        assert shared_dir(_Session(master, "hdfs://store/shared/")) == "hdfs://store/shared"


def test_local_mode_makes_one_folder():
    session = _Session("local[2]")
    assert shared_dir(session) == shared_dir(session)


def test_stored_rows_come_back(spark):
    assert stored(spark.range(5).toDF("x"), "numbers").count() == 5


def test_a_local_session_without_settings():
    """A real session of its own process, whose configuration is empty, writes reports and stored tables."""
    code = """
import os, sys
os.environ["SPARK_CONF_DIR"] = sys.argv[1]
from verilens.session import local_session, stored
from verilens.plans.catalog import queries
spark = local_session(cores=2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert stored(spark.range(3).toDF("x"), "numbers").count() == 3
assert queries()["sink_typed_parquet"](spark, "/root/testdata/sf0.001").count() > 0
print("written")
"""
    with tempfile.TemporaryDirectory() as empty:
        env = {k: v for k, v in os.environ.items() if k not in ("SPARK_CONF_DIR", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET", "PYSPARK_SUBMIT_ARGS")}
        got = subprocess.run([sys.executable, "-c", code, empty], capture_output=True, text=True, timeout=300, env=env | {"SPARK_CONF_DIR": empty},
                             cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert "written" in got.stdout, got.stderr[-2000:]
