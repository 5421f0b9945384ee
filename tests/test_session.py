"""The shared folder with and without a setting for it, each in a session of its own."""

import os
import subprocess
import sys

import pytest

from opstide import session as S

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from opstide import session as S
b = SparkSession.builder.master({master!r}).config("spark.ui.enabled", "false").config("spark.sql.warehouse.dir", {warehouse!r})
spark = b.config("spark.driver.host", "127.0.0.1").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
try:
    first = S.materialise(spark.range(3), "a")
    assert S.shared_dir(spark).endswith({warehouse!r} + "/_scratch") and first.written_at.startswith(S.shared_dir(spark))
    mark = S.written()
    second, third = S.materialise(first, "b"), S.materialise(first, "c")
    S.remove_since(spark, mark, third)
    assert third.count() == 3 and first.count() == 3 and not os.path.exists(second.written_at.removeprefix("file:"))
    print("written")
except ValueError as error:
    print("refused", error)
"""


def run(tmp_path, master):
    empty = tmp_path / "conf"
    empty.mkdir()
    code = JOB.format(root=ROOT, master=master, warehouse=str(tmp_path / "warehouse"))
    env = os.environ | {"SPARK_CONF_DIR": str(empty)}
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, env=env, cwd=tmp_path)
    return done.stdout + done.stderr


def test_without_a_setting_a_local_master_uses_the_warehouse(tmp_path):
    assert "written" in run(tmp_path, "local[1]").splitlines()


class Cluster:
    """What the helper asks of a session."""

    def __init__(self, master, files="file:///", **settings):
        self.conf = self
        self.sparkContext = self._jsc = self
        self.master, self.files, self.settings = master, files, settings

    def get(self, key, default=None):
        return self.files if key == "fs.defaultFS" else self.settings.get(key.split(".")[-2], default)

    def hadoopConfiguration(self):
        return self


def test_without_a_setting_no_machine_local_folder_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        for warehouse in ("file:/data/warehouse", "/data/warehouse"):
            with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
                S.shared_dir(Cluster(master, warehouse=warehouse))
        assert S.shared_dir(Cluster(master, warehouse="hdfs://n/w/")) == "hdfs://n/w/_scratch"
        assert S.shared_dir(Cluster(master, "hdfs://n", warehouse="/w")) == "/w/_scratch"
        assert S.shared_dir(Cluster(master, warehouse="/w", checkpoint="file:///nfs/shared/")) == "file:///nfs/shared"
    assert S.shared_dir(Cluster("local[8]", warehouse="file:/w")) == "file:/w/_scratch"
