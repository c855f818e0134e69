"""The shared folder of a session, also of one that has no defaults."""

import os
import subprocess
import sys
from pathlib import Path

from millstream.session import shared_dir

ROOT = Path(__file__).resolve().parent.parent
PLAIN = """
from pyspark.sql import SparkSession
from millstream.session import shared_dir, stored
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
first = shared_dir(spark)
assert stored(spark.range(5), "x").count() == 5 and shared_dir(spark).split(":")[-1].startswith(first)
print("FOUND", stored(spark.range(3), "y").inputFiles()[0])
"""


def test_a_session_without_defaults_gets_a_folder(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(ROOT)}
    done = subprocess.run([sys.executable, "-c", PLAIN], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "FOUND file:" in done.stdout and "/millstream-" in done.stdout, done.stderr[-2000:]


def test_the_named_folder_is_used(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_dir(spark) == named
