"""The driver contract without the corpus part, and core Python stages on workers that do not
have the package on their path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, tmp_path):
    env = {**os.environ, "PYTHONPATH": ""}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=280)
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout


def test_entry_survives_a_missing_library(tmp_path):
    out = run(f"""
import sys
sys.modules["xxhash"] = None
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as e
print(len([n for n in e.queries() if n.startswith("op")]), "window_source_aggregates" in e.queries(), set(e.oracle_sql()) <= set(e.queries()))
""", tmp_path)
    assert out.split() == ["0", "True", "True"]


def test_core_python_stages_run_from_another_folder(tmp_path):
    # the package is importable on the driver only: its folder is not on the workers' path
    out = run(f"""
import importlib.util, sys
spec = importlib.util.spec_from_file_location("windrose", {ROOT + "/windrose/__init__.py"!r},
                                              submodule_search_locations=[{ROOT + "/windrose"!r}])
sys.modules["windrose"] = importlib.util.module_from_spec(spec)
spec.loader.exec_module(sys.modules["windrose"])
from pyspark.sql import SparkSession, functions as F
from windrose.operators import sequence as Q
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
df = spark.range(50).select(F.col("id").alias("arrival_seq"), F.timestamp_seconds(F.col("id") * 40).alias("ts"))
print(Q.anchored_windows(df, "1 minute", bucket_rows=8).select("window_seq").distinct().count())
""", tmp_path)
    assert out.split()[-1] == "25"
