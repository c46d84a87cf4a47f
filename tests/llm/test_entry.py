"""The entry file loaded by path in a process of its own, from another folder, without PYTHONPATH."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Arrow batches alone, sorted streams of them, grouped pandas, several kinds in one pipeline
NAMES = ["op3_sentencepiece", "op9_topk_search", "op12_personal_data", "op7_simhash", "pipeline"]
CODE = f"""
import importlib.util, sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
spec = importlib.util.spec_from_file_location("__spark_entry__", "{ROOT}/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
for name in {NAMES}:
    print("ROWS", name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_queries_with_python_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_SUBMIT_ARGS")}
    done = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=900)
    got = {line.split()[1]: int(line.split()[2]) for line in done.stdout.splitlines() if line.startswith("ROWS")}
    assert got.keys() == set(NAMES) and all(got.values()), done.stderr[-1500:]
