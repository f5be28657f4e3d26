"""Queries run on workers that have no copy of this package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]

SCRIPT = f"""
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())

def absent(_):
    import importlib.util
    return importlib.util.find_spec("evalspark") is None

assert all(spark.sparkContext.parallelize(range(4), 4).map(absent).collect())
sys.path.insert(0, {str(ROOT)!r})
from evalspark.workload.queries import QUERIES
for name in ("rouge_stemmed", "text_metrics", "forgetting_summary", "embedding_f1", "teacher_records"):
    print(name, QUERIES[name](spark, {SF_DIR!r}).count(), flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the driver's tables")
def test_workers_need_no_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    assert len(done.stdout.split()) == 10
