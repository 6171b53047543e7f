"""The library without the training-data operators and their tests."""

import pathlib
import shutil
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parent.parent

SCRIPT = """
import __spark_entry__ as entry
from pyspark.sql import SparkSession
assert entry.queries() and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in entry.queries())
assert set(entry.oracle_sql()) <= set(entry.queries())
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert entry.entry(spark).count() == 5
"""


def test_the_rest_works_without_the_training_data_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in ("llm", ".git", "__pycache__", "spark-warehouse")])
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"], cwd=copy, capture_output=True, text=True, timeout=300)
    assert collected.returncode == 0, collected.stdout[-2000:]
