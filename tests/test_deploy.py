"""The package reaches the Python workers from whatever folder the driver runs in."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as contract
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", contract.queries()[sys.argv[1]](spark, "/root/testdata/sf0.001").count())
"""


@pytest.mark.parametrize("name", ["j1_encoder", "a1_read_zst_dump", "i2_stream_line_file"])
def test_query_from_a_foreign_folder(tmp_path, name):
    """A function in tasks, a data source, and its streaming side, whose runner sees no shipped package."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, name], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    found = [line for line in done.stdout.splitlines() if line.startswith("rows ")]
    assert found and int(found[0].split()[1]) > 100, done.stderr[-2000:]
