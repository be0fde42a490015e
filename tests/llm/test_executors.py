"""Executors without a copy of the library: functions and broadcast values travel with the job."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})          # the driver's alone: workers start in another folder, without it
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__
queries = __spark_entry__.queries()
for name in ("op11_quality_classifier", "op13_lexical_search", "op10_toxicity", "raw_archive_roundtrip"):
    print(name, len(queries[name](spark, "/root/testdata/sf0.001").collect()))
"""


def test_queries_run_where_workers_cannot_import_the_library(scratch):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=scratch, env=env, capture_output=True, text=True, timeout=300)
    lines = dict(line.split() for line in out.stdout.splitlines() if line.startswith(("op", "raw")))
    assert len(lines) == 4 and all(int(n) > 0 for n in lines.values()), out.stderr[-2000:]
