"""Queries in a session with Spark's own settings, as a caller may have, in another process."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["als_recommend_user", "path_length_histogram", "lsa_singular_values", "lsa_top_terms", "lsa_top_docs"]
SCRIPT = """
import sys
from pyspark.sql import SparkSession
from datamill.plans import catalog

settings = {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"}
spark = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
for name in sys.argv[2:]:
    print("found", name, len(catalog.QUERIES[name](spark, sys.argv[1]).collect()))
"""


def test_queries_give_rows_in_a_plain_session():
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, SF_DIR, *NAMES],
        cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=600,
    )
    assert run.returncode == 0, run.stderr[-3000:]
    found = dict(line.split()[1:] for line in run.stdout.splitlines() if line.startswith("found "))
    assert sorted(found) == sorted(NAMES) and all(int(n) > 0 for n in found.values())
