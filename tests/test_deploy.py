"""The entry module works from any working directory, in a fresh session.

Executor Python workers must import ``ferry`` for mapInPandas and the
Python data source; the package ships itself (``ship_package``).
"""

from __future__ import annotations

import ast
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(ROOT, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").getOrCreate()
q = m.queries()
n = [m.entry(spark).count()] + [q[k](spark, m.SMOKE_DIR).count()
                                for k in ("image_audit", "asset_fetch_audit", "daily_report_http")]
print("COUNTS", n)
spark.stop()
"""


def test_runs_from_a_foreign_directory():
    cwd = tempfile.mkdtemp(prefix="ferry-foreign-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("COUNTS")]
    assert line, out.stderr[-2000:]
    counts = ast.literal_eval(line[0].split(" ", 1)[1])
    assert counts[0] > 0 and counts[1] == counts[2] == 50 and counts[3] == counts[0]
