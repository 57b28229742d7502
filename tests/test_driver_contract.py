"""The driver loads __spark_entry__.py by path from its own working
directory: queries that run Python on executors must still work there."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, '__spark_entry__.py')!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert len(E.entry(spark).collect()) > 0
for name in ("duration_minutes", "duration_minutes_sql", "json_multiline"):
    assert len(E.queries()[name](spark, "/root/testdata/sf0.001").collect()) > 0, name
print("CONTRACT-OK")
"""


def test_python_on_executors_outside_the_repo():
    cwd = tempfile.mkdtemp(prefix="quarry-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "CONTRACT-OK" in res.stdout, res.stderr[-2000:]
