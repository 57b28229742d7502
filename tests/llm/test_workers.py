"""All operators from a foreign folder, with workers that cannot import the package."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {os.path.join(REPO, '__spark_entry__.py')!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
def importable(batches):
    import pyarrow as pa
    try:
        import quarry
        found = True
    except ImportError:
        found = False
    yield pa.RecordBatch.from_arrays([pa.array([found])], names=["found"])
assert not spark.range(1).mapInArrow(importable, "found boolean").first()[0]
for name in sorted(E.LLM_QUERIES):
    assert E.LLM_QUERIES[name](spark, "/root/testdata/sf0.001").count() >= 0
    print("DONE", name)
"""


def test_operators_run_where_workers_lack_the_package():
    cwd = tempfile.mkdtemp(prefix="quarry-workers-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=1500)
    done = [line.split()[1] for line in res.stdout.splitlines() if line.startswith("DONE")]
    assert len(done) == 14, (done, res.stderr[-3000:])
