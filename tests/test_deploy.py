import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {path!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
queries = entry.queries()
for name in ("generation_status", "topk_l2", "generate_in_sql", "ingest_rescued"):
    assert queries[name](spark, {sf!r}).count() > 0, name
print("all ran")
"""


def test_workers_need_no_installed_package(tmp_path, sf_dir):
    """Executors run the package's functions without having the package on their path."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(path=os.path.join(ROOT, "__spark_entry__.py"), sf=sf_dir)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, text=True,
                          capture_output=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-2000:]
