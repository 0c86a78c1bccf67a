"""The entry module works when loaded by file path from another directory, with Python
workers that cannot import the package (functions shipped to them are pickled by value)."""

import os
import subprocess
import sys
import tempfile
from pathlib import Path

ENTRY = Path(__file__).resolve().parents[1] / "__spark_entry__.py"

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry_under_test", {str(ENTRY)!r})
mod = importlib.util.module_from_spec(spec); spec.loader.exec_module(mod)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
print("ENTRY", mod.entry(spark).count())
for name in ["stem_conflation", "median_value"]:
    print("ROWS", name, len(mod.queries()[name](spark, "/root/testdata/sf0.001").collect()))
"""


def test_entry_loads_by_path_from_elsewhere():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tempfile.gettempdir(), env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.startswith(("ENTRY", "ROWS"))]
    assert lines[0] == "ENTRY 10"
    assert lines[1].startswith("ROWS stem_conflation ") and int(lines[1].split()[-1]) > 0
    assert lines[2] == "ROWS median_value 1"
