"""The driver contract, exercised the way a harness would: from a foreign
working directory, loading __spark_entry__.py by path, with no PYTHONPATH."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SNIPPET = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(REPO, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
qs, sql = E.queries(), E.oracle_sql()
assert set(sql) <= set(qs)
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
assert E.entry(spark).count() > 0
# a query over grouped aggregates and a special function
assert qs["feature_select"](spark, "/root/testdata/sf0.001").count() >= 0
print("CONTRACT_OK", len(qs), len(sql))
"""


def test_contract_from_foreign_cwd(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SNIPPET], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "CONTRACT_OK" in out.stdout, out.stderr[-3000:]
