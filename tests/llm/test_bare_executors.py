"""Queries run where workers cannot import this package."""

import os
import subprocess
import sys
from pathlib import Path



ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", 4).getOrCreate()
def there(_):
    try:
        import stockflow
        return [1]
    except ImportError:
        return [0]
assert set(spark.sparkContext.range(1).mapPartitions(there).collect()) == {0}
from __spark_entry__ import queries
for name in sys.argv[2:]:
    print(name, queries()[name](spark, "/root/testdata/sf0.001").count())
"""
NAMES = ["op4_lm_scoring", "op5_quality_classifier", "op8_toxicity", "op9_token_output"]
NAMES += ["op11_token_alignment", "op12_merkle_manifest", "op13_suffix_dedup", "stream_dedup_by_state"]


def test_workers_need_no_copy(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT), *NAMES],
        cwd=tmp_path, env=environment, capture_output=True, text=True,
    )
    assert run.returncode == 0, run.stderr[-3000:]
    counts = dict(line.split() for line in run.stdout.splitlines() if line.split()[0] in NAMES)
    assert set(counts) == set(NAMES) and all(int(n) > 0 for n in counts.values())
