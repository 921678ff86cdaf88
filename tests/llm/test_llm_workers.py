"""Python workers must not need the package installed (as on a cluster)."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NAMES = ("op1_suffix_dedup", "op2_simhash", "op3_decontaminate", "op4_html_text", "op5_top_k", "op6_byte_bpe",
         "op8_toxicity", "op11_conversation_repair", "op12_language_id", "op13_source_divergence")

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
import __spark_entry__ as E
for name in {NAMES!r}:
    print(name, E.queries()[name](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_queries_run_without_the_package_on_worker_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    counts = dict(line.split() for line in out.stdout.splitlines() if line.startswith("op"))
    assert all(int(counts[n]) > 0 for n in NAMES)
