"""Queries that run Python on the executors work from any folder."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from tickloom.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=2)
q = entry.queries()
for name in ("g10_isolated_batch_scoring", "d7_macd"):
    assert q[name](spark, "/root/testdata/sf0.001").count() > 0
print("fine")
"""


def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE, REPO], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]
