"""The package reaches Python workers whose folder is not the source folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from limelight.session import build_session
sys.path.remove({root!r})
spark = build_session("local[2]", shuffle_partitions=2)
print("ROWS", entry.queries()["salience"](spark, "/root/testdata/sf0.001").count())
"""


def test_salience_runs_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-4000:]
    assert int(out.stdout.split("ROWS")[1]) > 0
