"""Every query of the operators with workers that cannot import the package."""

import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL

CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as E
from pricewise.session import get_spark
spark = get_spark("local[4]", 4)
queries = E.queries()
for name in sorted(n for n in queries if n.startswith("op") and n[2].isdigit() or n == "pipeline"):
    queries[name](spark, {data!r}).write.format("noop").mode("overwrite").save()
    print("ran", name)
"""


def test_queries_run_where_workers_lack_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, data=SF_SMALL)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    ran = [line.split()[1] for line in out.stdout.splitlines() if line.startswith("ran ")]
    assert len(ran) == 14, ran
