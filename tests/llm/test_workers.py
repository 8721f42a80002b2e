import os
import subprocess
import sys

import marlstone

SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # the driver alone finds the package
from marlstone.session import local_session
from marlstone.llm.queries import QUERIES
spark = local_session(4, "workers")
def cannot(rows):
    import importlib.util
    yield from ([] if importlib.util.find_spec("marlstone") is None else [1])
assert spark.sparkContext.parallelize([0], 1).mapPartitions(cannot).collect() == []
for name, run in QUERIES.items():
    print(name, run(spark, {folder!r}).count())
"""


def test_queries_run_where_workers_cannot_import_the_package(tmp_path, folder):
    root = os.path.dirname(os.path.dirname(marlstone.__file__))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=root, folder=folder)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.count("op") == 13
