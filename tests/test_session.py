"""The session helpers outside a configured site."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import os, sys
from tiers import get_session
from tiers.session import shared_dir
spark = get_session("local[1]", shuffle_partitions=2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
path = shared_dir(spark, "x")
assert path.startswith(os.environ["TMPDIR"]) and shared_dir(spark, "x", unique=False) == shared_dir(spark, "x", unique=False)
spark.range(5).write.parquet(path)
assert spark.read.parquet(path).count() == 5 and spark.range(3).checkpoint().count() == 3
print("started")
"""


def test_get_session_starts_where_nothing_names_a_folder(tmp_path):
    """A Spark without any site settings; none of them can be set on the running session."""
    (tmp_path / "conf").mkdir()
    (tmp_path / "tmp").mkdir()
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK_GATEWAY") and k != "PYSPARK_SUBMIT_ARGS"}
    env |= {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TMPDIR": str(tmp_path / "tmp"), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", SCRIPT], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "started" in done.stdout, done.stderr[-2000:]
