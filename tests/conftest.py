import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


def _defaults():
    """The site's file of Spark settings."""
    import pyspark
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(
        os.environ.get("SPARK_HOME") or os.path.dirname(pyspark.__file__), "conf")
    return os.path.join(home, "spark-defaults.conf")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="tiers-tests-")
    builder = (SparkSession.builder.master("local[4]").appName("tiers-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse")))
    # a test run names its own shared folder only where nothing configured one
    if not os.path.exists(_defaults()) or "spark.checkpoint.dir" not in open(_defaults()).read():
        builder = builder.config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as a sorted list of tuples (None sorts first)."""
    def _rows(df):
        def key(t):
            return tuple((v is not None, str(v)) for v in t)
        return sorted((tuple(r) for r in df.collect()), key=key)
    return _rows
