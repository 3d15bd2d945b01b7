"""Every registered query against its DuckDB twin on the smallest driver tables.

The same comparison the driver runs at sf0.01 (``python -m tools.oracle_check``).
"""

import os

import pytest

import __spark_entry__ as entry
from tiers.plans.queries import QUERIES
from tools.oracle_check import compare, duck

SF = os.environ.get("TIERS_TEST_SF", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, con)
    assert res["status"] == "ok", res


def test_every_query_has_an_oracle():
    missing = set(QUERIES) - set(entry.oracle_sql())
    assert not missing, missing


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_number", "product_key", "customer_id", "order_date", "sales_amount",
                          "quantity", "price"]
    assert df.count() > 0
