"""Silver tables stored in buckets of their join key: the gold joins on it need no shuffle."""

import re

import pytest

from tiers.plans import gold, runner
from tiers.plans.specs import GOLD_SPECS, SILVER
from tiers.sources import catalog, driver_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The silver schemas without and with buckets."""
    home = tmp_path_factory.mktemp("buckets")
    catalog.ensure_schema(spark, "bk_b", str(home / "b"))
    for spec in SILVER.values():
        catalog.save_table(driver_tables.raw(spark, SF, spec.source), f"bk_b.{spec.source}")
    for schema, n in (("bk_plain", None), ("bk_set", 4)):
        for _ in range(2):          # the second run overwrites
            report = runner.run_silver(spark, "bk_b", schema, location=str(home / schema), buckets=n)
            assert {r.status for r in report.collect()} == {"ok"}
    return "bk_plain", "bk_set"


def _gold(spark, schema, name):
    spec = GOLD_SPECS[name]
    return gold.build(spec, {t: spark.table(f"{schema}.{t}") for t in [spec.base] + [lk.table for lk in spec.lookups]},
                      stamp=False)


def _exchanges(df):
    return re.findall(r"Exchange hashpartitioning\((\w+)#", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", sorted(GOLD_SPECS))
def test_same_rows(spark, rows, stored, name):
    plain, bucketed = (_gold(spark, s, name) for s in stored)
    assert rows(plain) == rows(bucketed) and plain.schema == bucketed.schema


def test_dim_customer_joins_without_a_shuffle(spark, stored, no_broadcast):
    plain, bucketed = (_gold(spark, s, "dim_customer") for s in stored)
    assert len(_exchanges(plain)) == 3
    assert _exchanges(bucketed) == []


def test_the_fact_does_not_move_for_its_bucketed_key(spark, stored, no_broadcast):
    plain, bucketed = (_gold(spark, s, "fact_sales") for s in stored)
    assert "sls_prd_key" in _exchanges(plain) and "prd_id" in _exchanges(plain)
    assert not {"sls_prd_key", "prd_id"} & set(_exchanges(bucketed))


def test_an_overwrite_keeps_the_buckets(spark, stored):
    for name, spec in SILVER.items():
        d = catalog._details(spark, f"bk_set.{name}")
        assert (d["Num Buckets"], d["Bucket Columns"]) == ("4", f"[`{spec.join_key}`]")
        assert "Num Buckets" not in catalog._details(spark, f"bk_plain.{name}")
