"""Physical plan shapes that matter at scale, checked on the executed plans."""

import os
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tiers.plans import gold, layers, silver
from tiers.sources import driver_tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def ran(df) -> str:
    """The plan that a run ended with (adaptive re-planning included)."""
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles_on(plan: str, column: str) -> int:
    return len(re.findall(rf"Exchange hashpartitioning\({column}#", plan))


def test_fact_moves_once(spark):
    """fact_sales: one shuffle of the sales rows by key (the dedup); both lookups broadcast.
    (The one-file test scan is also spread by its row key; a table at scale is not.)"""
    plan = executed(layers.gold_table(spark, SF, "fact_sales"))
    assert shuffles_on(plan, "sls_ord_num") == 1
    assert shuffles_on(plan, "sls_cust_id") == 0 and shuffles_on(plan, "sls_prd_key") == 0
    assert len(re.findall(r"BroadcastHashJoin .*LeftOuter", plan)) == 2


@pytest.fixture
def large_dimensions(spark):
    """Dimensions the planner would not broadcast; at run time a side must be small to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10k")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_lookups_whose_repeated_keys_are_few_are_broadcast_at_run_time(spark, rows, large_dimensions):
    """The key/count sides are small when they have run, so AQE broadcasts them, on a large fact
    before its own shuffles for the lookups start (on these few rows it can be a tie).
    Building the plan runs no job and caches nothing."""
    sc = spark.sparkContext
    before = sc._jsc.getPersistentRDDs().size()
    layers.gold_table(spark, SF, "fact_sales")          # the driver tables' schemas are read once
    sc.setLocalProperty("spark.jobGroup.id", "building")
    df = layers.gold_table(spark, SF, "fact_sales")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not sc.statusTracker().getJobIdsForGroup("building")
    final = ran(df)
    assert shuffles_on(final, "sls_ord_num") == 1
    assert len(re.findall(r"BroadcastHashJoin .*LeftOuter", final)) == 2
    assert sc._jsc.getPersistentRDDs().size() == before
    assert rows(df) == rows(layers.gold_table(spark, SF, "fact_sales", plain=True))


def test_lookups_shuffle_when_nothing_may_be_broadcast(spark, rows):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = layers.gold_table(spark, SF, "fact_sales")
        assert "SortMergeJoin" in executed(df)
        assert rows(df) == rows(layers.gold_table(spark, SF, "fact_sales", plain=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_required_keys_and_pruning_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bronze_sales")
    driver_tables.raw(spark, SF, "crm_sales_details").write.parquet(path)
    plan = executed(silver.build(spark.read.parquet(path), "sales_details"))
    assert "PushedFilters: [IsNotNull(sls_ord_num), IsNotNull(sls_prd_key), IsNotNull(sls_cust_id)]" in plan


def test_gold_projection_prunes_silver_scans(spark, tmp_path):
    names = ["sales_details", "prd_info", "crm_cust_info"]
    tables = {}
    for n in names:
        p = str(tmp_path / n)
        layers.silver_table(spark, SF, n, stamp=True).write.parquet(p)
        tables[n] = spark.read.parquet(p)
    plan = executed(gold.build("fact_sales", tables))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    # the customer side reads its id and key only, never names, dates or stamps
    assert any(s.startswith("cst_id") and "cst_firstname" not in s for s in schemas)
    assert all("_cleaned_timestamp" not in s for s in schemas)


def test_dim_customer_lookups_share_one_partitioning(spark):
    """Without broadcast, both ERP lookups join on cst_key: the customer side is
    shuffled once (by its dedup key) and reused by both sort-merge joins."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(layers.gold_table(spark, SF, "dim_customer"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles_on(plan, "cst_key") == 1
    assert len(re.findall(r"SortMergeJoin .*LeftOuter", plan)) == 2


def test_small_scan_is_spread_by_its_row_key(spark):
    """One file with one row group scans as one task: it is spread over the cores by
    the row key, and pruning and pushed filters still reach the scan."""
    from tiers.operators.layout import needs_spread, spread
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert needs_spread(li, cores=8)
    df = spread(li, ["l_orderkey", "l_linenumber"], cores=8).filter("l_quantity > 10").select("l_orderkey")
    plan = executed(df)
    assert re.search(r"Exchange hashpartitioning\(l_orderkey#\d+L, l_linenumber#\d+, 8\)", plan)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan
    assert "GreaterThan(l_quantity,10.0)" in plan


def test_scan_of_many_files_is_left_alone(spark, tmp_path):
    """As many files as cores (a table at scale): no exchange is added."""
    from tiers.operators.layout import needs_spread, spread
    path = str(tmp_path / "parts")
    spark.read.parquet(f"{SF}/lineitem.parquet").repartition(4).write.parquet(path)
    li = spark.read.parquet(path)
    assert not needs_spread(li, cores=4)
    assert spread(li, ["l_orderkey", "l_linenumber"], cores=4) is li
    assert needs_spread(li, cores=8)


def test_one_core_never_spreads(spark):
    from tiers.operators.layout import needs_spread
    assert not needs_spread(spark.read.parquet(f"{SF}/lineitem.parquet"), cores=1)


def test_shuffle_partitions_cover_the_largest_input(spark):
    """Raised to input bytes / advisory partition size from estimates alone; never lowered."""
    import math
    from tiers.session import size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        small = spark.range(1000)
        assert size_shuffle_partitions(spark, small) == int(before)
        big = spark.range(10**12)                       # estimated at 8 TB; nothing runs
        n = size_shuffle_partitions(spark, small, big)
        assert n == math.ceil(8 * 10**12 / (64 << 20))
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(n)
        assert size_shuffle_partitions(spark, small) == n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_input_bytes_sum_the_scans_where_the_estimate_multiplies(spark):
    from tiers.operators.model import estimated_bytes, input_bytes
    c = spark.read.parquet(f"{SF}/customer.parquet")
    n = spark.read.parquet(f"{SF}/nation.parquet")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    assert input_bytes(j) == input_bytes(c) + input_bytes(n)
    assert estimated_bytes(j) > input_bytes(j)


def test_shuffle_partitions_scope_restores_the_setting(spark):
    from tiers.session import shuffle_partitions_for
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_partitions_for(spark, spark.range(10**12)) as n:
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == n > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_job_labels_are_scoped_to_the_block(spark):
    from tiers.session import label_jobs
    sc = spark.sparkContext
    with label_jobs(spark, "silver", "s.t"):
        assert sc.getLocalProperty("spark.scheduler.pool") == "silver.s.t"
        assert sc.getLocalProperty("spark.job.description") == "silver s.t"
    assert sc.getLocalProperty("spark.scheduler.pool") is None
    assert sc.getLocalProperty("spark.job.description") is None


def test_more_than_a_few_scan_tasks_are_left_alone(spark, tmp_path):
    """Nine files on any number of cores: no shuffle for the layout."""
    from tiers.operators.layout import FEW_TASKS, needs_spread
    path = str(tmp_path / "nine")
    spark.read.parquet(f"{SF}/lineitem.parquet").repartition(FEW_TASKS + 1).write.parquet(path)
    assert not needs_spread(spark.read.parquet(path), cores=8000)


def test_nothing_is_spread_unless_asked(spark):
    assert "Exchange" not in executed(driver_tables.table(spark, SF, "lineitem"))
    assert "Exchange" in executed(driver_tables.table(spark, SF, "lineitem", spread_rows=True))


@pytest.mark.parametrize("name", ["reconcile", "fact_fanout"])
def test_checks_scan_the_sales_once(spark, name):
    import __spark_entry__ as entry
    plan = executed(entry.queries()[name](spark, SF))
    assert len(re.findall(r"FileScan parquet \[[^]]*l_linenumber", plan)) == 1
    assert shuffles_on(plan, "sls_ord_num") == 1


def test_large_input_is_decided_by_size_alone(spark):
    """Estimated at 8 TB: no spread, decided before any file list is fetched."""
    from tiers.operators.layout import needs_spread
    assert not needs_spread(spark.range(10**12), cores=8)


def test_no_text_goes_through_the_join_of_the_sales_export(spark):
    """Both sides of it are shuffled where orders are many: marks and numbers go, texts are made behind it."""
    plan = driver_tables.raw(spark, SF, "crm_sales_details")._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    for side in range(2):
        out = plan.children().apply(side).output()
        types = [out.apply(i).dataType().simpleString() for i in range(out.size())]
        assert len(types) <= 6 and not {"string", "timestamp", "timestamp_ntz"} & set(types)


def test_sales_export_of_odd_lines(spark):
    """Every line number with every flag and status, and NULLs anywhere: a condition that is NULL does not hold."""
    lines = [(1, 7, n, r, s, price, q, d, day)
             for n in (None, 1, 2, 3, 4, 5, 6, 7, 9) for r in (None, "A", "N", "R", "x") for s in (None, "O", "F")
             for price, q, d, day in ((1234.565, 3.0, 0.0, "1996-03-13 23:59:59"), (None, None, None, None), (0.01, 7.9, 0.1, "0999-12-31 00:00:00"))]
    lines += [(None, 7, 1, "A", "O", 1.0, 1.0, 0.0, None), (2, None, 1, "A", "O", 1.0, 1.0, 0.0, None), (3, 7, 1, "A", "O", 1.0, 1.0, 0.0, None)]
    lineitem = spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string,"
                                            "l_extendedprice double, l_quantity double, l_discount double, day string"
                                     ).withColumn("l_shipdate", F.to_timestamp("day"))
    orders = spark.createDataFrame([(1, 5, "2020-02-29 12:00:00"), (2, None, None), (None, 6, None)], "o_orderkey long, o_custkey long, day string"
                                   ).withColumn("o_orderdate", F.to_timestamp("day"))
    got = driver_tables.crm_sales_details(lineitem, orders).collect()

    def ymd(t, days=0):
        return None if t is None else int((date.fromisoformat(t[:10]) + timedelta(days)).strftime("%Y%m%d"))

    def expected(o, part, n, r, s, price, q, d, day):
        cents = None if price is None else int(price * 100 + 0.5)
        plain = None if cents is None else f"{cents // 100}.{cents % 100:02d}"
        unit = None if price is None else int(price * 100 / q + 0.5)
        unit = None if unit is None else f"{unit // 100}.{unit % 100:02d}"
        ship = ymd(day)
        return (f"SO{o}", None if (n == 7 and r == "N") or part is None else f"P{part}", 5 if o == 1 else None,
                0 if n == 6 else ymd("2020-02-29") if o == 1 else None,
                "5489" if s == "O" and n == 5 else None if ship is None else f"{ship:08d}",
                (None if ship is None else ship // 10000 * 10000 + 1332) if r == "R" and n == 4 else ymd(day, 30),
                None if plain is None and r == "A" else f"${cents // 100:,}.{cents % 100:02d}" if r == "A" else plain if r == "N"
                else None if n == 3 else "n/a" if n == 2 else plain,
                "x" if n == 1 and r == "A" else None if q is None else str(int(q)),
                None if unit is None else f"-{unit}" if d == 0 else unit)

    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(*x)) for x in lines if x[0] in (1, 2))
