"""Tables that remember builds, export fingerprints, and counts observed on the silver write."""

import datetime as dt

import pytest

from tiers.plans import bronze, runner, silver, state
from tiers.plans.specs import SILVER
from tiers.sources import catalog, files


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def _ingest(spark, tmp_path, schema, **opts):
    report = bronze.ingest(spark, str(tmp_path / "land"), ("s", "gone"), schema=schema, location=str(tmp_path / schema),
                           state=f"{schema}.loads", **opts)
    return {r.file_name: (r.status, r.rows) for r in report.collect() if r.file_name}


def test_fingerprints_tell_every_change_of_a_part(spark, tmp_path):
    base = tmp_path / "land" / "s"
    _write(base / "1_a.csv" / "p1.csv", "x\n1\n")
    _write(base / "1_a.csv" / "p2.csv", "x\n2\n")
    _write(base / "with space.csv", "x\n1\n")
    _write(base / "notes.txt", "n")

    def now():
        return {r.name: r for r in files.fingerprints(spark, str(base), subset="s").collect()}

    first = now()
    assert {n: (r.n_files, r.size) for n, r in first.items()} == {"1_a.csv": (2, 8), "with space.csv": (1, 4)}
    assert {n: r.digest for n, r in now().items()} == {n: r.digest for n, r in first.items()}
    _write(base / "1_a.csv" / "p3.csv", "x\n")
    second = now()
    assert second["1_a.csv"].digest != first["1_a.csv"].digest
    assert second["with space.csv"].digest == first["with space.csv"].digest
    (base / "1_a.csv" / "p3.csv").rename(base / "1_a.csv" / "p4.csv")
    assert now()["1_a.csv"].digest != second["1_a.csv"].digest


def test_a_second_ingest_writes_no_table(spark, tmp_path, monkeypatch):
    land = tmp_path / "land" / "s"
    _write(land / "100_a.csv", "x\n1\n")
    _write(land / "200_a.csv", "x\n")                       # empty: the older one stands
    _write(land / "100_b.csv" / "p1.csv", "x,y\n1,2\n")
    first = _ingest(spark, tmp_path, "again1")
    assert first == {"200_a.csv": ("empty", 0), "100_a.csv": ("ok", 1), "100_b.csv": ("ok", 1)}
    with monkeypatch.context() as m:
        m.setattr(catalog, "save_table", lambda *a, **k: pytest.fail("a table was written"))
        second = _ingest(spark, tmp_path, "again1")
    assert second == {"200_a.csv": ("empty", 0), "100_a.csv": ("unchanged", 1), "100_b.csv": ("unchanged", 1)}

    _write(land / "300_a.csv", "x\n1\n2\n3\n")              # newest usable export
    _write(land / "100_b.csv" / "p1.csv", "x,y\n1,2\n5,6\n")  # the same name, other content
    third = _ingest(spark, tmp_path, "again1")
    assert third == {"300_a.csv": ("ok", 3), "200_a.csv": ("superseded", None), "100_a.csv": ("superseded", None),
                     "100_b.csv": ("ok", 2)}
    assert spark.table("again1.s_a").count() == 3 and spark.table("again1.s_b").count() == 2


def test_a_table_changed_or_dropped_by_others_is_loaded_again(spark, tmp_path):
    land = tmp_path / "land" / "s"
    _write(land / "1_a.csv", "x\n1\n")
    _write(land / "1_b.csv", "x\n1\n")
    _ingest(spark, tmp_path, "again2")
    catalog.save_table(spark.table("again2.s_a").limit(0), "again2.s_a")
    catalog.drop_table(spark, "again2.s_b")
    assert _ingest(spark, tmp_path, "again2") == {"1_a.csv": ("ok", 1), "1_b.csv": ("ok", 1)}
    assert spark.table("again2.s_a").count() == 1
    # other options are another load
    assert _ingest(spark, tmp_path, "again2", schemas={"s_a": "x STRING"}) == {
        "1_a.csv": ("ok", 1), "1_b.csv": ("unchanged", 1)}


def test_state_needs_one_source_per_table(spark, tmp_path):
    with pytest.raises(ValueError, match="latest_only"):
        _ingest(spark, tmp_path, "again3", latest_only=False)


CSV = {
    "crm/1_cust_info.csv": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date\n"
                           "1,K1,a,b,M,F,10/06/2025\n",
    "crm/1_prd_info.csv": "prd_id,prd_key,prd_nm,prd_line,prd_cost\n1,CO-RF-P1,n,r,1.5\n",
    "crm/1_sales_details.csv": "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,sls_sales,sls_quantity,"
                               "sls_price\nS1,P1,1,20101229,20101229,20101229,$5,1,5\n",
    "erp/1_cust_az12.csv": "CID,BDATE,GEN\nNASK1,1971-10-06,F\n",
    "erp/1_loc_a101.csv": "CID,CNTRY\nK-1,x\n",
    "erp/1_px_cat_g1v2.csv": "ID,CAT,SUBCAT,MAINTENANCE\nCO_RF,c,s,yes\n",
}


def test_a_run_that_failed_in_gold_goes_on_there(spark, tmp_path, monkeypatch):
    for name, text in CSV.items():
        _write(tmp_path / "land" / name, text)
    names = ("res_b", "res_s", "res_g")

    def run():
        report = runner.run_all(spark, str(tmp_path / "land"), schemas=names, location=str(tmp_path / "w"), state="res_b.builds")
        return {r.table_name: r.status for r in report.collect() if r.status != "superseded"}

    whole = catalog.save_table
    with monkeypatch.context() as m:
        def failing(df, table, **k):
            if table == "res_g.fact_sales":
                raise RuntimeError("lost")
            return whole(df, table, **k)
        m.setattr(catalog, "save_table", failing)
        first = run()
    assert first.pop("res_g.fact_sales") == "failed" and set(first.values()) == {"ok"}
    second = run()
    assert second.pop("res_g.fact_sales") == "ok" and set(second.values()) == {"unchanged"}
    assert set(run().values()) == {"unchanged"}
    # one new export: only what comes from it is built
    _write(tmp_path / "land" / "erp" / "2_loc_a101.csv", "CID,CNTRY\nK-1,y\n")
    third = run()
    assert {t for t, s in third.items() if s == "ok"} == {"res_b.erp_loc_a101", "res_s.loc_a101", "res_g.dim_customer"}
    assert spark.table("res_g.dim_customer").first().country == "Y"


SALES = "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt string, sls_ship_dt string, sls_due_dt string, " \
        "sls_sales string, sls_quantity string, sls_price string"


def _sales(spark):
    day = "20101229"
    return spark.createDataFrame([
        ("S1", "P", 1, day, day, day, "$1", "1", "1"),
        ("S1", "P", 1, day, day, day, "$1", "1", "1"),          # a whole copy
        ("S1", "P", None, "0", day, day, "$0", "1", "1"),       # no customer, sorts first
        ("S2", "P", 2, "0", "5489", None, "x", "y", "-3"),      # four lost, one NULL before
        (None, "P", 2, "0", day, day, "1", "1", "1"),
        (None, None, 2, "0", day, day, "1", "1", "1"),
        ("S3", "P", None, day, day, day, "1", "1", "1"),
    ], SALES)


def test_counts_tell_what_became_of_every_row(spark, rows):
    df, observed = silver.build_counted(_sales(spark), "sales_details", stamp=False)
    got = rows(df)
    assert got == rows(silver.build(_sales(spark), "sales_details", stamp=False))
    counts = observed.get
    assert {k: counts[k] for k in ("rows_read", "no_key", "repeated", "kept")} == {
        "rows_read": 7, "no_key": 4, "repeated": 1, "kept": 2}
    assert {k for k, v in counts.items() if k.startswith("lost_") and v} == {
        "lost_sls_order_dt", "lost_sls_ship_dt", "lost_sls_sales", "lost_sls_quantity"}
    assert all(counts[f"lost_{c}"] in (0, 1) for c in SILVER["sales_details"].parsed)


def test_counts_need_one_scan_and_one_shuffle(spark):
    df, _ = silver.build_counted(_sales(spark).select("*"), "sales_details")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Scan") == 1 and plan.count("CollectMetrics") == 1


@pytest.mark.parametrize("name", sorted(SILVER))
def test_counted_build_of_no_rows(spark, name):
    from tiers.sources import driver_tables
    schema = driver_tables.raw(spark, "/root/testdata/sf0.001", SILVER[name].source).schema
    df, observed = silver.build_counted(spark.createDataFrame([], schema), name)
    assert df.count() == 0
    assert not any(observed.get.values())


def test_the_last_build_of_a_table_counts(spark, tmp_path):
    catalog.ensure_schema(spark, "states", str(tmp_path / "states"))
    catalog.save_table(spark.range(3), "states.t")
    state.ensure(spark, "states.builds")
    for i in range(3):
        state.record(spark, "states.builds", "states.t", "src", f"digest {i}", i)
    known = state.remembered(spark, "states.builds")
    assert known["states.t"][:2] == ("src", "digest 2")
    assert state.unchanged(spark, known, "states.t", "src", "digest 2") == 2
    assert state.unchanged(spark, known, "states.t", "src", "digest 1") is None
    assert spark.table("states.builds").filter("built_at IS NULL").count() == 0
    assert dt.datetime.now().year >= spark.table("states.builds").first().built_at.year


def test_a_large_bronze_table_is_deduplicated_in_two_phases(spark, rows, tmp_path, monkeypatch):
    """The rows of the plain form, and no shuffle of rows whose key stands once."""
    from tiers.operators import clean
    catalog.ensure_schema(spark, "two_b", str(tmp_path / "two_b"))
    sales = _sales(spark)
    catalog.save_table(sales, "two_b.crm_sales_details")
    want = rows(silver.build(spark.table("two_b.crm_sales_details"), "sales_details", stamp=False))
    phases = []
    plain = clean._dedupe_repeated
    monkeypatch.setattr(clean, "_dedupe_repeated", lambda *a: phases.append(1) or plain(*a))
    for most in (clean.BROADCAST_KEYS, 0):       # beyond the bound all rows go through the plain form
        monkeypatch.setattr(clean, "BROADCAST_KEYS", most)
        for least, name in ((0, "two_s"), (1 << 40, "one_s")):
            phases.clear()
            monkeypatch.setattr(runner, "TWO_PHASE_BYTES", least)
            report = runner.run_silver(spark, "two_b", f"{name}{most}", names=["sales_details"], location=str(tmp_path / f"{name}{most}"))
            assert report.first().status == "ok" and len(phases) == (least == 0)
            assert rows(spark.table(f"{name}{most}.sales_details").drop("_cleaned_timestamp")) == want


def test_gold_may_broadcast_what_aqe_has_measured(spark):
    from tiers.session import aqe_broadcast
    key, static = "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(static)
    with aqe_broadcast(spark, "64m"):
        assert spark.conf.get(key) == "64m" and spark.conf.get(static) == before
    assert spark.conf.get(key, None) is None
    try:
        spark.conf.set(static, "-1")
        with aqe_broadcast(spark, "64m"):        # turned off stays off
            assert spark.conf.get(key, None) is None
    finally:
        spark.conf.set(static, before)
