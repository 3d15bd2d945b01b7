"""File listing, naming, CSV reads, catalog writes and clean-up, stream ingest."""

import os

import pytest
from pyspark.sql import functions as F

from tiers.sources import catalog, files
from tiers.streaming import ingest_available


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "crm").mkdir()
    (tmp_path / "crm" / "20260101_cust_info.csv").write_text("a,b\n1,x\n")
    (tmp_path / "crm" / "20260301_cust_info.csv").write_text("a,b\n2,y\n3,z\n")
    (tmp_path / "crm" / "2026_my file-v2.csv").write_text("a,b\n")
    (tmp_path / "crm" / "readme.txt").write_text("x")
    return tmp_path


def test_list_files_keeps_csv(spark, folder):
    got = sorted(r.name for r in files.list_files(spark, str(folder / "crm"), subset="crm").collect())
    assert got == ["20260101_cust_info.csv", "20260301_cust_info.csv", "2026_my file-v2.csv"]


def test_list_missing_folder_raises(spark, folder):
    with pytest.raises(Exception):
        files.list_files(spark, str(folder / "nope"))


def test_table_name_rules(spark):
    df = spark.createDataFrame([("/crm", "20260307225047176852_sales_details.csv"),
                                ("erp", "2026_my file-v2.csv"), ("erp", "plain.csv")], "s string, n string")
    new = [r[0] for r in df.select(files.table_name("s", "n")).collect()]
    old = [r[0] for r in df.select(files.table_name("s", "n", strip_timestamp=False)).collect()]
    assert new == ["crm_sales_details", "erp_my_file_v2", "erp_plain"]                 # K9
    assert old == ["crm_20260307225047176852_sales_details", "erp_2026_my file-v2", "erp_plain"]  # K10


def test_latest_file_wins(spark, folder):
    listing = files.list_files(spark, str(folder / "crm"), subset="crm") \
        .withColumn("table_name", files.table_name("subset", "name"))
    got = {r.table_name: r.name for r in files.latest_files(listing).collect()}
    assert got["crm_cust_info"] == "20260301_cust_info.csv"                               # K11


def test_latest_files_flag_keeps_every_file(spark, folder):
    listing = files.list_files(spark, str(folder / "crm"), subset="crm") \
        .withColumn("table_name", files.table_name("subset", "name"))
    got = sorted((r.name, r.is_latest) for r in files.latest_files(listing, flag="is_latest").collect())
    assert got == [("20260101_cust_info.csv", False), ("20260301_cust_info.csv", True),
                   ("2026_my file-v2.csv", True)]


def test_read_csv_modes(spark, folder):
    p = str(folder / "crm" / "20260301_cust_info.csv")
    inferred = files.read_csv(spark, p)
    assert inferred.schema.simpleString() == "struct<a:int,b:string>"                     # S1
    assert files.read_csv(spark, p, infer=False).schema.simpleString() == "struct<a:string,b:string>"  # S2
    typed = files.read_csv(spark, p, schema="a LONG, b STRING")
    assert typed.count() == 2
    with pytest.raises(Exception):                                                         # T13
        files.read_csv(spark, p, schema="x LONG, y STRING").collect()


def test_folder_of_parts_reads_as_one_table(spark, tmp_path):
    out = str(tmp_path / "export.csv")
    spark.range(100).repartition(4).write.option("header", "true").csv(out)
    assert files.read_csv(spark, out).count() == 100                                      # S3


def test_peek_text(spark, folder):
    lines = files.peek_text(spark, str(folder / "crm" / "*.csv"), n=2)
    assert lines.count() == 2                                                              # S4


def test_audit_columns_encoded_path(spark, folder):
    df = files.add_audit(files.read_csv(spark, str(folder / "crm" / "2026_my file-v2.csv")))
    assert df.columns == ["a", "b", "_ingest_timestamp", "_source_file"]
    df2 = files.add_audit(files.read_csv(spark, str(folder / "crm" / "20260101_cust_info.csv")))
    src = df2.select("_source_file").first()[0]
    assert src.endswith("20260101_cust_info.csv")
    (folder / "crm" / "a b.csv").write_text("a,b\n1,x\n")
    enc = files.add_audit(files.read_csv(spark, str(folder / "crm" / "a b.csv")))
    path = enc.select("_source_file").first()[0]
    assert path.endswith("a%20b.csv")                                                      # T14
    from tiers.functions.audit import base_name
    assert enc.select(base_name("_source_file")).first()[0] == "a b.csv"


# ---- catalog -----------------------------------------------------------------

def test_save_table_counts_and_replaces(spark, tmp_path):
    catalog.ensure_schema(spark, "cat_t1", str(tmp_path / "cat_t1"))
    r = catalog.save_table(spark.range(7), "cat_t1.a")
    assert r == {"table": "cat_t1.a", "rows": 7}                                            # A1
    r = catalog.save_table(spark.range(3).withColumn("x", F.lit("s")), "cat_t1.a")          # K1
    assert r["rows"] == 3 and spark.table("cat_t1.a").columns == ["id", "x"]
    assert [t.name for t in spark.catalog.listTables("cat_t1")] == ["a"]                  # no staging left


def test_schema_guard(spark, tmp_path):
    catalog.ensure_schema(spark, "cat_t2", str(tmp_path / "cat_t2"))
    catalog.save_table(spark.range(5), "cat_t2.a", replace_schema=False)
    catalog.save_table(spark.range(6), "cat_t2.a", replace_schema=False)
    with pytest.raises(catalog.SchemaMismatch):                                            # K2
        catalog.save_table(spark.range(2).selectExpr("CAST(id AS STRING) AS id"), "cat_t2.a",
                           replace_schema=False)
    assert spark.table("cat_t2.a").count() == 6


def test_failed_write_keeps_old_table(spark, tmp_path):
    catalog.ensure_schema(spark, "cat_t3", str(tmp_path / "cat_t3"))
    catalog.save_table(spark.range(4), "cat_t3.a")
    spark.conf.set("spark.sql.ansi.enabled", "true")
    bad = spark.range(3).selectExpr("CAST(CONCAT('x', id) AS INT) AS id")
    with pytest.raises(Exception):
        catalog.save_table(bad, "cat_t3.a")
    assert spark.table("cat_t3.a").count() == 4
    assert [t.name for t in spark.catalog.listTables("cat_t3")] == ["a"]      # staging cleaned up


def test_tables_columns_clear(spark, tmp_path):
    catalog.ensure_schema(spark, "cat_t4", str(tmp_path / "cat_t4"))
    catalog.save_table(spark.range(1), "cat_t4.a")
    catalog.save_table(spark.range(1).withColumn("y", F.lit(1)), "cat_t4.b")
    assert sorted(r.tableName for r in catalog.tables(spark, "cat_t4").collect()) == ["a", "b"]   # K4
    assert [r.col_name for r in catalog.columns(spark, "cat_t4.b").collect()] == ["id", "y"]       # K5
    assert catalog.clear_schema(spark, "cat_t4").filter("status = 'planned'").count() == 2          # K6
    assert catalog.tables(spark, "cat_t4").count() == 2
    done = catalog.clear_schema(spark, "cat_t4", dry_run=False)
    assert sorted(r.status for r in done.collect()) == ["dropped", "dropped"]
    assert catalog.tables(spark, "cat_t4").count() == 0
    catalog.drop_schema(spark, "cat_t4", cascade=True)                                              # K7
    assert "cat_t4" not in [d.name for d in spark.catalog.listDatabases()]


def test_query_table_binds_name_and_value(spark, tmp_path):
    catalog.ensure_schema(spark, "cat_t5", str(tmp_path / "cat_t5"))
    catalog.save_table(spark.range(10), "cat_t5.a")
    assert catalog.query_table(spark, "cat_t5.a", "id = :v", v=3).count() == 1              # S7
    assert catalog.sample(spark, "cat_t5.a", 3, "id").collect()[-1].id == 2                  # K8


# ---- stream ------------------------------------------------------------------

def test_stream_ingest_reads_each_file_once(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("CID,CNTRY\n1,x\n2,y\n")
    catalog.ensure_schema(spark, "st_t", str(tmp_path / "st_t"))
    ck = str(tmp_path / "ck")
    ingest_available(spark, str(land), "st_t.loc", "CID STRING, CNTRY STRING", checkpoint=ck)
    assert spark.table("st_t.loc").count() == 2
    (land / "b.csv").write_text("CID,CNTRY\n3,z\n")
    ingest_available(spark, str(land), "st_t.loc", "CID STRING, CNTRY STRING", checkpoint=ck)
    t = spark.table("st_t.loc")
    assert t.count() == 3                                                                     # no repeat
    assert {os.path.basename(r[0]) for r in t.select("_source_file").distinct().collect()} == {"a.csv", "b.csv"}


def test_stream_ingest_commits_through_the_sink_log(spark, tmp_path):
    """The file sink's commit log sits in the table folder; a run with no new file reads nothing."""
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.csv").write_text("CID,CNTRY\n1,x\n")
    catalog.ensure_schema(spark, "st_log", str(tmp_path / "st_log"))
    ck = str(tmp_path / "ck")
    assert ingest_available(spark, str(land), "st_log.loc", "CID STRING, CNTRY STRING", checkpoint=ck) == 1
    assert os.path.isdir(tmp_path / "st_log" / "loc" / "_spark_metadata")
    assert ingest_available(spark, str(land), "st_log.loc", "CID STRING, CNTRY STRING", checkpoint=ck) == 0
    assert spark.table("st_log.loc").count() == 1


def test_folder_with_mixed_headers_is_refused(spark, tmp_path):
    d = tmp_path / "mixed"
    d.mkdir()
    (d / "a.csv").write_text("x,y\n1,2\n")
    (d / "b.csv").write_text("y,x\n3,4\n")
    with pytest.raises(Exception, match="CSV header does not conform"):                 # T13
        files.read_csv(spark, str(d), check_headers=True).collect()
    (d / "b.csv").write_text("x,y\n3,4\n")
    assert files.read_csv(spark, str(d), check_headers=True).count() == 2


def test_overwrite_table_from_itself(spark, tmp_path):
    """Staged writes allow replacing a table with a plan that reads it."""
    catalog.ensure_schema(spark, "cat_t6", str(tmp_path / "cat_t6"))
    catalog.save_table(spark.range(10), "cat_t6.a")
    r = catalog.save_table(spark.table("cat_t6.a").filter("id < 4"), "cat_t6.a")
    assert r["rows"] == 4 and spark.table("cat_t6.a").count() == 4


def test_listing_sizes(spark, tmp_path):
    out = str(tmp_path / "x" / "export.csv")
    spark.range(50).write.option("header", "true").csv(out)
    shallow = files.list_files(spark, str(tmp_path / "x")).first()
    deep = files.list_files(spark, str(tmp_path / "x"), deep_size=True).first()
    assert shallow.is_dir and shallow.size == 0 and deep.size > 0


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def _ingest(spark, tmp_path, schema, **opts):
    from tiers.plans import bronze
    report = bronze.ingest(spark, str(tmp_path / "land"), ("s",), schema=schema, location=str(tmp_path / schema), **opts)
    return {r.file_name: r.status for r in report.collect()}


def test_newest_usable_export_wins(spark, tmp_path):
    """An empty or broken newest file never removes what an older one holds."""
    land = tmp_path / "land" / "s"
    _write(land / "100_a.csv", "x\n1\n")
    _write(land / "200_a.csv", "x\n")
    _write(land / "100_b.csv", "x\n1\n2\n")
    _write(land / "200_b.csv", "other\n5\n")
    _write(land / "050_b.csv", "x\n9\n")
    _write(land / "100_c.csv", "x\n1\n")
    _write(land / "200_c.csv", "x\n7\n8\n")
    got = _ingest(spark, tmp_path, "newest", schemas={"s_b": "x INT"})
    assert got == {"100_a.csv": "ok", "200_a.csv": "empty", "100_b.csv": "ok", "200_b.csv": "failed",
                   "050_b.csv": "superseded", "100_c.csv": "superseded", "200_c.csv": "ok"}
    assert [spark.table(f"newest.s_{t}").count() for t in "abc"] == [1, 2, 2]


def test_all_files_of_a_table_load_in_order(spark, tmp_path):
    land = tmp_path / "land" / "s"
    for i in range(6):
        _write(land / f"{i}00_a.csv", "x\n" + "1\n" * (i + 1))
    assert set(_ingest(spark, tmp_path, "in_order", latest_only=False, parallelism=4).values()) == {"ok"}
    assert spark.table("in_order.s_a").count() == 6


def test_mixed_headers_fail_in_the_ingest(spark, tmp_path):
    land = tmp_path / "land" / "s"
    _write(land / "100_m.csv" / "p1.csv", "x,y\n1,2\n")
    _write(land / "100_m.csv" / "p2.csv", "y,x\n3,4\n")
    assert _ingest(spark, tmp_path, "mixed_headers") == {"100_m.csv": "failed"}
    assert not spark.catalog.tableExists("mixed_headers.s_m")


def test_errors_are_kept_whole(spark, tmp_path):
    from tiers.plans import bronze, runner
    e = ValueError("first\n" + "x" * 2000)
    assert bronze._err(e) == runner._err(e) == "ValueError: first\n" + "x" * 2000


@pytest.mark.parametrize("fail_at", range(4))
def test_a_swap_that_breaks_anywhere_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, fail_at):
    """K1: a failure at any catalog step of the swap, then one without any clean-up (a crash)."""
    schema = f"swap{fail_at}"
    catalog.ensure_schema(spark, schema, str(tmp_path / schema))
    table = f"{schema}.a"
    for crash in (False, True):
        catalog.save_table(spark.range(3), table)
        steps = iter(range(10))

        def step(real):
            def run(*a):
                if next(steps) == fail_at:
                    raise (KeyboardInterrupt if crash else RuntimeError)("injected")
                return real(*a)
            return run
        with monkeypatch.context() as m:
            m.setattr(catalog, "_rename", step(catalog._rename))
            m.setattr(catalog, "drop_table", step(catalog.drop_table))
            try:
                catalog.save_table(spark.range(5).withColumn("x", F.lit(1)), table)
            except (RuntimeError, KeyboardInterrupt):
                pass
        assert catalog.read_table(spark, table).count() in (3, 5)
        catalog.save_table(spark.range(7), table)
        assert catalog.read_table(spark, table).count() == 7
        left = [t.name for t in spark.catalog.listTables(schema)]
        assert "a" in left and "a__replaced" not in left


def test_readers_never_fail_during_overwrites(spark, tmp_path):
    """K1: one catalog operation an overwrite; a scan that began before it still ends."""
    import threading
    catalog.ensure_schema(spark, "ver1", str(tmp_path / "ver1"))
    table = "ver1.a"
    catalog.save_table(spark.range(10), table)
    seen, failed, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.add(spark.table(table).count())
            except Exception as e:
                failed.append(str(e)[:300])
    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(11, 19):
            before = spark.table(table)
            catalog.save_table(spark.range(n), table)
            assert before.count() in (n - 1, n)
    finally:
        done.set()
        reader.join()
    assert not failed and seen <= set(range(10, 19)) and len(seen) > 1
    assert spark.table(table).count() == 18
    assert len(list((tmp_path / "ver1" / "a__versions").iterdir())) == 2       # this version and the one before
    assert catalog._details(spark, table)["Type"] == "MANAGED"


def test_versions_end_with_the_table(spark, tmp_path):
    """A dropped table leaves no folder; a changed schema after versions, and versions after that, work."""
    catalog.ensure_schema(spark, "ver2", str(tmp_path / "ver2"))
    table = "ver2.a"
    for n in (3, 4, 5):
        catalog.save_table(spark.range(n), table)
    for n in (6, 7):
        catalog.save_table(spark.range(n).withColumn("x", F.lit("s")), table)
        assert spark.table(table).columns == ["id", "x"] and spark.table(table).count() == n
    catalog.save_table(spark.table(table).filter("id < 2"), table)               # T23: rebuilt from itself
    assert spark.table(table).count() == 2
    catalog.drop_table(spark, table)
    assert list((tmp_path / "ver2").iterdir()) == []
    catalog.save_table(spark.range(2), table)
    assert spark.table(table).count() == 2


def test_a_failing_version_leaves_the_old_rows_and_no_folder(spark, tmp_path, monkeypatch):
    catalog.ensure_schema(spark, "ver3", str(tmp_path / "ver3"))
    table = "ver3.a"
    for n in (3, 4):
        catalog.save_table(spark.range(n), table)

    def broken(*a):
        raise RuntimeError("injected")
    with monkeypatch.context() as m:
        m.setattr(catalog, "_set_location", broken)
        with pytest.raises(RuntimeError):
            catalog.save_table(spark.range(9), table)
    assert spark.table(table).count() == 4
    spark.range(1).write.parquet(str(tmp_path / "ver3" / "a__versions" / "left_by_a_crash"))
    catalog.save_table(spark.range(5), table)
    assert spark.table(table).count() == 5
    assert len(list((tmp_path / "ver3" / "a__versions").iterdir())) == 2


def test_a_users_table_of_the_backups_name_survives(spark, tmp_path):
    catalog.ensure_schema(spark, "ver4", str(tmp_path / "ver4"))
    spark.range(42).write.saveAsTable("ver4.a__replaced")
    for df in (spark.range(3), spark.range(4), spark.range(5).withColumn("x", F.lit(1)), spark.range(6)):
        catalog.save_table(df, "ver4.a")
        assert catalog.read_table(spark, "ver4.a").count() == df.count()
    assert spark.table("ver4.a__replaced").count() == 42
    assert sorted(t.name for t in spark.catalog.listTables("ver4")) == ["a", "a__replaced"]


def test_transactional_overwrite_replaces_the_schema_in_place(spark, monkeypatch):
    """Delta has no jar here: the writer's options are what its overwrite gets."""
    from pyspark.sql import DataFrameWriter
    seen = {}

    def option(self, k, v):
        seen[k] = v
        return self
    monkeypatch.setattr(DataFrameWriter, "option", option)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda self, name: seen.update(table=name))
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, f: self)
    monkeypatch.setattr(catalog, "Observation", lambda name: type("O", (), {"get": {"rows": 0}})())
    monkeypatch.setattr("pyspark.sql.DataFrame.observe", lambda self, *a: self, raising=False)
    monkeypatch.setattr(type(spark.range(1)), "observe", lambda self, *a: self)
    catalog.save_table(spark.range(1), "s.t", fmt="delta")
    assert seen == {"overwriteSchema": "true", "table": "s.t"}
    seen.clear()
    monkeypatch.setattr(catalog, "check_schema", lambda *a: None)
    catalog.save_table(spark.range(1), "s.t", fmt="delta", replace_schema=False)
    assert seen == {"table": "s.t"}


def test_three_level_names(spark, tmp_path):
    catalog.ensure_schema(spark, "spark_catalog.three", str(tmp_path / "three"))
    t = "spark_catalog.three.a"
    for n in (4, 2):
        assert catalog.save_table(spark.range(n), t)["rows"] == n
        assert catalog.read_table(spark, t).count() == n
    assert [r.tableName for r in catalog.tables(spark, "spark_catalog.three").collect()] == ["a"]
    assert [r.col_name for r in catalog.columns(spark, t).collect()] == ["id"]
    assert [r.status for r in catalog.clear_schema(spark, "spark_catalog.three", dry_run=False).collect()] == ["dropped"]
    catalog.drop_schema(spark, "spark_catalog.three", cascade=True)


def test_stream_counts_every_batch_and_is_rate_limited(spark, tmp_path):
    land = tmp_path / "land"
    for i in range(5):
        _write(land / f"{i}.csv", f"CID,CNTRY\n{i},x\n")
    catalog.ensure_schema(spark, "st_rate", str(tmp_path / "st_rate"))
    opts = dict(checkpoint=str(tmp_path / "ck"), max_files_per_trigger=2)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        assert ingest_available(spark, str(land), "st_rate.loc", "CID STRING, CNTRY STRING", **opts) == 3
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert spark.table("st_rate.loc").count() == 5


def test_a_cluster_must_name_its_shared_folder():
    from tiers import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://h:7077"}.get(key, default)

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"getConf": lambda self: Conf()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session._ensure_checkpoint_dir(Fake())
