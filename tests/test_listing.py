"""Row counts of exports: what is done per line and what per part."""

from tiers.plans import queries


def test_paths_are_cut_per_part_not_per_line(spark, tmp_path, monkeypatch):
    for subset, name, part, text in (("crm", "1_a b.csv", "p 1.csv", "x\n1\n2\n"), ("crm", "1_a b.csv", "p2.csv", "x\n3\n"),
                                     ("crm", "2_c.csv", "p1.csv", "x\n"), ("erp", "1_a b.csv", "p1.csv", "x\n1\n")):
        folder = tmp_path / subset / name
        folder.mkdir(parents=True, exist_ok=True)
        (folder / part).write_text(text)
    (tmp_path / "erp" / "3_none.csv").mkdir()
    monkeypatch.setattr(queries, "cached_landing", lambda *_: str(tmp_path))
    counted = queries.list_files(spark, "unused")
    found = {(r.subset, r.name): r.n_rows for r in counted.collect()}
    assert found == {("crm", "1_a b.csv"): 3, ("crm", "2_c.csv"): 0, ("erp", "1_a b.csv"): 1, ("erp", "3_none.csv"): 0}
    # below the count by file nothing but the scan is left: no decoding, no cutting, no filter
    for name in ("list_files", "table_name", "latest_files"):
        plan = queries.QUERIES[name](spark, "unused")._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.split("\n")
        scan = next(i for i, s in enumerate(lines) if "text" in s and "Relation" in s)
        count = max(i for i, s in enumerate(lines[:scan]) if "Aggregate" in s)
        assert not any("Filter" in s or "decode" in s.lower() or "substring_index" in s for s in lines[count + 1:scan])


def test_exports_are_written_side_by_side_and_parts_of_one_in_order(spark, monkeypatch):
    import threading
    from tiers.plans import landing
    calls, both = [], threading.Barrier(2, timeout=60)

    def write(df, path, mode="overwrite"):
        if path.endswith(("sales_details.csv", f"{landing.STAMP}_cust_info.csv")):
            both.wait()                  # only passes while another export is being written
        calls.append((path.rsplit("/", 1)[-1], mode))

    monkeypatch.setattr(landing, "_write", write)
    landing.write_landing(spark, "/root/testdata/sf0.001")
    assert len(calls) == 15
    mixed = f"{landing.STAMP}_mixed.csv"
    assert [c for c in calls if c[0] == mixed] == [(mixed, "overwrite"), (mixed, "append")]
