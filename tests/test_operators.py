"""Table operators: require_keys, dedupe, lookup, checks."""

import pytest
from pyspark.sql import functions as F

from tiers.operators import checks, clean, model


@pytest.fixture
def sales(spark):
    return spark.createDataFrame([
        ("SO1", "P1", 1, "b", 2.0), ("SO1", "P1", 1, "a", 3.0), ("SO1", "P2", 2, "c", 1.0),
        ("SO2", None, 3, "d", 1.0), (None, "P9", 4, "e", 1.0), ("SO3", "P1", None, "f", 1.0)],
        "ord string, prd string, cust int, note string, amt double")


def test_require_keys_is_pushed_to_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (None, "b"), (2, None)], "a int, b string").write.parquet(path)
    df = clean.require_keys(spark.read.parquet(path), ["a", "b"])
    assert df.count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(a), IsNotNull(b)]" in plan


def test_dedupe_keeps_first_by_other_columns(spark, sales, rows):
    out = clean.dedupe(sales, ["ord", "prd"])
    assert rows(out.filter("ord = 'SO1' AND prd = 'P1'")) == [("SO1", "P1", 1, "a", 3.0)]
    assert out.count() == 5                              # NULL keys form their own groups


@pytest.mark.parametrize("method", ["aggregate", "window", "repeated"])
def test_dedupe_methods_agree(spark, sales, rows, method):
    ref = clean.dedupe(sales, ["ord", "prd"], method="window")
    assert rows(clean.dedupe(sales, ["ord", "prd"], method=method)) == rows(ref)


def test_dedupe_explicit_order(spark, sales, rows):
    out = clean.dedupe(sales, ["ord", "prd"], order_by=[F.col("note").desc()])
    assert rows(out.filter("ord = 'SO1' AND prd = 'P1'")) == [("SO1", "P1", 1, "b", 2.0)]


def test_dedupe_repeatable_across_partitionings(spark, rows):
    """The kept row does not depend on how rows are spread over tasks."""
    df = spark.range(0, 20000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"),
                                      (F.col("id") * 13 % 101).alias("w"))
    a = clean.dedupe(df.repartition(3), ["k"], order_by=["w"])
    b = clean.dedupe(df.repartition(11, "v"), ["k"], order_by=["w"])
    assert rows(a) == rows(b)
    assert all(r.w == 0 for r in a.collect())


def test_dedupe_hot_key_is_combined_before_shuffle(spark):
    """One key with most rows: partial aggregation reduces it map-side."""
    df = spark.range(0, 50000).select(F.when(F.col("id") < 40000, 0).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("v"))
    out = clean.dedupe(df, ["k"])
    assert out.filter("k = 0").first().v == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan


@pytest.mark.parametrize("order", [None, ["w"]])
def test_dedupe_repeated_keeps_the_same_rows(spark, rows, tmp_path, order):
    """Hot, NULL, repeated and single keys; nothing repeated; no rows at all."""
    df = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, 0).when(F.col("id") < 1100, F.lit(None)).when(F.col("id") < 2000, F.col("id") % 700)
        .otherwise(F.col("id")).alias("k"), F.when(F.col("id") % 3 > 0, F.col("id") % 2).alias("l"),
        F.col("id").cast("string").alias("v"), (F.col("id") * 13 % 101).alias("w"))
    for part in (df, df.filter("id >= 2000"), df.filter("id < 0")):
        for keys in (["k"], ["k", "l"]):
            got = clean.dedupe(part, keys, order_by=order, method="repeated")
            assert got.columns == df.columns
            assert rows(got) == rows(clean.dedupe(part, keys, order_by=order, method="window"))


def test_dedupe_repeated_neither_sorts_nor_shuffles_single_keys(spark, tmp_path):
    """Rows of keys that stand once: a scan and a broadcast lookup; only the others are sorted and shuffled."""
    path = str(tmp_path / "t")
    spark.range(0, 20000).select(F.when(F.col("id") < 50, 0).otherwise(F.col("id")).alias("k"),
                                 F.col("id").cast("string").alias("v")).write.parquet(path)
    out = clean.dedupe(spark.read.parquet(path), ["k"], method="repeated")
    assert out.count() == 20000 - 49
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    once = plan[plan.index("LeftAnti"):]
    once = once[:once.index("FileScan")]               # from the anti join down to its scan
    assert "Sort" not in once and "hashpartitioning" not in once
    assert "partial_min" in plan                       # a hot key is cut map-side


def test_dedupe_any_is_dropduplicates(spark, sales):
    assert clean.dedupe(sales, ["ord", "prd"], method="any").count() == 5


def test_fill_default_blank_is_not_null(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "X")], "k string, v string")
    assert rows(clean.fill_default(df, {"v": "UNKNOWN"})) == [("a", "UNKNOWN"), ("b", ""), ("c", "X")]


def test_apply_rules_sees_earlier_rules(spark):
    df = spark.createDataFrame([(" a ",)], "c string")
    out = clean.apply_rules(df, [("c", F.trim("c")), ("d", F.concat("c", F.lit("!")))])
    assert out.first().d == "a!"


# ---- lookup -------------------------------------------------------------

@pytest.fixture
def dims(spark):
    facts = spark.createDataFrame([("o1", "k1"), ("o2", "k2"), ("o3", "k3"), ("o4", None)],
                                  "o string, k string")
    dim = spark.createDataFrame([("k1", "A"), ("k2", "B"), ("k2", "C"), (None, "Z")],
                                "key string, attr string")
    return facts, dim


def test_lookup_allow_fans_out(spark, dims, rows):
    facts, dim = dims
    out = model.lookup(facts, dim, "k", "key", keep=["attr"])
    assert rows(out) == [("o1", "k1", "A"), ("o2", "k2", "B"), ("o2", "k2", "C"),
                         ("o3", "k3", None), ("o4", None, None)]


def test_lookup_without_columns_is_multiplicity_join(spark, dims, rows):
    facts, dim = dims
    plain = facts.join(dim, facts.k == dim.key, "left").select(facts.o, facts.k)
    out = model.lookup(facts, dim, "k", "key")
    assert rows(out) == rows(plain)
    assert out.columns == ["o", "k"]


def test_lookup_dedupe_and_error(spark, dims, rows):
    facts, dim = dims
    out = model.lookup(facts, dim, "k", "key", keep={"attr": "a"}, on_duplicate="dedupe")
    assert rows(out) == [("o1", "k1", "A"), ("o2", "k2", "B"), ("o3", "k3", None), ("o4", None, None)]
    assert model.lookup(facts, dim, "k", "key", on_duplicate="dedupe") is facts
    with pytest.raises(ValueError):
        model.lookup(facts, dim, "k", "key", keep=["attr"], on_duplicate="error")


def test_lookup_refuses_mixed_key_types(spark):
    """String against int keys is refused instead of cast to BIGINT."""
    a = spark.createDataFrame([("1",)], "k string")
    b = spark.createDataFrame([(1, "x")], "k int, v string")
    with pytest.raises(TypeError):
        model.lookup(a, b, "k", "k", keep=["v"])


def test_lookup_widens_integral_keys(spark, rows):
    """CSV inference gives an int in one file and a bigint in another: the join widens."""
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1, "x"), (2 ** 40, "y")], "k bigint, v string")
    assert rows(model.lookup(a, b, "k", "k", keep=["v"])) == [(1, "x"), (2, None)]
    assert rows(model.lookup(b, a, "k", "k")) == [(1, "x"), (2 ** 40, "y")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_multiplicities_beyond_an_int(spark, ansi):
    """50,000 x 50,000 copies of one row: the pieces add up exactly, and none exceeds an array's bound."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        left = spark.createDataFrame([(1, 1), (2, 2)], "a int, b int")
        side = spark.range(50_000).selectExpr("cast(1 as int) as k")
        out, cols = model.multiplicities(left, [(side, ["a"], ["k"]), (side, ["b"], ["k"])], pieces=True)
        n = [F.coalesce(F.col(c), F.lit(1).cast("long")) for c in cols]
        r = out.groupBy("a").agg(F.sum(n[0].cast("decimal(19,0)") * n[1]).alias("n"), F.max(F.greatest(*n)).alias("most")).collect()
        assert {x.a: int(x.n) for x in r} == {1: 2_500_000_000, 2: 1}
        assert max(x.most for x in r) <= model.PIECE
        assert model.repeat_rows(left, [(side, ["a"], ["k"])]).count() == 50_001
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_lookup_refuses_name_clash(spark, dims):
    facts, dim = dims
    with pytest.raises(ValueError):
        model.lookup(facts, dim.withColumnRenamed("attr", "o"), "k", "key", keep=["o"])


def test_bounded_broadcast(spark):
    small = spark.range(10)
    assert "ResolvedHint" in small.hint("broadcast")._jdf.queryExecution().analyzed().toString()
    hinted = model.bounded_broadcast(small, 100)
    assert "broadcast" in hinted._jdf.queryExecution().analyzed().toString().lower()
    big = model.bounded_broadcast(spark.range(1000), 100)
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()


def test_project(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert model.project(df, {"b": "y", "a": "x"}).columns == ["b", "a"]


# ---- checks ---------------------------------------------------------------

def test_count_and_null_counts(spark, sales, rows):
    assert checks.count_all(sales).first().n_rows == 6
    nc = dict(rows(checks.null_counts(sales)))
    assert nc == {"ord": 1, "prd": 1, "cust": 1, "note": 0, "amt": 0}


def test_find_and_sample(spark, sales, rows):
    assert checks.find(sales, ord="SO1", prd="P1").count() == 2
    assert checks.find(sales, prd=None).count() == 1
    assert checks.find(sales, F.col("amt") > 1.5).count() == 2
    assert [r.note for r in checks.sample(sales, 2, ["note"]).collect()] == ["a", "b"]


def test_unique_key_orphans_reconcile(spark, dims, rows):
    facts, dim = dims
    assert rows(checks.unique_key(dim, "key")) == [("k2", 2)]
    assert rows(checks.orphans(facts, dim, "k", "key")) == [("o3", "k3"), ("o4", None)]
    rec = dict(rows(checks.reconcile([("facts", facts), ("joined", model.lookup(facts, dim, "k", "key"))])))
    assert rec == {"facts": 4, "joined": 5}


def test_keep_source_id(spark):
    """The numeric product id survives under prd_num when asked."""
    from tiers.plans import silver
    raw = spark.createDataFrame([(210, "CO-RF-FR-R92B-58", " a", "r", "1.5")],
                                "prd_id int, prd_key string, prd_nm string, prd_line string, prd_cost string")
    out = silver.build(raw, "prd_info", keep_source_id=True, stamp=False).first()
    assert (out.prd_num, out.prd_id, out.cat_id) == (210, "FR-R92B-58", "CO-RF")
    assert "prd_num" not in silver.build(raw, "prd_info", stamp=False).columns


def test_count_where_and_parse_losses(spark, rows):
    df = spark.createDataFrame([("1", None), ("x", "2"), (None, "y")], "a string, b string")
    got = rows(checks.count_where(df, {"all": F.lit(True), "a_set": F.col("a").isNotNull()}))
    assert got == [("a_set", 2), ("all", 3)]
    lost = rows(checks.parse_losses(df, {"a": F.col("a").try_cast("int"), "b": F.col("b").try_cast("int")}))
    assert lost == [("a", 1), ("b", 1)]


def test_window_dedupe_limits_hot_key_before_shuffle(spark):
    df = spark.range(0, 30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                      F.col("id").alias("v"))
    out = clean.dedupe(df, ["k"], order_by=[F.col("v").desc()], method="window")
    assert out.filter("k = 0").first().v == 29997
    plan = out._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_lookup_hot_key_without_broadcast(spark, rows):
    """A third of the fact rows on one key, dimension not broadcast: same rows as the plain join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(0, 9000).select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("o"))
        dim = spark.range(0, 500).select(F.col("id").alias("key"), (F.col("id") * 2).alias("attr"))
        dim = dim.unionByName(spark.range(1, 2).select(F.col("id").alias("key"), F.lit(-1).cast("long").alias("attr")))
        got = model.lookup(facts, dim, "k", "key", keep=["attr"])
        plain = facts.join(dim, facts.k == dim.key, "left").select("k", "o", "attr")
        assert got.count() == plain.count() == 12012          # key 1 holds 3012 rows, two matches each
        assert rows(got) == rows(plain)
        assert rows(model.lookup(facts, dim, "k", "key")) == rows(plain.select("k", "o"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeat_rows_two_sides_is_chained_joins(spark, rows):
    """Two lookups without columns give the rows of the two chained left joins, a hot key
    and keys repeated on both sides included."""
    facts = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("a"),
        (F.col("id") % 40).alias("b"), F.col("id").alias("o"))
    left_dim = spark.range(0, 50).select(F.col("id").alias("ka")).unionByName(
        spark.range(1, 4).select(F.col("id").alias("ka")))             # 1, 2, 3 twice
    right_dim = spark.range(0, 40).select(F.col("id").alias("kb")).unionByName(
        spark.range(2, 3).select(F.col("id").alias("kb"))).unionByName(
        spark.range(2, 3).select(F.col("id").alias("kb")))              # 2 three times
    got = model.repeat_rows(facts, [(left_dim, ["a"], ["ka"]), (right_dim, ["b"], ["kb"])])
    plain = (facts.join(left_dim, facts.a == left_dim.ka, "left")
                  .join(right_dim, facts.b == right_dim.kb, "left").select("a", "b", "o"))
    assert rows(got) == rows(plain)


def test_orphans_hot_right_key_is_combined_before_shuffle(spark, rows):
    """A right key on most rows: distinct keys before the anti join, same orphans."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        right = spark.range(0, 30000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 100).alias("key"))
        left = spark.range(0, 200).select(F.col("id").alias("k"))
        got = checks.orphans(left, right, "k", "key")
        assert rows(got) == rows(left.join(right, left.k == right.key, "left_anti"))
        got.write.format("noop").mode("overwrite").save()
        final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "HashAggregate(keys=[__rk0" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_splits_hot_right_keys_over_salts(spark, rows):
    """Right keys with copies or many rows, dimension not broadcast: salted join, same rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(0, 400).select(
            F.when(F.col("id") == 399, F.lit(None)).otherwise(F.col("id") % 60).alias("k"),
            F.col("id").alias("o"))
        copies = spark.range(0, 2500).select(F.lit(1).cast("long").alias("key"), F.lit(-1).cast("long").alias("attr"))
        many = spark.range(0, 1500).select(F.lit(2).cast("long").alias("key"), F.col("id").alias("attr"))
        plain_dim = spark.range(0, 50).select(F.col("id").alias("key"), (F.col("id") * 2).alias("attr"))
        dim = copies.unionByName(many).unionByName(plain_dim).unionByName(plain_dim.filter("key = 7"))
        got = model.lookup(facts, dim, "k", "key", keep=["attr"], hot_key_rows=400)
        plain = facts.join(dim, facts.k == dim.key, "left").select("k", "o", "attr")
        assert rows(got) == rows(plain)
        got.write.format("noop").mode("overwrite").save()
        final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "__rs" in final                                  # the salted join ran
        untouched = model.lookup(facts, dim, "k", "key", keep=["attr"], hot_key_rows=10**6)
        assert rows(untouched) == rows(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
