"""Column rules C1-C23, P4-P7 on small rows, with the traps T3-T8, T14-T16."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tiers.functions import audit, parse, text
from tiers.plans.specs import MAINTENANCE_NO, MAINTENANCE_YES, MARITAL_PREFIXES


def one(spark, value, expr, dtype="string"):
    df = spark.createDataFrame([(value,)], f"c {dtype}")
    return df.select(expr.alias("out")).first()[0]


def test_trim_keeps_tabs(spark):
    assert one(spark, "  a b  ", text.trimmed("c")) == "a b"
    assert one(spark, "\ta ", text.trimmed("c")) == "\ta"          # only spaces are trimmed


@pytest.mark.parametrize("raw,want", [
    (" jon ", "Jon"), ("mary ann", "Mary Ann"), ("o'neil", "O'neil"),
    ("road-450 red", "Road-450 Red"), ("hELLO  wORLD", "Hello  World"), (None, None)])
def test_title(spark, raw, want):
    assert one(spark, raw, text.title("c")) == want


def test_code_and_folded(spark):
    assert one(spark, " australia ", text.code("c")) == "AUSTRALIA"
    assert one(spark, " Married ", text.folded("c")) == "married"


@pytest.mark.parametrize("raw,plain,with_default", [
    ("male", "M", "M"), (" female", "F", "F"), (" ", "", ""),   # T7: blank is not NULL
    (None, None, "Unknown")])
def test_initial(spark, raw, plain, with_default):
    assert one(spark, raw, text.initial("c")) == plain
    assert one(spark, raw, text.initial("c", default="Unknown")) == with_default


@pytest.mark.parametrize("raw,want", [
    ("M", "Married"), (" s ", "Single"), ("married", "Married"), ("widowed", "Unknown"),
    (None, "Unknown"), ("", "Unknown")])
def test_by_prefix(spark, raw, want):
    assert one(spark, raw, text.by_prefix("c", MARITAL_PREFIXES, "Unknown")) == want


@pytest.mark.parametrize("raw,want", [
    ("yes", "YES"), ("0", "NO"), ("req", "YES"), ("None", "NO"), ("sometimes", "SOMETIMES"),
    (None, None)])
def test_by_value(spark, raw, want):
    m = text.by_value(text.code("c"), {"YES": MAINTENANCE_YES, "NO": MAINTENANCE_NO})
    assert one(spark, raw, m) == want


def test_key_split(spark):
    assert one(spark, "CO-RF-FR-R92B-58", text.key_prefix("c", 5)) == "CO-RF"
    assert one(spark, "CO-RF-FR-R92B-58", text.key_suffix("c", 7)) == "FR-R92B-58"
    assert one(spark, "CO-RF-", text.key_suffix("c", 7)) == ""


def test_strip_prefix_trap_t6(spark):
    assert one(spark, "NASAW00011000", text.strip_prefix("c", 3)) == "AW00011000"
    # faithful rule cuts keys that never had the prefix
    assert one(spark, "AW00011213", text.strip_prefix("c", 3)) == "0011213"
    assert one(spark, "AW00011213", text.strip_prefix("c", 3, only_if="NAS")) == "AW00011213"


def test_remove_replace(spark):
    assert one(spark, "AW-000-11", text.remove("c", "-")) == "AW00011"
    assert one(spark, "CO_RF_X", text.replace("c", "_", "-")) == "CO-RF-X"


@pytest.mark.parametrize("raw,want", [
    ("$1,234.50", Decimal("1234.50")), ("999", Decimal("999.00")), ("-35", Decimal("-35.00")),
    ("1.005", Decimal("1.01")), ("-2.345", Decimal("-2.35")),           # HALF_UP
    ("n/a", None), ("", None), (None, None), ("123456789.00", None)])   # T5: overflow -> NULL
def test_money(spark, raw, want):
    assert one(spark, raw, parse.money("c")) == want


def test_money_from_double(spark):
    assert one(spark, 1234.5, parse.money("c"), "double") == Decimal("1234.50")


def test_decimal_and_int(spark):
    assert one(spark, "12.345", parse.to_decimal("c", 10, 2)) == Decimal("12.35")
    assert one(spark, "abc", parse.to_decimal("c", 10, 2)) is None
    assert one(spark, "7", parse.to_int("c")) == 7
    assert one(spark, "x", parse.to_int("c")) is None


def test_strict_cast_fails_under_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(Exception):
        one(spark, "x", parse.to_int("c", strict=True))


@pytest.mark.parametrize("raw,fmt,want", [
    ("20101229", "yyyyMMdd", dt.date(2010, 12, 29)), ("0", "yyyyMMdd", None),
    ("5489", "yyyyMMdd", None), ("20101332", "yyyyMMdd", None),          # T3: NULL, not a failure
    ("10/06/2025", "MM/dd/yyyy", dt.date(2025, 10, 6)), ("2025-10-08", "MM/dd/yyyy", None),  # T4
    ("1971-10-06", "yyyy-MM-dd", dt.date(1971, 10, 6))])
def test_to_date(spark, raw, fmt, want):
    assert one(spark, raw, parse.to_date("c", fmt)) == want


def test_to_date_from_int(spark):
    assert one(spark, 20101229, parse.to_date("c", "yyyyMMdd"), "int") == dt.date(2010, 12, 29)


def test_strict_date_fails_under_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "true")
    with pytest.raises(Exception):
        one(spark, "0", parse.to_date("c", "yyyyMMdd", strict=True))


def test_display_path_decodes(spark):
    assert one(spark, "file:/x/a%20b/c.csv", audit.display_path("c")) == "file:/x/a b/c.csv"
    assert one(spark, "file:/x/a%20b/c%20d.csv", audit.base_name("c")) == "c d.csv"


def test_stamp_is_one_value_per_query(spark):
    df = spark.range(1000).select(audit.stamp().alias("t"))
    assert df.distinct().count() == 1
    assert df.schema["t"].dataType.simpleString() == "timestamp"


def test_rules_stay_in_codegen(spark):
    """All rules are built-in expressions: no Python UDF in the plan."""
    df = spark.createDataFrame([("x",)], "c string").select(
        text.title("c"), parse.money("c"), parse.to_date("c", "yyyyMMdd"), text.initial("c", "U"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
