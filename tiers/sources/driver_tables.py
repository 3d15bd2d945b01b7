"""Raw CRM / ERP extracts derived from the driver's TPC-H-like tables.

The reference ingests six CSV exports of two source systems. The test
tables hold no such exports, so these functions derive them, row for row,
from the whole driver tables: the work grows with the data, and the raw
defects the cleaning rules exist for (NULL keys, re-sent rows, keys with
and without prefix, money text, '0' dates, blank vs NULL text) arise from
the data itself. Each function has a DuckDB twin in ``duck_oracle.py``.

Source of each extract:

==================  ======================================================
crm_cust_info       customer, plus re-sent rows of customers with a large
                    balance (same key, or a second key for the same id)
crm_prd_info        part, plus large parts re-listed under a dead category
crm_sales_details   lineitem joined to its order (customer, order date)
erp_cust_az12       customer, key with 'NAS' prefix, re-sent with 'XXX'
erp_loc_a101        customer joined to nation, key with and without dash
erp_px_cat_g1v2     distinct (type, brand) of part, SMALL also dash-keyed
==================  ======================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.operators.layout import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Row keys of the fact-sized driver tables: where a caller asks for it, a scan of
# them that yields a few tasks only is spread by this key (``layout.spread``).
ROW_KEYS = {"lineitem": ("l_orderkey", "l_linenumber")}


# (application, path) -> schema. The driver tables are read-only; like a
# catalog, the schema is taken from the files once, which spares every later
# read the footer job of schema inference. Files are still listed per read.
_SCHEMAS: dict[tuple[str, str], object] = {}


def table(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
    else:
        df = spark.read.schema(schema).parquet(path)
    return spread(df, ROW_KEYS[name]) if spread_rows and name in ROW_KEYS else df


def _s(v) -> Column:
    return F.lit(v)


def _aw(custkey: Column, prefix: str = "AW") -> Column:
    # offset keeps keys of any size distinct without truncating padding
    return F.concat(_s(prefix), (custkey + F.lit(10_000_000)).cast("string"))


def _digits(n: Column) -> Column:
    return n.cast("string")


def _decimal_text(units: Column, places: int) -> Column:
    """Integer ``units`` (e.g. cents) as plain decimal text: 1234 -> '12.34'."""
    scale = 10 ** places
    return F.concat(_digits(F.floor(units / scale)), _s("."),
                    F.lpad(_digits(units % scale), places, "0"))


def _ymd_int(c: Column) -> Column:
    """A date or timestamp as the integer yyyyMMdd, by arithmetic (no per-row formatter)."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def _ymd(c: Column) -> Column:
    """Same text as ``date_format(c, 'yyyyMMdd')``: eight digits, year zero-padded."""
    return F.lpad(_ymd_int(c).cast("string"), 8, "0")


def _with_more(df: DataFrame, base: list[Column], more_if: Column, more: list[Column]) -> DataFrame:
    """A ``base`` row per row of ``df``, and a ``more`` row where ``more_if`` holds: one pass."""
    schema = df.select(*base).schema
    first = F.struct(*base)
    second = F.struct(*[c.cast(f.dataType).alias(f.name) for c, f in zip(more, schema.fields)])
    rows = F.when(more_if, F.array(first, second)).otherwise(F.array(first))
    return df.select(F.explode(rows).alias("row")).select("row.*")


def crm_cust_info(customer: DataFrame) -> DataFrame:
    c = customer
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("c_acctbal") + 1000).cast("int"))
    seg = F.col("c_mktsegment")
    base = [
        F.when((seg == "HOUSEHOLD") & (F.col("c_acctbal") < 0), F.lit(None).cast("bigint"))
         .otherwise(F.col("c_custkey")).alias("cst_id"),
        _aw(F.col("c_custkey")).alias("cst_key"),
        F.concat(_s(" "), F.lower(seg), _s(" ")).alias("cst_firstname"),
        F.lower(F.regexp_replace(F.col("c_name"), "#", " ")).alias("cst_lastname"),
        F.when(seg == "BUILDING", _s(" s ")).when(seg == "MACHINERY", _s("M"))
         .when(seg == "AUTOMOBILE", _s("married")).when(seg == "FURNITURE", _s("widowed"))
         .alias("cst_marital_status"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
         .when(F.col("c_nationkey") < 10, _s(" male"))
         .when(F.col("c_nationkey") < 20, _s("Female")).otherwise(_s("  ")).alias("cst_gndr"),
        F.when(seg == "FURNITURE", F.date_format(day, "yyyy-MM-dd"))
         .otherwise(F.date_format(day, "MM/dd/yyyy")).alias("cst_create_date"),
    ]
    resent = [
        F.col("c_custkey").alias("cst_id"),
        F.when(F.col("c_nationkey") < 12, _aw(F.col("c_custkey")))
         .otherwise(_aw(F.col("c_custkey"), "AX")).alias("cst_key"),
        seg.alias("cst_firstname"),
        _s("resent").alias("cst_lastname"),
        _s("S").alias("cst_marital_status"),
        _s("F").alias("cst_gndr"),
        F.date_format(F.date_add(day, 1), "MM/dd/yyyy").alias("cst_create_date")]
    return _with_more(c, base, F.col("c_acctbal") > 9000, resent)


def _brand(part: DataFrame) -> Column:
    return F.lpad(F.substring_index(F.col("p_brand"), "#", -1), 2, "0")


def crm_prd_info(part: DataFrame) -> DataFrame:
    p = part
    cat = F.concat(F.upper(F.substring(F.col("p_type"), 1, 2)), _s("-"), _brand(p))
    pkey = F.concat(_s("P"), _digits(F.col("p_partkey")))
    milli = F.floor(F.col("p_retailprice") * 1000 / 3)
    cost = _decimal_text(milli, 3)
    size = F.col("p_size")
    base = [
        F.when(size == 1, F.lit(None).cast("bigint")).otherwise(F.col("p_partkey")).alias("prd_id"),
        F.concat(cat, _s("-"), pkey).alias("prd_key"),
        F.concat(_s(" "), F.col("p_name")).alias("prd_nm"),
        F.concat(F.lower(F.substring(F.col("p_type"), 1, 1)), _s(" ")).alias("prd_line"),
        F.when(size == 2, _s("n/a")).when(size == 3, F.lit(None).cast("string"))
         .when(size == 4, _s("123456789.00")).otherwise(cost).alias("prd_cost"),
    ]
    relisted = [
        F.col("p_partkey").alias("prd_id"),
        F.concat(_s("XX-99-"), pkey).alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        _s("X").alias("prd_line"),
        cost.alias("prd_cost")]
    return _with_more(p, base, size >= 49, relisted)


#: What a line's number, flags and discount decide, as bits; the two of ``_SALES`` say how its sales are written.
_NO_ORDER_DAY, _OLD_SHIP_DAY, _BAD_DUE_DAY, _SALES, _NO_QUANTITY, _MINUS = 1, 2, 4, 8, 32, 64
_GROUPED, _NO_SALES, _NA_SALES = 1, 2, 3


def _line_marks(ln: Column, rf: Column, ls: Column, discount: Column) -> Column:
    """The bits of a line; a condition that is NULL does not hold, as in ``CASE WHEN``."""
    def mark(condition: Column, bit: int) -> Column:
        return F.when(condition, bit).otherwise(0)

    sales = (F.when(rf == "A", _GROUPED).when(rf == "N", 0).when(ln == 3, _NO_SALES).when(ln == 2, _NA_SALES).otherwise(0))
    return (mark(ln == 6, _NO_ORDER_DAY) + mark((ls == "O") & (ln == 5), _OLD_SHIP_DAY)
            + mark((rf == "R") & (ln == 4), _BAD_DUE_DAY) + sales * _SALES
            + mark((ln == 1) & (rf == "A"), _NO_QUANTITY) + mark(discount == 0, _MINUS)).cast("byte")


def crm_sales_details(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """The join may shuffle both tables: only what the texts are made of goes through it, the texts after it."""
    ln, rf = F.col("l_linenumber"), F.col("l_returnflag")
    lines = lineitem.select(
        "l_orderkey", F.when((ln == 7) & (rf == "N"), F.lit(None)).otherwise(F.col("l_partkey")).alias("part"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("quantity"), F.to_date("l_shipdate").alias("ship"),
        _line_marks(ln, rf, F.col("l_linestatus"), F.col("l_discount")).alias("marks"))
    days = orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("ordered"))
    li = lines.join(days, lines.l_orderkey == days.o_orderkey, "inner")
    price, marks = F.col("price"), F.col("marks").cast("int")

    def marked(bit: int) -> Column:
        return marks.bitwiseAND(bit) != 0

    sales = F.shiftright(marks, 3).bitwiseAND(3)
    cents = F.floor(price * 100 + 0.5)
    grouped = F.concat(_s("$"), F.format_number(F.floor(cents / 100), 0), _s("."),
                       F.lpad(_digits(cents % 100), 2, "0"))
    unit = _decimal_text(F.floor(price * 100 / F.col("quantity") + 0.5), 2)
    return li.select(
        F.concat(_s("SO"), _digits(F.col("l_orderkey"))).alias("sls_ord_num"),
        F.concat(_s("P"), _digits(F.col("part"))).alias("sls_prd_key"),
        F.col("o_custkey").alias("sls_cust_id"),
        F.when(marked(_NO_ORDER_DAY), F.lit(0)).otherwise(_ymd_int(F.col("ordered")))
         .cast("int").alias("sls_order_dt"),
        F.when(marked(_OLD_SHIP_DAY), _s("5489")).otherwise(_ymd(F.col("ship")))
         .alias("sls_ship_dt"),
        F.when(marked(_BAD_DUE_DAY), F.year("ship") * 10000 + 1332)
         .otherwise(_ymd_int(F.date_add(F.col("ship"), 30)))
         .cast("int").alias("sls_due_dt"),
        F.when(sales == _GROUPED, grouped).when(sales == _NO_SALES, F.lit(None).cast("string"))
         .when(sales == _NA_SALES, _s("n/a")).otherwise(_decimal_text(cents, 2)).alias("sls_sales"),
        F.when(marked(_NO_QUANTITY), _s("x"))
         .otherwise(F.col("quantity").cast("int").cast("string")).alias("sls_quantity"),
        F.when(marked(_MINUS), F.concat(_s("-"), unit)).otherwise(unit).alias("sls_price"),
    )


def erp_cust_az12(customer: DataFrame) -> DataFrame:
    c = customer
    key = _aw(F.col("c_custkey"))
    born = F.date_add(F.lit("1940-01-01").cast("date"),
                      F.floor((F.col("c_acctbal") + 1000) * 2).cast("int"))
    seg = F.col("c_mktsegment")
    base = [
        F.when(F.col("c_nationkey") == 3, key).otherwise(F.concat(_s("NAS"), key)).alias("CID"),
        F.when((seg == "MACHINERY") & (F.col("c_acctbal") < 0), _s("0"))
         .otherwise(F.date_format(born, "yyyy-MM-dd")).alias("BDATE"),
        F.when(seg == "BUILDING", _s("Male")).when(seg == "MACHINERY", _s("F"))
         .when(seg == "AUTOMOBILE", _s(" female")).when(seg == "FURNITURE", _s(""))
         .alias("GEN"),
    ]
    resent = [
        F.concat(_s("XXX"), key).alias("CID"), _s("1980-01-01").alias("BDATE"), _s("M").alias("GEN")]
    return _with_more(c, base, F.col("c_acctbal") > 9500, resent)


def erp_loc_a101(customer: DataFrame, nation: DataFrame) -> DataFrame:
    cn = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "inner")
    base = [
        _aw(F.col("c_custkey"), "AW-").alias("CID"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
         .when(F.col("c_mktsegment") == "FURNITURE", _s("  "))
         .otherwise(F.concat(_s(" "), F.lower(F.col("n_name")))).alias("CNTRY"),
    ]
    resent = [
        _aw(F.col("c_custkey")).alias("CID"), F.col("n_name").alias("CNTRY")]
    return _with_more(cn, base, F.col("c_acctbal") > 9500, resent)


def erp_px_cat_g1v2(part: DataFrame) -> DataFrame:
    cats = part.select(F.col("p_type"), _brand(part).alias("brand")).distinct()
    t, b = F.col("p_type"), F.col("brand")
    bn = b.cast("int")
    prefix = F.when(t == "PROMO", _s("PM")).otherwise(F.upper(F.substring(t, 1, 2)))
    base = [
        F.concat(prefix, _s("_"), b).alias("ID"),
        F.concat(_s(" "), F.lower(t)).alias("CAT"),
        F.concat(_s("brand "), b, _s(" ")).alias("SUBCAT"),
        F.when(bn <= 3, _s("yes")).when(bn <= 6, _s(" 0")).when(bn <= 9, _s("req"))
         .when(bn <= 12, _s("n")).when(bn <= 15, _s("None"))
         .when(bn <= 18, F.lit(None).cast("string")).when(bn <= 21, _s("sometimes"))
         .otherwise(_s("False")).alias("MAINTENANCE"),
    ]
    dashed = [
        F.concat(_s("SM-"), b).alias("ID"), _s("small parts").alias("CAT"),
        b.alias("SUBCAT"), _s("Y").alias("MAINTENANCE")]
    return _with_more(cats, base, t == "SMALL", dashed)


RAW = {
    "crm_cust_info": (crm_cust_info, ("customer",)),
    "crm_prd_info": (crm_prd_info, ("part",)),
    "crm_sales_details": (crm_sales_details, ("lineitem", "orders")),
    "erp_cust_az12": (erp_cust_az12, ("customer",)),
    "erp_loc_a101": (erp_loc_a101, ("customer", "nation")),
    "erp_px_cat_g1v2": (erp_px_cat_g1v2, ("part",)),
}


def raw(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """One raw extract, derived from the driver tables in ``sf_dir``."""
    fn, inputs = RAW[name]
    return fn(*[table(spark, sf_dir, t, spread_rows) for t in inputs])


def raw_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw(spark, sf_dir, name) for name in RAW}
