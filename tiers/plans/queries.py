"""The registered queries: one per operator group of SURVEY section 2.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables (or CSV exports Spark wrote from them). Audit timestamps are
left out, since they differ per run. Queries of the file and catalog
operators write their inputs first (landing CSVs, tables) under the shared
checkpoint folder; that work is cached per session and data folder.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.functions import audit, parse, text
from tiers.operators import checks, clean, model
from tiers.plans import bronze, gold, landing, layers, runner
from tiers.plans.specs import GOLD_SPECS, MAINTENANCE_NO, MAINTENANCE_YES, MARITAL_PREFIXES, SILVER
from tiers.session import shared_dir
from tiers.sources import catalog, driver_tables, files
from tiers.streaming import ingest as stream_ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _raw(spark, sf_dir, name) -> DataFrame:
    return driver_tables.raw(spark, sf_dir, name)


# ---- gold (D7-D9, J1-J5, P2) -------------------------------------------

@register("fact_sales")
def fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.gold_table(spark, sf_dir, "fact_sales")


@register("dim_customer")
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.gold_table(spark, sf_dir, "dim_customer")


@register("dim_product")
def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.gold_table(spark, sf_dir, "dim_product")


@register("dim_customer_unique")
def dim_customer_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_customer with one ERP row per key (lookup ``on_duplicate='dedupe'``, T10)."""
    return layers.gold_table(spark, sf_dir, "dim_customer", on_duplicate="dedupe")


@register("dim_product_code")
def dim_product_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dim_product plus the short product key the fact carries."""
    return layers.gold_table(spark, sf_dir, "dim_product", with_product_code=True)


# ---- silver (D1-D6) -----------------------------------------------------

def _silver(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return layers.silver_table(spark, sf_dir, name)
    run.__name__ = f"silver_{name}"
    return run


for _name in ("crm_cust_info", "prd_info", "sales_details", "erp_cust_az12", "loc_a101",
              "erp_px_cat_g1v2"):
    register(f"silver_{_name}")(_silver(_name))


@register("silver_loc_a101_unique")
def silver_loc_a101_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """loc_a101 with the dedup after the key rewrite: the final key is unique (T2 fix)."""
    return layers.silver_table(spark, sf_dir, "loc_a101", dedupe_after_rules=True)


# ---- column rules (C1-C23, P6-P7, F6-F8) --------------------------------

@register("title_code")
def title_code(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_cust_info")
    return r.select("cst_key", text.title("cst_firstname").alias("first_name"),
                    text.title("cst_lastname").alias("last_name"),
                    text.trimmed("cst_firstname").alias("first_trimmed"),
                    text.code("cst_marital_status").alias("marital_code"),
                    text.folded("cst_gndr").alias("gender_folded"))


@register("initial")
def initial(spark, sf_dir):
    r = _raw(spark, sf_dir, "erp_cust_az12")
    return r.select("CID", "GEN", text.initial("GEN").alias("gen_letter"),
                    text.initial("GEN", default="Unknown").alias("gen_or_unknown"))


@register("by_prefix")
def by_prefix(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_cust_info")
    return r.select("cst_key", "cst_marital_status",
                    text.by_prefix("cst_marital_status", MARITAL_PREFIXES, "Unknown").alias("marital_status"))


@register("by_value")
def by_value(spark, sf_dir):
    r = _raw(spark, sf_dir, "erp_px_cat_g1v2")
    return r.select("ID", "MAINTENANCE", text.by_value(
        text.code("MAINTENANCE"), {"YES": MAINTENANCE_YES, "NO": MAINTENANCE_NO}).alias("maintenance_flag"))


@register("default_fill")
def default_fill(spark, sf_dir):
    r = _raw(spark, sf_dir, "erp_loc_a101").withColumn("CNTRY", text.code("CNTRY"))
    return clean.fill_default(r, {"CNTRY": "UNKNOWN"})


@register("key_split")
def key_split(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_prd_info")
    return r.select("prd_key", text.key_prefix("prd_key", 5).alias("cat_id"),
                    text.key_suffix("prd_key", 7).alias("product_code"))


@register("strip_prefix")
def strip_prefix(spark, sf_dir):
    r = _raw(spark, sf_dir, "erp_cust_az12")
    return r.select("CID", text.strip_prefix("CID", 3).alias("cid_cut"),
                    text.strip_prefix("CID", 3, only_if="NAS").alias("cid_checked"))


@register("key_remove")
def key_remove(spark, sf_dir):
    r = _raw(spark, sf_dir, "erp_loc_a101")
    return r.select("CID", text.remove("CID", "-").alias("cid_clean"))


@register("key_replace")
def key_replace(spark, sf_dir):
    r = _raw(spark, sf_dir, "erp_px_cat_g1v2")
    return r.select("ID", text.replace("ID", "_", "-").alias("id_clean"))


@register("money")
def money(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_sales_details")
    return r.select("sls_ord_num", "sls_prd_key", "sls_sales", "sls_price",
                    parse.money("sls_sales").alias("sales_amount"),
                    parse.money("sls_price").alias("price"))


@register("decimal_cast")
def decimal_cast(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_prd_info")
    return r.select("prd_key", "prd_cost", parse.to_decimal("prd_cost", 10, 2).alias("cost"))


@register("int_cast")
def int_cast(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_sales_details")
    return r.select("sls_ord_num", "sls_prd_key", "sls_quantity",
                    parse.to_int("sls_quantity").alias("quantity"))


@register("date_compact")
def date_compact(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_sales_details")
    return r.select("sls_ord_num", "sls_prd_key",
                    parse.to_date("sls_order_dt", "yyyyMMdd").alias("order_date"),
                    parse.to_date("sls_ship_dt", "yyyyMMdd").alias("ship_date"),
                    parse.to_date("sls_due_dt", "yyyyMMdd").alias("due_date"))


@register("date_us")
def date_us(spark, sf_dir):
    r = _raw(spark, sf_dir, "crm_cust_info")
    return r.select("cst_key", "cst_create_date",
                    parse.to_date("cst_create_date", "MM/dd/yyyy").alias("create_date"))


@register("date_iso")
def date_iso(spark, sf_dir):
    r = _raw(spark, sf_dir, "erp_cust_az12")
    return r.select("CID", "BDATE", parse.to_date("BDATE", "yyyy-MM-dd").alias("birth_date"))


# ---- keys and dedup (F1, A4, A5, T1) -----------------------------------

@register("require_keys")
def require_keys(spark, sf_dir):
    return clean.require_keys(_raw(spark, sf_dir, "crm_sales_details"),
                              ["sls_ord_num", "sls_prd_key", "sls_cust_id"])


@register("dedupe_single")
def dedupe_single(spark, sf_dir):
    return clean.dedupe(_raw(spark, sf_dir, "crm_cust_info"), ["cst_key"])


@register("dedupe_pair")
def dedupe_pair(spark, sf_dir):
    return clean.dedupe(_raw(spark, sf_dir, "crm_sales_details"), ["sls_ord_num", "sls_prd_key"])


@register("dedupe_repeated")
def dedupe_repeated(spark, sf_dir):
    """The rows of ``dedupe_pair`` in two phases: only rows whose key repeats are aggregated."""
    return clean.dedupe(_raw(spark, sf_dir, "crm_sales_details"), ["sls_ord_num", "sls_prd_key"], method="repeated")


@register("dedupe_latest")
def dedupe_latest(spark, sf_dir):
    """One row per key by an explicit order (window form): latest ship date first."""
    return clean.dedupe(_raw(spark, sf_dir, "crm_sales_details"), ["sls_ord_num", "sls_prd_key"],
                        order_by=[F.col("sls_ship_dt").desc_nulls_last()], method="window")


# ---- joins (J1-J5) -------------------------------------------------------

@register("lookup_orders")
def lookup_orders(spark, sf_dir):
    """Sales lines with their customer's name: a checked left lookup carrying one column."""
    sales = layers.silver_table(spark, sf_dir, "sales_details")
    cust = layers.silver_table(spark, sf_dir, "crm_cust_info")
    out = model.lookup(sales, cust, "sls_cust_id", "cst_id", keep={"cst_lastname": "customer_name"})
    return out.select("sls_ord_num", "sls_prd_key", "sls_cust_id", "customer_name")


# ---- checks (A1-A3, F2-F5, L1, K8, T2, T10, T12) -----------------------

@register("count_all")
def count_all(spark, sf_dir):
    return checks.count_all(fact_sales(spark, sf_dir))


@register("null_counts")
def null_counts(spark, sf_dir):
    return checks.null_counts(layers.silver_table(spark, sf_dir, "sales_details"))


@register("find_eq")
def find_eq(spark, sf_dir):
    return checks.find(layers.silver_table(spark, sf_dir, "crm_cust_info"),
                       cst_marital_status="Married")


@register("find_num")
def find_num(spark, sf_dir):
    """Numeric equality (F3): sales lines of quantity one."""
    return checks.find(layers.silver_table(spark, sf_dir, "sales_details"), sls_quantity=1)


@register("find_gt")
def find_gt(spark, sf_dir):
    return checks.find(fact_sales(spark, sf_dir), F.col("quantity") > 1)


@register("find_null")
def find_null(spark, sf_dir):
    return checks.find(layers.silver_table(spark, sf_dir, "sales_details"), sls_sales=None)


@register("null_gender_count")
def null_gender_count(spark, sf_dir):
    """``SELECT count(*) ... WHERE cst_gndr IS NULL`` on the raw table (A3)."""
    return checks.count_all(checks.find(_raw(spark, sf_dir, "crm_cust_info"), cst_gndr=None))


@register("sample")
def sample(spark, sf_dir):
    return checks.sample(fact_sales(spark, sf_dir), 10, ["order_number", "product_key"])


@register("orphans")
def orphans(spark, sf_dir):
    sales = layers.silver_table(spark, sf_dir, "sales_details")
    prd = layers.silver_table(spark, sf_dir, "prd_info")
    return checks.orphans(sales, prd, "sls_prd_key", "prd_id").select(
        "sls_ord_num", "sls_prd_key", "sls_cust_id")


@register("orphan_categories")
def orphan_categories(spark, sf_dir):
    prd = layers.silver_table(spark, sf_dir, "prd_info")
    cat = layers.silver_table(spark, sf_dir, "erp_px_cat_g1v2")
    return checks.orphans(prd, cat, "cat_id", "ID").select("prd_key", "cat_id")


@register("unique_key")
def unique_key(spark, sf_dir):
    return checks.unique_key(layers.silver_table(spark, sf_dir, "loc_a101"), "CID")


def _fanout_sides(spark, sf_dir):
    """The lookups of ``fact_sales``, which only repeat its rows."""
    spec = GOLD_SPECS["fact_sales"]
    tables = layers.silver_tables(spark, sf_dir, [lk.table for lk in spec.lookups])
    return [(tables[lk.table], lk.left_on, lk.right_on) for lk in spec.lookups]


def _times(columns):
    """Product of counts, exact beyond a long."""
    return reduce(lambda a, b: a * b, [F.coalesce(F.col(c), F.lit(1).cast("long")).cast("decimal(19,0)") for c in columns])


@register("reconcile")
def reconcile(spark, sf_dir):
    """Rows read, with all keys, in silver and in gold, from one pass over the sales.

    Grouped once by the silver key: its groups with a keyed row are silver's rows,
    and the gold rows are the sum of what the lookups repeat them.
    """
    spec = SILVER["sales_details"]
    raw = driver_tables.raw(spark, sf_dir, spec.source, spread_rows=True)
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in spec.required])
    rest = [c for c in raw.columns if c not in spec.dedupe_on]      # the order in which dedupe keeps a row
    groups = raw.groupBy(*spec.dedupe_on).agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(keyed).alias("keyed"),
        F.min(F.when(keyed, F.struct(*rest))).alias("kept"))
    groups = groups.select("raw", "keyed", *spec.dedupe_on, "kept.*")
    out, copies = model.multiplicities(groups.select("raw", "keyed", "sls_prd_key", "sls_cust_id"), _fanout_sides(spark, sf_dir))
    silver = F.col("keyed") > 0
    wide = out.agg(F.sum("raw").alias("raw"), F.sum("keyed").alias("keyed"), F.count_if(silver).alias("silver"),
                   F.sum(F.when(silver, _times(copies))).cast("long").alias("gold"))
    names = ["raw", "keyed", "silver", "gold"]
    return wide.select(*[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names]).unpivot([], names, "stage", "n_rows")


@register("fact_fanout")
def fact_fanout(spark, sf_dir):
    """Fact keys that the lookups repeat, counted from the multiplicities: no row is repeated to be counted."""
    sales = layers.silver_table(spark, sf_dir, "sales_details")
    out, copies = model.multiplicities(sales.select("sls_ord_num", "sls_prd_key", "sls_cust_id"), _fanout_sides(spark, sf_dir))
    repeated = out.filter(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in copies]))
    # the key is silver's: one row each
    return repeated.select(F.col("sls_ord_num").alias("order_number"), F.col("sls_prd_key").alias("product_key"),
                           _times(copies).cast("long").alias("copies"))


@register("lost_values")
def lost_values(spark, sf_dir):
    """Values the sales rules could not parse, per column, in one pass over the deduplicated rows."""
    spec = SILVER["sales_details"]
    before = clean.dedupe(clean.require_keys(_raw(spark, sf_dir, spec.source), spec.required),
                          spec.dedupe_on)
    parsed = {name: rule(False) for name, rule in spec.rules if name in before.columns}
    return checks.parse_losses(before, parsed)


# ---- files, ingest, catalog (S1-S9, K1-K11, P3, P4, F9) ----------------

_CACHE: dict[tuple, object] = {}
_LOCK = threading.RLock()


def _key(spark, sf_dir, what):
    return (spark.sparkContext.applicationId, sf_dir, what)


def cached_landing(spark: SparkSession, sf_dir: str) -> str:
    k = _key(spark, sf_dir, "landing")
    with _LOCK:
        if k not in _CACHE:
            _CACHE[k] = landing.write_landing(spark, sf_dir)
        return _CACHE[k]


_LEFT: dict[str, str] = {}


def _schema_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _own_schema(spark: SparkSession, prefix: str) -> str:
    """A new schema for one call of a query; the one that its last call left goes."""
    schema = _schema_name(prefix)
    with _LOCK:
        old = _LEFT.get(prefix)
        _LEFT[prefix] = schema
    if old and spark.catalog.databaseExists(old):
        catalog.drop_schema(spark, old, cascade=True)
    return catalog.ensure_schema(spark, schema, shared_dir(spark, "warehouse", schema))


def cached_layers(spark: SparkSession, sf_dir: str) -> tuple[str, str, str]:
    """Run CSV -> bronze -> silver -> gold once; return the three schema names."""
    k = _key(spark, sf_dir, "layers")
    with _LOCK:
        return _layers_locked(spark, sf_dir, k)


def _layers_locked(spark, sf_dir, k):
    if k not in _CACHE:
        names = tuple(_schema_name(p) for p in ("bronze", "silver", "gold"))
        report = runner.run_all(spark, cached_landing(spark, sf_dir), ("crm", "erp"),
                                  schemas=names, location=shared_dir(spark, "warehouse"),
                                  bronze_opts={"schemas": landing.SCHEMAS})
        failed = report.filter("status = 'failed' AND layer <> 'bronze'").collect()
        if failed:
            raise RuntimeError(f"layered run failed: {failed}")
        _CACHE[k] = names
    return _CACHE[k]


def _export(spark, sf_dir, subset, stem) -> str:
    return f"{cached_landing(spark, sf_dir)}/{subset}/{landing.STAMP}_{stem}.csv"


def _folder(c):
    return F.regexp_extract(c, r"([^/]+)/[^/]+$", 1)


@register("ingest_csv")
def ingest_csv(spark, sf_dir):
    df = files.add_audit(files.read_csv(spark, _export(spark, sf_dir, "crm", "cust_info")))
    return df.withColumn("_source_file", audit.display_path(_folder("_source_file"))).drop(
        "_ingest_timestamp")


@register("ingest_csv_strings")
def ingest_csv_strings(spark, sf_dir):
    return files.read_csv(spark, _export(spark, sf_dir, "crm", "sales_details"), infer=False)


@register("ingest_csv_schema")
def ingest_csv_schema(spark, sf_dir):
    schema = ("CID STRING, BDATE STRING, GEN STRING")
    return files.read_csv(spark, _export(spark, sf_dir, "erp", "cust_az12"), schema=schema)


@register("peek_text")
def peek_text(spark, sf_dir):
    """Raw text lines of a whole export (headers of its parts left out); S4 with ``n=None``."""
    glob = f"{cached_landing(spark, sf_dir)}/erp/{landing.STAMP}_px_cat_g1v2.csv/*.csv"
    lines = files.peek_text(spark, glob, n=None)
    return lines.filter(F.col("value") != "ID,CAT,SUBCAT,MAINTENANCE")


def _listing(spark, sf_dir):
    base = cached_landing(spark, sf_dir)
    return (files.list_files(spark, f"{base}/crm", subset="crm")
            .unionByName(files.list_files(spark, f"{base}/erp", subset="erp")))


def _nth_last(path, n):
    """The ``n``-th element of a path from its end."""
    return F.substring_index(F.substring_index(path, "/", -n), "/", 1)


def _counted(spark, sf_dir, listing):
    """A listing with the data rows that every export holds (its lines, less one header per part).

    Lines are counted by the path as the scan gives it; it is decoded and cut once per part.
    The cuts are never NULL: else the join's IS NOT NULL on them is pushed down to every line.
    """
    lines = files.peek_text(spark, f"{cached_landing(spark, sf_dir)}/*/*.csv/*.csv", n=None)
    parts = (lines.groupBy(F.col("_metadata.file_path").alias("uri")).agg((F.count(F.lit(1)) - 1).alias("n"))
             .select(F.coalesce(F.url_decode("uri"), F.lit("")).alias("path"), "n"))
    rows = parts.groupBy(_nth_last("path", 3).alias("subset"), _nth_last("path", 2).alias("name")).agg(F.sum("n").alias("n_rows"))
    return listing.join(rows, ["subset", "name"], "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("long")))


@register("list_files")
def list_files(spark, sf_dir):
    """Every export of the landing folder, with its rows."""
    return _counted(spark, sf_dir, _listing(spark, sf_dir)).select("subset", "name", "is_dir", "n_rows")


@register("table_name")
def table_name(spark, sf_dir):
    """Rows per table name, by either naming rule."""
    named = _counted(spark, sf_dir, _listing(spark, sf_dir)).select(
        files.table_name("subset", "name").alias("table_name"),
        files.table_name("subset", "name", strip_timestamp=False).alias("table_name_stamped"), "n_rows")
    return named.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"), F.min("table_name_stamped").alias("first_stamped"),
                                           F.count(F.lit(1)).alias("n_files"))


@register("latest_files")
def latest_files(spark, sf_dir):
    """The newest export of every table, with its rows."""
    listing = _listing(spark, sf_dir).withColumn("table_name", files.table_name("subset", "name"))
    return _counted(spark, sf_dir, files.latest_files(listing)).select("subset", "name", "table_name", "n_rows")


def _ingested(spark, sf_dir, prefix):
    schema = _own_schema(spark, prefix)
    report = bronze.ingest(spark, cached_landing(spark, sf_dir), ("crm", "erp", "hr"), schema=schema,
                           schemas=landing.SCHEMAS)
    return schema, report


@register("ingest_report")
def ingest_report(spark, sf_dir):
    return _ingested(spark, sf_dir, "bronze_report")[1].drop("error")


@register("ingest_again")
def ingest_again(spark, sf_dir):
    """Report of a second ingest with a state table, over a landing folder that one new export joined.

    Only that export is read; the tables that stand keep their rows.
    """
    schema = _own_schema(spark, "bronze_again")
    base = landing.write_landing(spark, sf_dir)
    opts = dict(schema=schema, schemas=landing.SCHEMAS, state=f"{schema}.loads")
    bronze.ingest(spark, base, ("crm", "erp"), **opts)
    landing.write_newer(spark, sf_dir, base)
    return bronze.ingest(spark, base, ("crm", "erp"), **opts).drop("error")


@register("run_again")
def run_again(spark, sf_dir):
    """Second run of all layers with a state table after one table's new export.

    Silver and gold tables that do not depend on it are left as they are.
    """
    names = tuple(_own_schema(spark, f"again_{n}") for n in ("b", "s", "g"))
    base = landing.write_landing(spark, sf_dir, extras=False)
    opts = dict(schemas=names, state=f"{names[0]}.builds")
    runner.run_all(spark, base, ("crm", "erp"), **opts)
    landing.write_newer(spark, sf_dir, base)
    report = runner.run_all(spark, base, ("crm", "erp"), **opts)
    return report.filter("layer <> 'bronze'").select(
        "layer", F.substring_index("table_name", ".", -1).alias("table_name"), "status")


def _saved_raw(spark, sf_dir, prefix) -> str:
    """The raw extracts as bronze tables of a schema of their own."""
    schema = _own_schema(spark, prefix)
    for name in dict.fromkeys(spec.source for spec in SILVER.values()):
        catalog.save_table(_raw(spark, sf_dir, name), f"{schema}.{name}")
    return schema


@register("bucketed_fact_sales")
def bucketed_fact_sales(spark, sf_dir):
    """``fact_sales`` over silver tables stored in buckets of their join key."""
    s = _own_schema(spark, "bucketed_s")
    runner.run_silver(spark, _saved_raw(spark, sf_dir, "bucketed_b"), s, buckets=8)
    spec = GOLD_SPECS["fact_sales"]
    return gold.build(spec, {t: catalog.read_table(spark, f"{s}.{t}") for t in [spec.base] + [lk.table for lk in spec.lookups]},
                      stamp=False)


@register("silver_counts")
def silver_counts(spark, sf_dir):
    """What became of every silver table's input, observed on the writes of a run."""
    s = _own_schema(spark, "counted_s")
    report = runner.run_silver(spark, _saved_raw(spark, sf_dir, "counted_b"), s, counts=True)
    return report.select(F.substring_index("table_name", ".", -1).alias("table_name"), "status",
                         F.explode("counts").alias("measure", "n"))


@register("ingested_rows")
def ingested_rows(spark, sf_dir):
    """What the tables of a bronze run hold: the newest usable export of each."""
    schema = _ingested(spark, sf_dir, "bronze_rows")[0]
    counts = [catalog.read_table(spark, f"{schema}.{t.name}").agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(t.name).alias("table_name"), "n_rows")
              for t in spark.catalog.listTables(schema) if not t.isTemporary]
    return reduce(DataFrame.unionByName, counts)


@register("stamps")
def stamps(spark, sf_dir):
    """Of every stored silver and gold table: rows, stamped rows and different stamps."""
    _, silver_schema, gold_schema = cached_layers(spark, sf_dir)
    parts = []
    for schema, names, column in ((silver_schema, list(SILVER), "_cleaned_timestamp"), (gold_schema, list(GOLD_SPECS), "_gold_timestamp")):
        for name in names:
            parts.append(catalog.read_table(spark, f"{schema}.{name}").agg(
                F.count(F.lit(1)).alias("n_rows"), F.count(column).alias("n_stamped"),
                F.countDistinct(column).alias("n_values")).select(F.lit(name).alias("table_name"), "n_rows", "n_stamped", "n_values"))
    return reduce(DataFrame.unionByName, parts)


def _gold_schema(spark, sf_dir) -> str:
    return cached_layers(spark, sf_dir)[2]


@register("stored_fact_sales")
def stored_fact_sales(spark, sf_dir):
    return catalog.read_table(spark, f"{_gold_schema(spark, sf_dir)}.fact_sales").drop("_gold_timestamp")


@register("stored_dim_customer")
def stored_dim_customer(spark, sf_dir):
    return catalog.read_table(spark, f"{_gold_schema(spark, sf_dir)}.dim_customer").drop("_gold_timestamp")


@register("stored_dim_product")
def stored_dim_product(spark, sf_dir):
    return catalog.read_table(spark, f"{_gold_schema(spark, sf_dir)}.dim_product").drop("_gold_timestamp")


@register("query_table")
def query_table(spark, sf_dir):
    """``SELECT * FROM <gold.dim_product> WHERE category_name = :c``, name and value bound."""
    t = f"{_gold_schema(spark, sf_dir)}.dim_product"
    return catalog.query_table(spark, t, "category_name = :c", c="ECONOMY").drop("_gold_timestamp")


@register("save_read_table")
def save_read_table(spark, sf_dir):
    schema = _own_schema(spark, "save")
    t = f"{schema}.px_cat"
    catalog.save_table(layers.silver_table(spark, sf_dir, "erp_px_cat_g1v2"), t)
    return catalog.read_table(spark, t)


@register("schema_guard")
def schema_guard(spark, sf_dir):
    """Overwrite with the same schema passes; a changed schema is refused (K2)."""
    schema = _own_schema(spark, "guard")
    t = f"{schema}.cust"
    cust = layers.silver_table(spark, sf_dir, "crm_cust_info")
    rows = []
    first = catalog.save_table(cust, t, replace_schema=False)
    rows.append(("first write", "ok", first["rows"]))
    again = catalog.save_table(cust, t, replace_schema=False)
    rows.append(("same schema", "ok", again["rows"]))
    try:
        catalog.save_table(cust.withColumn("cst_id", F.col("cst_id").cast("string")), t,
                           replace_schema=False)
        rows.append(("changed type", "ok", None))
    except catalog.SchemaMismatch:
        rows.append(("changed type", "refused", None))
    kept = catalog.read_table(spark, t).count()
    rows.append(("after refusal", "kept", kept))
    return spark.createDataFrame(rows, "step string, outcome string, n_rows bigint")


@register("catalog_list")
def catalog_list(spark, sf_dir):
    """Tables and columns of a schema, then a dry-run and a real clear (K3-K7)."""
    schema = _own_schema(spark, "listed")
    for name in ("prd_info", "erp_px_cat_g1v2"):
        catalog.save_table(layers.silver_table(spark, sf_dir, name), f"{schema}.{name}")
    listed = catalog.tables(spark, schema).select("tableName").collect()
    cols = []
    for r in listed:
        for c in catalog.columns(spark, f"{schema}.{r.tableName}").collect():
            cols.append((r.tableName, c.col_name))
    planned = catalog.clear_schema(spark, schema, dry_run=True).count()
    dropped = catalog.clear_schema(spark, schema, dry_run=False).filter("status = 'dropped'").count()
    left = catalog.tables(spark, schema).count()
    catalog.drop_schema(spark, schema, cascade=True)
    rows = [(t, c, planned, dropped, left) for t, c in cols]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, n_planned bigint, n_dropped bigint, n_left bigint")


@register("stream_ingest")
def stream_ingest_q(spark, sf_dir):
    """CSV exports picked up by a file stream into a bronze table (incremental D0)."""
    schema = _own_schema(spark, "stream")
    table = f"{schema}.erp_loc_a101"
    stream_ingest.ingest_available(spark, _export(spark, sf_dir, "erp", "loc_a101"), table,
                                   "CID STRING, CNTRY STRING",
                                   checkpoint=shared_dir(spark, "streams", schema))
    return catalog.read_table(spark, table).drop("_ingest_timestamp", "_source_file")
