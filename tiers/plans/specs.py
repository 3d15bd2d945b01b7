"""Declarative table specs: the six silver tables and the three gold tables.

A silver spec is data - required keys, the dedup key, ordered column rules -
compiled by ``tiers.plans.silver.build`` into one lazy plan. Rules are
functions of ``strict`` so that the same spec yields the lenient (default)
or the reference's strict parsing.

Rule order is the reference's ``withColumn`` order, so output columns come
out in the same positions; the key rewrites run after the dedup, as in the
reference (trap T2), unless ``build(..., dedupe_after_rules=True)``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiers.functions import audit, parse, text

Rule = tuple[str, Callable[[bool], Column]]

CLEANED = "_cleaned_timestamp"
GOLD = "_gold_timestamp"

# The flag map of the category maintenance column.
MAINTENANCE_YES = ("Y", "1", "TRUE", "YES", "REQ")
MAINTENANCE_NO = ("N", "0", "FALSE", "NO", "NONE")
# Marital status by the prefix of the folded text.
MARITAL_PREFIXES = (("s", "Single"), ("m", "Married"))


@dataclass(frozen=True)
class SilverSpec:
    name: str                      # silver table
    source: str                    # bronze table
    required: tuple[str, ...]      # rows with a NULL here are dropped
    dedupe_on: tuple[str, ...]     # one row per this key
    rules: tuple[Rule, ...]        # ordered column rules (stamp included)
    order_by: tuple[str, ...] | None = None   # which duplicate stays (default: all columns)
    key: tuple[str, ...] = ()      # the key after rewrites (checked by unique_key)
    parsed: tuple[str, ...] = ()   # columns whose rule parses text: a value may be lost
    join_key: str | None = None    # gold joins on it: the column to bucket a stored table by
    source_id: tuple[str, str] | None = None  # (column a rule overwrites, name to keep it under)


def _stamp(_strict: bool) -> Column:
    return audit.stamp()


CRM_CUST_INFO = SilverSpec(
    name="crm_cust_info", source="crm_cust_info",
    required=("cst_id", "cst_key"), dedupe_on=("cst_key",), key=("cst_key",),
    parsed=("cst_create_date",), join_key="cst_key",
    rules=(
        ("cst_firstname", lambda s: text.title("cst_firstname")),
        ("cst_lastname", lambda s: text.title("cst_lastname")),
        ("cst_gndr", lambda s: text.initial("cst_gndr", default="Unknown")),
        ("cst_marital_status", lambda s: text.by_prefix("cst_marital_status", MARITAL_PREFIXES, "Unknown")),
        ("cst_create_date", lambda s: parse.to_date("cst_create_date", "MM/dd/yyyy", strict=s)),
        (CLEANED, _stamp),
    ),
)

PRD_INFO = SilverSpec(
    name="prd_info", source="crm_prd_info",
    required=("prd_id", "prd_key"), dedupe_on=("prd_key",), key=("prd_key",),
    parsed=("prd_cost",), join_key="prd_id", source_id=("prd_id", "prd_num"),
    rules=(
        ("prd_nm", lambda s: text.title("prd_nm")),
        ("prd_line", lambda s: text.code("prd_line")),
        ("prd_cost", lambda s: parse.to_decimal("prd_cost", 10, 2, strict=s)),
        (CLEANED, _stamp),
        ("cat_id", lambda s: text.key_prefix("prd_key", 5)),
        # trap T8: the numeric id is replaced by the short product key
        ("prd_id", lambda s: text.key_suffix("prd_key", 7)),
    ),
)

SALES_DETAILS = SilverSpec(
    name="sales_details", source="crm_sales_details",
    required=("sls_ord_num", "sls_prd_key", "sls_cust_id"),
    dedupe_on=("sls_ord_num", "sls_prd_key"), key=("sls_ord_num", "sls_prd_key"),
    parsed=("sls_order_dt", "sls_ship_dt", "sls_due_dt", "sls_sales", "sls_price", "sls_quantity"),
    join_key="sls_prd_key",
    rules=(
        ("sls_order_dt", lambda s: parse.to_date("sls_order_dt", "yyyyMMdd", strict=s)),
        ("sls_ship_dt", lambda s: parse.to_date("sls_ship_dt", "yyyyMMdd", strict=s)),
        ("sls_due_dt", lambda s: parse.to_date("sls_due_dt", "yyyyMMdd", strict=s)),
        ("sls_sales", lambda s: parse.money("sls_sales", 10, 2, strict=s)),
        ("sls_price", lambda s: parse.money("sls_price", 10, 2, strict=s)),
        ("sls_quantity", lambda s: parse.to_int("sls_quantity", strict=s)),
        (CLEANED, _stamp),
    ),
)

ERP_CUST_AZ12 = SilverSpec(
    name="erp_cust_az12", source="erp_cust_az12",
    required=("CID",), dedupe_on=("CID",), key=("CID",), parsed=("BDATE",), join_key="CID",
    rules=(
        ("GEN", lambda s: text.initial("GEN")),
        ("BDATE", lambda s: parse.to_date("BDATE", "yyyy-MM-dd", strict=s)),
        (CLEANED, _stamp),
        # trap T6: cut always, also from keys that never had the prefix
        ("CID", lambda s: text.strip_prefix("CID", 3)),
    ),
)

LOC_A101 = SilverSpec(
    name="loc_a101", source="erp_loc_a101",
    required=("CID",), dedupe_on=("CID",), key=("CID",), join_key="CID",
    rules=(
        ("CNTRY", lambda s: F.coalesce(text.code("CNTRY"), F.lit("UNKNOWN"))),
        (CLEANED, _stamp),
        ("CID", lambda s: text.remove("CID", "-")),
    ),
)

ERP_PX_CAT_G1V2 = SilverSpec(
    name="erp_px_cat_g1v2", source="erp_px_cat_g1v2",
    required=("ID",), dedupe_on=("ID",), key=("ID",), join_key="ID",
    rules=(
        ("CAT", lambda s: text.code("CAT")),
        ("SUBCAT", lambda s: text.code("SUBCAT")),
        ("MAINTENANCE", lambda s: F.coalesce(
            text.by_value(text.code("MAINTENANCE"), {"YES": MAINTENANCE_YES, "NO": MAINTENANCE_NO}),
            F.lit("UNKNOWN"))),
        (CLEANED, _stamp),
        ("ID", lambda s: text.replace("ID", "_", "-")),
    ),
)

SILVER = {s.name: s for s in (CRM_CUST_INFO, PRD_INFO, SALES_DETAILS, ERP_CUST_AZ12,
                              LOC_A101, ERP_PX_CAT_G1V2)}


@dataclass(frozen=True)
class Lookup:
    table: str                             # silver table joined on the right
    left_on: tuple[str, ...]
    right_on: tuple[str, ...]
    keep: tuple[str, ...] = ()             # right columns carried into the result


@dataclass(frozen=True)
class GoldSpec:
    name: str
    base: str                              # silver table on the left
    lookups: tuple[Lookup, ...]
    columns: tuple[tuple[str, str], ...]   # (output, input) in output order


DIM_CUSTOMER = GoldSpec(
    name="dim_customer", base="crm_cust_info",
    lookups=(Lookup("erp_cust_az12", ("cst_key",), ("CID",), ("GEN", "BDATE")),
             Lookup("loc_a101", ("cst_key",), ("CID",), ("CNTRY",))),
    columns=(("customer_id", "cst_id"), ("first_name", "cst_firstname"),
             ("last_name", "cst_lastname"), ("marital_status", "cst_marital_status"),
             ("crm_gender", "cst_gndr"), ("erp_gender", "GEN"),
             ("birth_date", "BDATE"), ("country", "CNTRY")),
)

DIM_PRODUCT = GoldSpec(
    name="dim_product", base="prd_info",
    lookups=(Lookup("erp_px_cat_g1v2", ("cat_id",), ("ID",), ("CAT", "SUBCAT")),),
    columns=(("product_key", "prd_key"), ("product_name", "prd_nm"), ("cost", "prd_cost"),
             ("line", "prd_line"), ("category_id", "cat_id"), ("category_name", "CAT"),
             ("subcategory_name", "SUBCAT")),
)

# trap T9/T10: the fact carries the short product key and takes no column
# from either dimension; the joins can only repeat rows.
FACT_SALES = GoldSpec(
    name="fact_sales", base="sales_details",
    lookups=(Lookup("prd_info", ("sls_prd_key",), ("prd_id",)),
             Lookup("crm_cust_info", ("sls_cust_id",), ("cst_id",))),
    columns=(("order_number", "sls_ord_num"), ("product_key", "sls_prd_key"),
             ("customer_id", "sls_cust_id"), ("order_date", "sls_order_dt"),
             ("sales_amount", "sls_sales"), ("quantity", "sls_quantity"),
             ("price", "sls_price")),
)

GOLD_SPECS = {g.name: g for g in (DIM_CUSTOMER, DIM_PRODUCT, FACT_SALES)}
