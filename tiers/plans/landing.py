"""A landing folder of raw CSV exports derived from the driver tables.

Lays out what the reference's bronze job expects - ``<base>/crm`` and
``<base>/erp`` with stamped ``<digits>_<table>.csv`` exports - written by
Spark from the six raw extracts (each export a folder of CSV parts, written
in parallel). Also places the files the ingest must not turn into tables:
an older export of one table, a header-only export, a non-CSV file, an
export whose header does not match the schema declared for it and one whose
parts disagree on their header; and two tables whose newest export is empty or
broken, so that an older good one must stay.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tiers.session import shared_dir
from tiers.sources import driver_tables, files

STAMP = "20260101000000"
OLD_STAMP = "20251231000000"
NEW_STAMP = "20260201000000"

# (subset, file stem, raw extract)
EXPORTS = (
    ("crm", "cust_info", "crm_cust_info"),
    ("crm", "prd_info", "crm_prd_info"),
    ("crm", "sales_details", "crm_sales_details"),
    ("erp", "cust_az12", "erp_cust_az12"),
    ("erp", "loc_a101", "erp_loc_a101"),
    ("erp", "px_cat_g1v2", "erp_px_cat_g1v2"),
)

# Table whose export carries other column names than its declared schema.
BAD_TABLE = "erp_loc_a101_bad"
BAD_SCHEMA = "CUSTOMER_ID STRING, COUNTRY STRING"
# Table whose newest export has another header than declared, and an older good one.
KEPT_TABLE = "erp_px_kept"
KEPT_SCHEMA = "ID STRING, CAT STRING, SUBCAT STRING, MAINTENANCE STRING"
SCHEMAS = {BAD_TABLE: BAD_SCHEMA, KEPT_TABLE: KEPT_SCHEMA}


def _write(df, path: str, mode: str = "overwrite") -> None:
    # Spark's CSV writer trims values unless told not to; raw text keeps its blanks.
    (df.write.mode(mode).option("header", "true")
       .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
       .csv(path))


def write_landing(spark: SparkSession, sf_dir: str, base: str | None = None,
                  extras: bool = True) -> str:
    """Write the landing folder and return its path (under the shared folder)."""
    base = (base or shared_dir(spark, "landing")).rstrip("/")
    raws = driver_tables.raw_all(spark, sf_dir)
    cust, prd, loc, cat = (raws[n] for n in ("crm_cust_info", "crm_prd_info", "erp_loc_a101", "erp_px_cat_g1v2"))
    # one entry per export: its writes, in order
    work = [[(raws[extract], f"{subset}/{STAMP}_{stem}.csv")] for subset, stem, extract in EXPORTS]
    if extras:
        work += [
            [(cust, f"crm/{OLD_STAMP}_cust_info.csv")],
            [(cust.limit(0), f"crm/{STAMP}_empty-file.csv")],
            [(loc, f"erp/{STAMP}_loc a101-bad.csv")],
            [(prd, f"crm/{OLD_STAMP}_prd_kept.csv")],
            [(prd.limit(0), f"crm/{STAMP}_prd_kept.csv")],
            [(cat, f"erp/{OLD_STAMP}_px_kept.csv")],
            [(cat.withColumnRenamed("ID", "CODE"), f"erp/{STAMP}_px_kept.csv")],
            [(loc.select("CID", "CNTRY"), f"erp/{STAMP}_mixed.csv"),
             (loc.select("CNTRY", "CID"), f"erp/{STAMP}_mixed.csv", "append")],
        ]
        files.write_csv(loc.selectExpr("CID AS note"), f"{base}/crm/readme.txt")

    def export(writes):
        for df, name, *mode in writes:
            _write(df, f"{base}/{name}", *mode)

    # the sales first, beside the others: most of those are a task or two
    work.sort(key=lambda writes: writes[0][0] is not raws["crm_sales_details"])
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(export, work))
    return base


def write_newer(spark: SparkSession, sf_dir: str, base: str) -> None:
    """A newer export of the category table joins a landing folder: its rows that name a category."""
    raw = driver_tables.raw(spark, sf_dir, "erp_px_cat_g1v2")
    _write(raw.filter("CAT IS NOT NULL"), f"{base}/erp/{NEW_STAMP}_px_cat_g1v2.csv")


def export_schemas(spark: SparkSession, sf_dir: str) -> dict:
    """Bronze table name -> schema of its export, for a one-pass typed ingest."""
    out = {extract: driver_tables.raw(spark, sf_dir, extract).schema for _, _, extract in EXPORTS}
    return out | SCHEMAS
