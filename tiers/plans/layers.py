"""Silver and gold tables derived in one plan from the driver tables.

Used by the registered queries and the benchmark: the raw extracts
(``tiers.sources.driver_tables``) take the place of bronze, and the silver
and gold specs run on them unchanged. The stored, layer-by-layer run lives
in ``tiers.plans.runner``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tiers.plans import gold, silver
from tiers.plans.specs import GOLD_SPECS, SILVER
from tiers.sources import driver_tables


def silver_tables(spark: SparkSession, sf_dir: str, names=None, stamp: bool = False,
                  **opts) -> dict[str, DataFrame]:
    names = list(names) if names else list(SILVER)
    out = {}
    for name in names:
        spec = SILVER[name]
        # the driver's fact is one file with one row group: ask for it to be spread
        out[name] = silver.build(driver_tables.raw(spark, sf_dir, spec.source, spread_rows=True), spec,
                                 stamp=stamp, **opts)
    return out


def silver_table(spark: SparkSession, sf_dir: str, name: str, stamp: bool = False, **opts) -> DataFrame:
    return silver_tables(spark, sf_dir, [name], stamp=stamp, **opts)[name]


def gold_table(spark: SparkSession, sf_dir: str, name: str, stamp: bool = False,
               plain: bool = False, silver_opts: dict | None = None, **opts) -> DataFrame:
    spec = GOLD_SPECS[name]
    needed = [spec.base] + [lk.table for lk in spec.lookups]
    tables = silver_tables(spark, sf_dir, needed, stamp=plain, **(silver_opts or {}))
    if plain:
        return gold.build_plain(spec, tables, stamp=stamp)
    return gold.build(spec, tables, stamp=stamp, **opts)
