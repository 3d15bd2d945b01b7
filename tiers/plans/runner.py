"""The three layers as stored tables, run in order with one report.

Layers hand over only through stored tables, as in the reference: bronze
tables are read by the silver specs, silver tables by the gold specs. Each
layer's tables are independent and written from a small thread pool; each
write is staged and swapped, so a failure keeps the previous table.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.operators.model import input_bytes
from tiers.plans import bronze, gold, silver
from tiers.plans import state as states
from tiers.plans.specs import GOLD_SPECS, SILVER
from tiers.session import aqe_broadcast, label_jobs, shuffle_partitions_for
from tiers.sources import catalog

REPORT_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])

COUNTED_SCHEMA = T.StructType(REPORT_SCHEMA.fields + [
    T.StructField("counts", T.MapType(T.StringType(), T.LongType()))])

# A stored bronze table of at least so many bytes is deduplicated in two phases:
# rows whose key stands once are neither sorted nor shuffled. Same rows.
TWO_PHASE_BYTES = 64 << 20
# What AQE may broadcast in gold: a lookup shrunk to the keys that repeat spares
# the fact a shuffle while it has at most some 64 MB.
GOLD_BROADCAST = "64m"

# Silver tables written without schema replacement in the reference (K2).
KEEP_SCHEMA = frozenset({"crm_cust_info"})


def _run(items, fn, parallelism: int):
    if parallelism > 1 and len(items) > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            return list(pool.map(fn, items))
    return [fn(i) for i in items]


def _stored(spark: SparkSession, schema: str, tables) -> list[DataFrame]:
    """The stored tables that exist (a missing one fails later, in its own report row)."""
    return [spark.table(f"{schema}.{t}") for t in dict.fromkeys(tables)
            if spark.catalog.tableExists(f"{schema}.{t}")]


def _err(e: Exception) -> str:
    return f"{type(e).__name__}: {e}" if str(e) else type(e).__name__


def _known(spark: SparkSession, state: str | None) -> dict:
    return states.remembered(spark, states.ensure(spark, state)) if state else {}


def _build(spark: SparkSession, layer: str, target: str, sources: Sequence[str], form: tuple, make,
           state: str | None, known: dict):
    """One table of a layer, unless its last build still holds: its report row and counts."""
    try:
        source = ",".join(sources)
        inputs = states.digest(states.versions(spark, sources), form) if state else ""
        seen = states.unchanged(spark, known, target, source, inputs) if state else None
        if seen is not None:
            return (layer, target, "unchanged", seen, None), None
        rows, counts = make()
        if state:
            states.record(spark, state, target, source, inputs, rows)
        return (layer, target, "ok", rows, None), counts
    except Exception as e:
        return (layer, target, "failed", None, _err(e)), None


def run_silver(spark: SparkSession, bronze_schema: str = "bronze", silver_schema: str = "silver",
               fmt: str = "parquet", names: Sequence[str] | None = None, parallelism: int = 3,
               location: str | None = None, counts: bool = False, state: str | None = None,
               buckets: int | None = None, **build_opts) -> DataFrame:
    """Bronze tables -> the six silver tables.

    ``counts`` adds a map column to the report: rows read, rows without a key, rows
    that repeat a key, rows kept, and the values each parse lost, all observed on
    the write itself (``silver.build_counted``). ``state`` names a table that remembers
    builds: a table whose inputs and options are as they were is ``unchanged``
    (``tiers.plans.state``), without counts. ``buckets`` stores every table in that
    many buckets of its spec's ``join_key``, so that the gold joins on it, run after
    run, need no shuffle; choose it by the largest table's bytes.
    """
    catalog.ensure_schema(spark, silver_schema, location)
    chosen = list(names or SILVER)
    inputs = _stored(spark, bronze_schema, [SILVER[n].source for n in chosen])

    def one(name: str):
        spec = SILVER[name]
        target, source = f"{silver_schema}.{spec.name}", f"{bronze_schema}.{spec.source}"

        def make():
            df, observed = spark.table(source), None
            if counts:
                df, observed = silver.build_counted(df, spec, **build_opts)
            else:
                method = "repeated" if input_bytes(df) >= TWO_PHASE_BYTES else "aggregate"
                df = silver.build(df, spec, **{"dedupe_method": method, **build_opts})
            res = catalog.save_table(df, target, fmt=fmt, replace_schema=spec.name not in KEEP_SCHEMA,
                                     bucket_by=(buckets, spec.join_key) if buckets and spec.join_key else None)
            return res["rows"], ({k: v or 0 for k, v in observed.get.items()} if counts else None)

        with label_jobs(spark, "silver", target):
            return _build(spark, "silver", target, [source], (name, fmt, counts, buckets, sorted(build_opts.items())), make, state, known)

    known = _known(spark, state)
    with shuffle_partitions_for(spark, *inputs):
        done = _run(chosen, one, parallelism)
    if counts:
        return spark.createDataFrame([row + (found,) for row, found in done], COUNTED_SCHEMA)
    return spark.createDataFrame([row for row, _ in done], REPORT_SCHEMA)


def run_gold(spark: SparkSession, silver_schema: str = "silver", gold_schema: str = "gold",
             fmt: str = "parquet", names: Sequence[str] | None = None, parallelism: int = 3,
             location: str | None = None, plain: bool = False, state: str | None = None,
             **build_opts) -> DataFrame:
    """Silver tables -> ``dim_customer``, ``dim_product``, ``fact_sales``.

    ``plain`` uses the reference's chained joins instead of checked lookups;
    ``state`` as in ``run_silver``.
    """
    catalog.ensure_schema(spark, gold_schema, location)
    chosen = list(names or GOLD_SPECS)
    inputs = _stored(spark, silver_schema, [GOLD_SPECS[n].base for n in chosen])

    def one(name: str):
        spec = GOLD_SPECS[name]
        target = f"{gold_schema}.{spec.name}"
        needed = [spec.base] + [lk.table for lk in spec.lookups]

        def make():
            tables = {t: spark.table(f"{silver_schema}.{t}") for t in needed}
            df = gold.build_plain(spec, tables) if plain else gold.build(spec, tables, **build_opts)
            return catalog.save_table(df, target, fmt=fmt)["rows"], None

        with label_jobs(spark, "gold", target):
            return _build(spark, "gold", target, [f"{silver_schema}.{t}" for t in needed],
                          (name, fmt, plain, sorted(build_opts.items())), make, state, known)[0]

    known = _known(spark, state)
    with shuffle_partitions_for(spark, *inputs), aqe_broadcast(spark, GOLD_BROADCAST):
        done = _run(chosen, one, parallelism)
    return spark.createDataFrame(done, REPORT_SCHEMA)


def run_all(spark: SparkSession, base_path: str, subsets: Sequence[str] = ("crm", "erp"),
            schemas: tuple[str, str, str] = ("bronze", "silver", "gold"), fmt: str = "parquet",
            location: str | None = None, bronze_opts: dict | None = None,
            silver_opts: dict | None = None, gold_opts: dict | None = None,
            faithful: bool = False, state: str | None = None) -> DataFrame:
    """bronze -> silver -> gold in the reference's fixed order; one report for all layers.

    ``faithful=True`` reproduces the reference exactly: strict casts and
    dates (a bad value fails the table under ANSI, T3/T5), ``dropDuplicates``
    (an undefined duplicate survives, T1) and plain chained joins.

    ``state`` names a table that remembers builds over runs: a run touches only
    exports that are new or changed and tables whose inputs changed, so a run that
    failed in a layer goes on there. With ``silver_opts={"counts": True}`` the
    report has the silver counts.
    """
    b, s, g = schemas
    silver_opts = dict(silver_opts or {})
    gold_opts = dict(gold_opts or {})
    if faithful:
        silver_opts.setdefault("strict", True)
        silver_opts.setdefault("dedupe_method", "any")
        gold_opts.setdefault("plain", True)
    loc = (lambda n: f"{location.rstrip('/')}/{n}") if location else (lambda n: None)
    rep_b = bronze.ingest(spark, base_path, subsets, schema=b, fmt=fmt, location=loc(b),
                          state=state, **(bronze_opts or {}))
    rep_b = rep_b.select(F.lit("bronze").alias("layer"),
                         F.when(F.col("table_name").isNull(), F.col("subset"))
                          .otherwise(F.concat(F.lit(b + "."), F.col("table_name"))).alias("table_name"),
                         "status", "rows", "error")
    rep_s = run_silver(spark, b, s, fmt=fmt, location=loc(s), state=state, **silver_opts)
    rep_g = run_gold(spark, s, g, fmt=fmt, location=loc(g), state=state, **gold_opts)
    return (rep_b.unionByName(rep_s, allowMissingColumns=True)
            .unionByName(rep_g, allowMissingColumns=True))
