"""Raw CSV files -> bronze tables, with a run report.

For each landing subset (``crm``, ``erp``): list the ``*.csv`` entries, name
the target table from the file name, and ingest the newest usable file of each
as one managed table with audit columns. Failures do not stop
the run; every subset and file gets a row in the returned report, and the
caller decides what a failure means (trap T18).

Per table the data is read once by the write itself: with a schema there is
no inference pass, and the row count is observed on the write. Tables are
independent and ingested from a small thread pool on one session.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.plans import state as states
from tiers.session import label_jobs
from tiers.sources import catalog, files

REPORT_SCHEMA = T.StructType([
    T.StructField("subset", T.StringType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("error", T.StringType()),
])


def plan_files(spark: SparkSession, base_path: str, subsets: Sequence[str], strip_timestamp: bool = True):
    """Files of every target table ``{table_name: [(subset, path, name), ...]}``, oldest
    first, and report rows for unreadable subsets (S5, S8, K9, K10).

    The listing is metadata: it is named and brought to the driver in one pass.
    """
    listings, problems = [], []
    for subset in subsets:
        path = base_path.rstrip("/") + "/" + subset.strip("/")
        try:
            listings.append(files.list_files(spark, path, ".csv", subset=subset))
        except Exception as e:
            problems.append((subset, None, None, "unreadable", None, _err(e)))
    if not listings:
        return {}, problems
    listing = listings[0]
    for more in listings[1:]:
        listing = listing.unionByName(more)
    listing = listing.withColumn("table_name", files.table_name("subset", "name", strip_timestamp))
    work: dict[str, list[tuple[str, str, str]]] = {}
    for r in listing.select("subset", "path", "name", "table_name").orderBy("name", "path").collect():
        work.setdefault(r.table_name, []).append((r.subset, r.path, r.name))
    return work, problems


def export_digests(spark: SparkSession, base_path: str, subsets: Sequence[str]) -> DataFrame:
    """Digest of every export's files, ``(subset, name, digest)``; unreadable subsets are left out."""
    parts = []
    for subset in subsets:
        try:
            parts.append(files.fingerprints(spark, base_path.rstrip("/") + "/" + subset.strip("/"), subset=subset))
        except Exception:               # plan_files reports it
            continue
    found = spark.createDataFrame([], "subset string, name string, digest string")
    for p in parts:
        found = found.unionByName(p.select("subset", "name", "digest"))
    return found


def _err(e: Exception) -> str:
    return f"{type(e).__name__}: {e}" if str(e) else type(e).__name__


def ingest_file(spark: SparkSession, path: str, table: str, schema=None, infer: bool = True,
                fmt: str = "parquet") -> tuple[str, int | None, str | None]:
    """One file (or folder of parts) -> one bronze table: (status, rows, error)."""
    try:
        df = files.read_csv(spark, path, schema=schema, infer=infer, check_headers=True)
        if df.isEmpty():
            return "empty", 0, None
        result = catalog.save_table(files.add_audit(df), table, fmt=fmt, replace_schema=True)
        return "ok", result["rows"], None
    except Exception as e:
        return "failed", None, _err(e)


def ingest(spark: SparkSession, base_path: str, subsets: Sequence[str] = ("crm", "erp"),
           schema: str = "bronze", schemas: Mapping[str, T.StructType | str] | None = None,
           infer: bool = True, fmt: str = "parquet", strip_timestamp: bool = True,
           latest_only: bool = True, parallelism: int = 4, location: str | None = None,
           state: str | None = None) -> DataFrame:
    """Run the bronze layer; returns the report ``(subset, file_name, table_name, status, rows, error)``.

    ``schemas`` maps a table name (without schema) to an explicit schema; such
    tables skip inference. Every file's header is checked while it is read (T13).

    With ``latest_only`` the newest usable file of a table wins (K11): files are
    tried newest first until one loads, and only those older than it are
    ``superseded``; a newer file that is empty or fails has its own report row and
    leaves the table to the next one. Without it every file is loaded in name
    order, each overwriting the table. A table's files are handled by one thread,
    so their order is fixed.

    ``state`` names a table that remembers loads (``tiers.plans.state``): an export
    that is the one its table was last loaded from, with the same files, options
    and an untouched table, is ``unchanged`` and not read; the others are loaded
    and recorded. Only with ``latest_only``, where a table has one source.
    """
    if state and not latest_only:
        raise ValueError("a state table needs latest_only: one source per table")
    catalog.ensure_schema(spark, schema, location)
    work, report = plan_files(spark, base_path, subsets, strip_timestamp)
    schemas = dict(schemas or {})
    known, content = {}, {}
    if state:
        known = states.remembered(spark, states.ensure(spark, state))
        content = {(r.subset, r.name): r.digest for r in export_digests(spark, base_path, subsets).collect()}

    def inputs(tname, subset, name):
        given = schemas.get(tname)
        return states.digest(content.get((subset, name)), given if given is None or isinstance(given, str) else given.json(),
                             infer, fmt)

    def one(item):
        tname, found = item
        rows, loaded = [], False
        with label_jobs(spark, "bronze", f"{schema}.{tname}"):
            for subset, path, name in reversed(found) if latest_only else found:
                if latest_only and loaded:
                    rows.append((subset, name, tname, "superseded", None, None))
                    continue
                target, source = f"{schema}.{tname}", f"{subset}/{name}"
                seen = states.unchanged(spark, known, target, source, inputs(tname, subset, name)) if state else None
                if seen is not None:
                    loaded = True
                    rows.append((subset, name, tname, "unchanged", seen, None))
                    continue
                status, n, err = ingest_file(spark, path, f"{schema}.{tname}", schemas.get(tname), infer, fmt)
                loaded = loaded or status == "ok"
                if state and status == "ok":
                    states.record(spark, state, target, source, inputs(tname, subset, name), n)
                rows.append((subset, name, tname, status, n, err))
        return rows

    if parallelism > 1 and len(work) > 1:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            done = list(pool.map(one, work.items()))
    else:
        done = [one(w) for w in work.items()]
    return spark.createDataFrame(report + [r for rows in done for r in rows], REPORT_SCHEMA)


def summary(report: DataFrame) -> DataFrame:
    """Files per status, for a one-line verdict on a run."""
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("files"),
                                        F.sum("rows").alias("rows"))
