"""Table catalog: schemas, managed-table writes with a schema contract, listing, clean-up.

Names are passed as parameters with ``IDENTIFIER(:name)``, never spliced
into SQL text. Tables are named ``schema.table`` or ``catalog.schema.table``; the
format is a parameter (Parquet by default; Delta needs its jars).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """A write would change the columns or types of a table that must keep them (K2)."""


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> str:
    """``CREATE SCHEMA IF NOT EXISTS`` (K3); ``location`` places its managed tables."""
    if location:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:s) LOCATION '{_quote(location)}'",
                  args={"s": schema})
    else:
        spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:s)", args={"s": schema})
    return schema


def _quote(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def check_schema(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Raise ``SchemaMismatch`` if ``df`` does not have ``table``'s columns and types."""
    if not table_exists(spark, table):
        return
    have, want = _shape(df.schema), _shape(spark.table(table).schema)
    if have != want:
        raise SchemaMismatch(f"{table}: columns/types {have} differ from stored {want}")


# Formats whose overwrite is already an atomic commit; no staging needed.
TRANSACTIONAL = frozenset({"delta", "iceberg", "hudi"})


def save_table(df: DataFrame, table: str, fmt: str = "parquet", replace_schema: bool = True,
               partition_by=None, staged: bool | None = None, bucket_by: tuple[int, str] | None = None) -> dict:
    """Overwrite a managed table with ``df`` and return ``{"table", "rows"}`` (K1, K2, A1).

    * The row count is observed on the write itself: no second pass (A1).
    * ``replace_schema=False`` raises before writing if the columns or
      types would change (K2); Parquet would otherwise replace silently.
    * ``staged`` (default: for non-transactional formats): a failing write
      leaves the old table in place, and a table can be rebuilt from itself
      (T23). Where the columns stay, the data is written to a new version folder
      and one catalog operation points the table to it (``new_version``): at
      every moment readers find the old rows or the new ones. A table that is
      new, or changes its columns or partitions, is written as a staging table
      and swapped in by rename. A transactional format
      (its overwrite is atomic) needs no staging, and is told to replace the
      schema where that is asked for.
    * ``bucket_by`` = (number, column): rows are dealt by the column's hash once, one
      sorted file per bucket, so that later joins and aggregates on it need no
      shuffle. Such a table always goes by rename.
    """
    spark = df.sparkSession
    if staged is None:
        staged = fmt.lower() not in TRANSACTIONAL
    if not replace_schema:
        check_schema(spark, df, table)
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if staged and not partition_by and not bucket_by and _keeps_shape(spark, df, table, fmt):
        new_version(observed, table, fmt)
        return {"table": table, "rows": int(obs.get["rows"])}
    target = f"{table}__staging_{uuid.uuid4().hex[:8]}" if staged else table
    if bucket_by:
        observed = observed.repartition(*bucket_by)
    writer = observed.write.format(fmt).mode("overwrite")
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    if not staged and replace_schema:
        writer = writer.option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    try:
        writer.saveAsTable(target)
    except Exception:
        if staged:                      # leave no half-written staging table behind
            drop_table(spark, target)
        raise
    if staged:
        swap_table(spark, target, table)
    return {"table": table, "rows": int(obs.get["rows"])}


# ---- versions: an overwrite in one catalog operation --------------------------

def _details(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table: location, provider, whether it has partitions or buckets."""
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table}).collect()
    return {r.col_name: r.data_type for r in rows if r.col_name}


def location(spark: SparkSession, table: str) -> str:
    """The folder that holds a table's rows now."""
    return _details(spark, table)["Location"]


def _keeps_shape(spark: SparkSession, df: DataFrame, table: str, fmt: str) -> bool:
    """True if ``df`` can become the table's rows by a new location alone."""
    if not table_exists(spark, table):
        return False
    have = spark.table(table).schema
    if [(f.name, f.dataType) for f in have] != [(f.name, f.dataType) for f in df.schema]:
        return False
    d = _details(spark, table)
    return (d.get("Provider", "").lower() == fmt.lower() and d.get("Type") == "MANAGED"
            and "# Partition Information" not in d and int(d.get("Num Buckets", "0") or 0) == 0)


def _folders(spark: SparkSession, table: str) -> tuple[str, str]:
    """A managed table's default folder, and the one that holds its later versions."""
    schema, _, name = table.rpartition(".")
    home = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri.rstrip("/")
    return f"{home}/{name}", f"{home}/{name}__versions"


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def _same(spark: SparkSession, a: str, b: str) -> bool:
    fs, p = _path(spark, a)
    return fs.makeQualified(p).equals(fs.makeQualified(_path(spark, b)[1]))


def _set_location(spark: SparkSession, table: str, path: str) -> None:
    spark.sql(f"ALTER TABLE IDENTIFIER(:t) SET LOCATION '{_quote(path)}'", args={"t": table})
    spark.catalog.refreshTable(table)


def new_version(df: DataFrame, table: str, fmt: str = "parquet") -> None:
    """Make ``df`` the rows of a stored table of the same columns, for readers in one step.

    The rows are written to a version folder of their own; then the table's location
    is changed, one catalog operation. The version before stays for readers that
    still scan it and goes with the next overwrite; what a crash left behind goes then too.
    """
    spark = df.sparkSession
    default, versions = _folders(spark, table)
    before = _details(spark, table)["Location"]
    path = f"{versions}/{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).save(path)
        _set_location(spark, table, path)
    except Exception:
        _delete(spark, path)
        raise
    fs, root = _path(spark, versions)
    old = [st.getPath().toString() for st in fs.listStatus(root)] + [default]
    for p in old:
        if not any(_same(spark, p, keep) for keep in (path, before)):
            _delete(spark, p)


# ---- swap: a table that is new or changes its columns ----------------------------

#: Table property of a table that a swap set aside: without it a table is a user's own.
REPLACED = "tiers.replaced"


def _rename(spark: SparkSession, old: str, new: str) -> None:
    # the new name is taken inside the old one's catalog: without the catalog's own part
    new = ".".join(new.split(".")[-2:])
    spark.sql("ALTER TABLE IDENTIFIER(:a) RENAME TO IDENTIFIER(:b)", args={"a": old, "b": new})


def _mark(spark: SparkSession, table: str, replaced: bool) -> None:
    change = f"SET TBLPROPERTIES ('{REPLACED}' = 'true')" if replaced else f"UNSET TBLPROPERTIES IF EXISTS ('{REPLACED}')"
    spark.sql(f"ALTER TABLE IDENTIFIER(:t) {change}", args={"t": table})


def _backups(spark: SparkSession, table: str) -> tuple[list[str], str]:
    """The tables that swaps of ``table`` set aside, and the first free name for one."""
    ours, n = [], 1
    while table_exists(spark, name := f"{table}__replaced" + (f"_{n}" if n > 1 else "")):
        rows = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:t)", args={"t": name}).collect()
        if any(r.key == REPLACED for r in rows):
            ours.append(name)
        n += 1
    return ours, name


def swap_table(spark: SparkSession, staging: str, table: str) -> None:
    """Put ``staging`` in the place of ``table``.

    The old table is renamed aside, the new one renamed in, then the old one
    dropped. If a step fails, the old table goes back; after a crash between two
    steps ``recover_table`` (run by every swap first) puts it back, so there is
    always the old or the new table. A table set aside carries a property; one of
    such a name without it is somebody's own and left alone.
    """
    recover_table(spark, table)
    _, backup = _backups(spark, table)
    had = table_exists(spark, table)
    try:
        if had:
            _mark(spark, table, True)
            _rename(spark, table, backup)
            _drop_versions(spark, table)  # the rename took the current one along
        _rename(spark, staging, table)
    except Exception:
        if had and table_exists(spark, backup) and not table_exists(spark, table):
            _rename(spark, backup, table)
        if had and table_exists(spark, table):
            _mark(spark, table, False)
        drop_table(spark, staging)
        raise
    if had:
        drop_table(spark, backup)


def _drop_versions(spark: SparkSession, table: str) -> None:
    """Remove the folders of a name that no table has any more."""
    for path in _folders(spark, table):
        _delete(spark, path)


def recover_table(spark: SparkSession, table: str) -> None:
    """Finish a swap that a crash cut short: bring the old table back if the new one is
    not there, else drop it. Only tables that a swap set aside are touched."""
    for backup in _backups(spark, table)[0]:
        if table_exists(spark, table):
            drop_table(spark, backup)
        else:
            _rename(spark, backup, table)
            _mark(spark, table, False)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """Scan a table by name (S6, P3); one that a crashed swap set aside is brought back first."""
    if not table_exists(spark, table):
        recover_table(spark, table)
    return spark.table(table)


def query_table(spark: SparkSession, table: str, where: str | None = None, **params) -> DataFrame:
    """``SELECT * FROM <table> [WHERE ...]`` with the name and values as parameters."""
    sql = "SELECT * FROM IDENTIFIER(:__t)" + (f" WHERE {where}" if where else "")
    return spark.sql(sql, args={"__t": table, **params})


def tables(spark: SparkSession, schema: str) -> DataFrame:
    """``SHOW TABLES IN schema`` (K4)."""
    return spark.sql("SHOW TABLES IN IDENTIFIER(:s)", args={"s": schema})


def columns(spark: SparkSession, table: str) -> DataFrame:
    """``SHOW COLUMNS IN table`` (K5)."""
    return spark.sql("SHOW COLUMNS IN IDENTIFIER(:t)", args={"t": table})


def drop_table(spark: SparkSession, table: str) -> None:
    """``DROP TABLE IF EXISTS`` (K7), with the versions that overwrites left of it."""
    managed = table_exists(spark, table) and _details(spark, table).get("Type") == "MANAGED"
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": table})
    if managed:
        _drop_versions(spark, table)


def drop_schema(spark: SparkSession, schema: str, cascade: bool = False) -> None:
    """``DROP SCHEMA IF EXISTS [CASCADE]`` (K7)."""
    spark.sql("DROP SCHEMA IF EXISTS IDENTIFIER(:s)" + (" CASCADE" if cascade else ""),
              args={"s": schema})


_CLEAR = T.StructType([T.StructField("table_name", T.StringType()),
                       T.StructField("action", T.StringType()),
                       T.StructField("status", T.StringType()),
                       T.StructField("error", T.StringType())])


def clear_schema(spark: SparkSession, schema: str, dry_run: bool = True) -> DataFrame:
    """Drop every table of a schema, one by one; errors kept per table (K6).

    ``dry_run`` (the default) only reports what would be dropped.
    """
    rows = []
    for t in spark.catalog.listTables(schema):
        if t.isTemporary:
            continue
        name = f"{schema}.{t.name}"
        if dry_run:
            rows.append((name, "drop", "planned", None))
            continue
        try:
            drop_table(spark, name)
            rows.append((name, "drop", "dropped", None))
        except Exception as e:  # keep going, report per table
            rows.append((name, "drop", "failed", str(e)))
    return spark.createDataFrame(rows, _CLEAR)


def sample(spark: SparkSession, table: str, n: int = 5, order_by=None) -> DataFrame:
    """Read back a few rows after a write (K8); ordered when ``order_by`` is given."""
    df = spark.table(table)
    if order_by:
        df = df.orderBy(*([order_by] if isinstance(order_by, str) else order_by))
    return df.limit(n)
