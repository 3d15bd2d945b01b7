"""What every stored table was built from: loads and layer runs that need no repeat.

A state table holds one row per table built: the source it was built from (an
export, or its input tables), a digest of that source's stored files and of the
options, and a digest of the files the build left. A run that is given a state
table skips a table whose last row still tells the truth: same source, same
digests, table untouched since. So a second ingest re-reads no unchanged
export, and a run that failed in gold does not build silver again.

A row is appended after its table stands; what a crash leaves unrecorded is
built again, to the same rows. One run at a time writes a state table.
"""

from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.sources import catalog, files

SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("inputs", T.StringType()),
    T.StructField("output", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("built_at", T.TimestampType()),
])

# Appends of one application's threads go one by one: two jobs that append to one
# folder at a time share its work folder.
_APPEND = threading.Lock()


def ensure(spark: SparkSession, state: str) -> str:
    """Create the state table (and its schema) where it is missing."""
    if not catalog.table_exists(spark, state):
        schema = state.rpartition(".")[0]
        if schema and not spark.catalog.databaseExists(schema):
            catalog.ensure_schema(spark, schema)
        spark.createDataFrame([], SCHEMA).write.format("parquet").saveAsTable(state)
    return state


def last_builds(spark: SparkSession, state: str) -> DataFrame:
    """The last row of every table (partial aggregation: one row per table and task is shuffled)."""
    rest = ["source", "inputs", "output", "rows"]
    return (spark.table(state).groupBy("table_name")
            .agg(F.max(F.struct("built_at", *rest)).alias("b")).select("table_name", *[f"b.{c}" for c in rest]))


def remembered(spark: SparkSession, state: str) -> dict[str, tuple[str, str, str, int]]:
    """``{table: (source, inputs, output, rows)}``: catalog-sized, one entry per table of a layer."""
    return {r.table_name: (r.source, r.inputs, r.output, r.rows) for r in last_builds(spark, state).collect()}


def record(spark: SparkSession, state: str, table: str, source: str, inputs: str, rows: int | None) -> None:
    """Append one build; the table's files are fingerprinted as they stand now."""
    row = spark.createDataFrame([(table, source, inputs, version(spark, table), rows, None)], SCHEMA)
    with _APPEND:
        (row.withColumn("built_at", F.current_timestamp()).coalesce(1)
            .write.format("parquet").mode("append").saveAsTable(state))


def digest(*parts) -> str:
    return hashlib.sha256("\n".join(repr(p) for p in parts).encode()).hexdigest()


def version(spark: SparkSession, table: str) -> str | None:
    """A digest of a stored table's files and columns; ``None`` if there is no such table."""
    if not catalog.table_exists(spark, table):
        return None
    return digest(files.fingerprint(spark, catalog.location(spark, table)), spark.table(table).schema.json())


def versions(spark: SparkSession, tables) -> str:
    """One digest of several tables, in the order given."""
    return digest(*[(t, version(spark, t)) for t in tables])


def unchanged(spark: SparkSession, known: dict, table: str, source: str, inputs: str) -> int | None:
    """The rows of a table whose last build still holds, else ``None``."""
    last = known.get(table)
    if last is None or last[:2] != (source, inputs) or last[2] is None or last[2] != version(spark, table):
        return None
    return last[3]
