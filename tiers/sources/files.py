"""Raw file sources: listing, table naming, CSV scans, audit columns.

A "file" in a landing folder is what a directory listing shows: an
immediate child whose name ends in ``.csv``. It may be one
CSV file or a folder of CSV parts (what Spark itself writes); both read as
one table, so a big export is scanned in parallel, split by split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.functions.audit import source_file, stamp

LISTING_SCHEMA = T.StructType([
    T.StructField("subset", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("modified", T.LongType()),
    T.StructField("is_dir", T.BooleanType()),
])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hpath.getFileSystem(conf), hpath


def _entries(spark: SparkSession, path: str, subset: str = "", deep_size: bool = False) -> list[tuple]:
    """Immediate children of ``path`` (one metadata call, like ``ls``).

    A folder's size is 0 unless ``deep_size``, which lists its contents too
    (costly on object stores with many parts).
    """
    fs, hpath = _fs(spark, path)
    rows = []
    for st in fs.listStatus(hpath):
        p = st.getPath()
        size = st.getLen()
        if st.isDirectory():
            size = fs.getContentSummary(p).getLength() if deep_size else 0
        rows.append((subset, p.toString(), p.getName(), int(size), int(st.getModificationTime()),
                     bool(st.isDirectory())))
    return rows


def list_files(spark: SparkSession, path: str, suffix: str = ".csv", subset: str = "",
               deep_size: bool = False) -> DataFrame:
    """Children of ``path`` whose name ends in ``suffix``.

    Raises if the folder cannot be read; ``tiers.plans.bronze`` turns that
    into an ``unreadable`` report row (S8).
    """
    rows = [r for r in _entries(spark, path, subset, deep_size) if r[2].endswith(suffix)]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def _leaves(spark: SparkSession, path: str) -> DataFrame:
    """Every data file under ``path``: its place below it, bytes and time.

    Spark lists the tree (folders are spread over the executors where there are
    many) and the file names stay a DataFrame; no content is read.
    """
    fs, hpath = _fs(spark, path)
    root = fs.makeQualified(hpath).toString().rstrip("/")
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", "modificationTime"))
    # a file is a partition of its own: a few tasks a core read off all of them
    found = found.coalesce(4 * spark.sparkContext.defaultParallelism)
    place = F.when(F.col("path") == root, F.substring_index("path", "/", -1)).otherwise(
        F.substr("path", F.lit(len(root) + 2)))
    return found.select(place.alias("place"), "length", F.unix_micros("modificationTime").alias("modified"))


def _digest() -> list[Column]:
    """A digest of a set of files that needs no order, so it merges: count, bytes, and two sums of hashes."""
    parts = ["place", "length", "modified"]
    one = F.xxhash64(*parts)
    two = F.xxhash64(F.lit("second"), *parts).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("size"),
            F.sha2(F.concat_ws(":", F.count(F.lit(1)), F.sum("length"), F.bit_xor(one), F.sum(two)), 256).alias("digest")]


def fingerprints(spark: SparkSession, path: str, suffix: str = ".csv", subset: str = "") -> DataFrame:
    """Entries of ``path`` by their content's place, size and time: ``(subset, name, n_files, size, digest)``.

    Like ``list_files``, but a folder of parts is looked into: a part that is
    added, removed or rewritten changes the entry's digest. An entry without any
    file has no row.
    """
    name = F.substring_index("place", "/", 1)
    found = _leaves(spark, path).withColumn("name", name).filter(F.col("name").endswith(suffix))
    return found.groupBy("name").agg(*_digest()).select(F.lit(subset).alias("subset"), "name", "n_files", "size", "digest")


def fingerprint(spark: SparkSession, path: str) -> str:
    """One digest of all files under ``path``."""
    return _leaves(spark, path).agg(*_digest()).first().digest


def table_name(subset: Column | str, name: Column | str, strip_timestamp: bool = True) -> Column:
    """``<subset without '/'>_<file name - '.csv' - leading 'digits_'>``, '-' and ' ' -> '_' (K9).

    ``strip_timestamp=False`` keeps the leading digits (the older rule, K10).
    """
    sub = F.col(subset) if isinstance(subset, str) else subset
    nm = F.col(name) if isinstance(name, str) else name
    stem = F.substring(nm, F.lit(1), F.length(nm) - 4)
    if strip_timestamp:
        stem = F.regexp_replace(stem, r"^[0-9]+_", "")
        stem = F.translate(stem, "- ", "__")
    return F.concat(F.regexp_replace(sub, "/", ""), F.lit("_"), stem)


def latest_files(listing: DataFrame, by: str = "table_name", flag: str | None = None) -> DataFrame:
    """One file per target table: the last in name order.

    Stamped names sort by time, so the newest export wins - the table the
    reference ended up with after overwriting in listing order. With
    ``flag`` every file is kept and the named boolean column marks the
    winners, so chosen and superseded files come out of one pass.
    """
    w = Window.partitionBy(by).orderBy(F.col("name").desc(), F.col("path").desc())
    ranked = listing.withColumn("__rn", F.row_number().over(w))
    if flag:
        return ranked.withColumn(flag, F.col("__rn") == 1).drop("__rn")
    return ranked.filter("__rn = 1").drop("__rn")


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str | None = None,
             infer: bool = True, header: bool = True, mode: str = "PERMISSIVE",
             check_headers: bool = False) -> DataFrame:
    """CSV scan with header.

    * ``schema`` given: no inference pass, and the header must name the same
      columns (``enforceSchema=false``), so files with other headers fail
      instead of shifting values into wrong columns (T13).
    * ``infer=True``: types inferred, one extra pass over the data (S1).
    * ``infer=False``: every column a string (S2).
    * ``check_headers``: for a folder of files read as one table (S3), refuse
      when the files' header lines differ (T13); Spark would take the first
      file's header and shift the others' values. Each task compares the header
      of the file it reads, so the check costs no pass and no driver loop; a
      file that differs fails the job that reads it.
    """
    if header and check_headers and schema is None:
        schema = read_csv(spark, paths, None, infer, header, mode).schema
    reader = spark.read.option("header", str(header).lower()).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", "false")
    else:
        reader = reader.option("inferSchema", str(infer).lower())
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def peek_text(spark: SparkSession, path: str, n: int | None = 5) -> DataFrame:
    """Raw lines of text files (S4): a quick look at ``n`` lines, or all with ``None``."""
    lines = spark.read.text(path)
    return lines if n is None else lines.limit(n)


def add_audit(df: DataFrame, time_col: str = "_ingest_timestamp",
              file_col: str = "_source_file") -> DataFrame:
    """Ingest time and source file of each row.

    The file path comes from the hidden ``_metadata`` column and is
    URI-encoded (T14).
    """
    return df.withColumns({time_col: stamp(), file_col: source_file()})


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    """Write a DataFrame as a CSV export folder (one part per task)."""
    df.write.mode(mode).option("header", str(header).lower()).csv(path)
    return path
