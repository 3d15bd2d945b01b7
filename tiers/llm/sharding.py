"""Sharding by extendible hashing.

Every key has an address, the bits of its digest. The directory starts with
one bucket; a bucket over the byte limit splits on its address's next bit, and
only such buckets do, until every shard fits. A shard is named by its bits.

Rows of one key share all key bits, so a key larger than a shard goes on with
the bits of a digest of the row itself; equal rows beyond that are told apart by
their copy number. So one key, or one row repeated without end, is split too. A
single row over the limit is a shard of its own.

Plan: sizes are summed per address cell (combined map-side), deeper cells only
where a cell is still too large; the directory is built from those sums, and
rows meet it by their cell. Rows themselves are not collected or sorted.

Edge cases: NULL keys are a key; rows without bytes count 0; an empty table
gives no row; columns of the input stay, a column named like an output is
replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiers.llm.frame import take, written

#: Bits of one digest that are used.
BITS = 60
#: Depth of cells below the depth that even sizes would need, and per next round.
FINER, DEEPER = 3, 4
#: Levels of the directory that are summed at once (a cell has so many ancestors).
SPAN = 12


def address(values: Column) -> Column:
    """The leading ``BITS`` bits of a digest as a string of 0 and 1."""
    return F.lpad(F.bin(F.conv(F.substring(F.md5(values.cast("binary")), 1, BITS // 4), 16, 10).cast("bigint")), BITS, "0")


def _prefix(bits: Column | str, depth: Column | int) -> Column:
    return F.substring(F.col(bits) if isinstance(bits, str) else bits, F.lit(1),
                       F.lit(depth) if isinstance(depth, int) else depth)


def _sums() -> list[Column]:
    return [F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")]


def _leaf_depth(cells: DataFrame, depth: int, limit: int) -> DataFrame:
    """``path, cell, depth``: the depth of the topmost ancestor of a cell that fits (NULL: none).

    ``SPAN`` levels at a time, so that no ancestor gathers more than 2^SPAN rows."""
    top = max(0, depth - SPAN)
    up = cells.withColumn("depth", F.explode(F.sequence(F.lit(top), F.lit(depth)))).withColumn("node", _prefix("cell", F.col("depth")))
    fit = (up.groupBy("path", "depth", "node").agg(*_sums()).filter((F.col("bytes") <= limit) | (F.col("rows") == 1))
           .select("path", "depth", "node"))
    own = up.join(fit, ["path", "depth", "node"]).groupBy("path", "cell").agg(F.min("depth").alias("depth"))
    found = cells.select("path", "cell").join(own, ["path", "cell"], "left")
    if top == 0:
        return found
    above = _leaf_depth(written(cells.withColumn("cell", _prefix("cell", top)).groupBy("path", "cell").agg(*_sums()), "cells"),
                        top, limit).withColumnsRenamed({"cell": "node", "depth": "upper"})
    return (found.withColumn("node", _prefix("cell", top)).join(above, ["path", "node"], "left")
            .select("path", "cell", F.coalesce("upper", "depth").alias("depth")))


def _split(rows: DataFrame, limit: int) -> tuple[list[DataFrame], DataFrame | None]:
    """Shards of ``rows`` (path, bits, bytes): frames with the rows and their ``shard``, and
    the rows of single addresses that stay over the limit (None if there are none)."""
    largest = rows.groupBy("path").agg(F.sum("bytes").alias("bytes")).agg(F.max("bytes")).first()[0]
    if largest is None:
        return [], None
    depth = min(BITS, max(1, math.ceil(math.log2(max(1, largest) / limit)) + FINER) if largest > limit else 1)
    done, single = [], []
    left = rows
    while True:
        cut = left.withColumn("cell", _prefix("bits", depth))
        cells = written(cut.groupBy("path", "cell").agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.min("bits").alias("low"), F.max("bits").alias("high")),
            "cells")
        directory = written(cells.select("path", "cell", (F.col("low") == F.col("high")).alias("alone"))
                            .join(_leaf_depth(cells, depth, limit), ["path", "cell"]), "directory")
        found = cut.join(directory, ["path", "cell"])
        done.append(found.filter("depth is not null")
                    .withColumn("shard", F.concat("path", _prefix("cell", F.col("depth")))).drop("cell", "alone", "depth"))
        open_ = directory.filter("depth is null")
        if not open_.filter("alone").isEmpty():
            single.append(found.filter("depth is null and alone").withColumn("path", F.concat("path", "bits"))
                          .drop("cell", "alone", "depth"))
        if open_.filter("not alone").isEmpty():
            return done, reduce(DataFrame.unionAll, single) if single else None
        left = found.filter("depth is null and not alone").drop("cell", "alone", "depth")
        depth = min(BITS, depth + DEEPER)


def shard(df: DataFrame, key: list[str], limit: int, size: Column) -> DataFrame:
    """``df`` with ``shard``, its bits; no shard has more than ``limit`` bytes unless it is
    a single row. ``size`` is a row's bytes. Columns that are not named ``_...`` stay.

    A shard is never larger than the limit, and two shards that differ in the last
    bit only would not fit one: no bucket is split without need.
    """
    keep = [c for c in df.columns if c not in ("shard",)]
    clean = take(df, *keep)
    rows = clean.select(F.struct(*keep).alias("row"), F.lit("").alias("path"),
                        address(F.to_json(F.struct(*key), {"ignoreNullFields": "false"})).alias("bits"),
                        F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")).alias("bytes"))
    done, hot = _split(rows, limit)
    if hot is not None:  # single keys over the limit: by the row's own digest
        more, equal = _split(hot.withColumn("bits", address(F.to_json("row"))), limit)
        done += more
        if equal is not None:
            done.append(_copies(equal, limit))
    if not done:
        return clean.limit(0).withColumn("shard", F.lit(""))
    return reduce(DataFrame.unionAll, [d.select("row.*", "shard") for d in done])


def _copies(rows: DataFrame, limit: int) -> DataFrame:
    """Equal rows over the limit, cut into shards by copy number. They fold into one row
    with a count (map-side) and unfold in pieces of at most 1,000 copies."""
    per = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(limit) / F.greatest("bytes", F.lit(1))).cast("bigint"))
    folded = (rows.groupBy("path").agg(F.first("row").alias("row"), F.max("bytes").alias("bytes"), F.count("*").alias("n"))
              .withColumn("per", per))
    part = folded.select("path", "row", "bytes", "n", "per", F.explode(F.expr("sequence(0, (n - 1) div per)")).alias("i"))
    part = part.withColumn("m", F.least("per", F.col("n") - F.col("i") * F.col("per")))
    piece = part.select("path", "row", "bytes", "i", "m", F.explode(F.expr("sequence(0, (m - 1) div 1000)")).alias("j"))
    piece = piece.withColumn("c", F.least(F.lit(1000).cast("bigint"), F.col("m") - F.col("j") * 1000)).repartition("path", "i", "j")
    return piece.select("row", "path", "bytes", F.explode(F.expr("sequence(1, c)")).alias("_"),
                        F.concat("path", F.lit("."), F.col("i").cast("string")).alias("shard")).drop("_")


#: Folder of a shard: a letter before the bits, so that a name is never read as a number
#: and the one shard of a table that fits it has a name too.
_FOLDER = "s"


def write_shards(sharded: DataFrame, path: str, fmt: str = "parquet") -> None:
    """One folder per shard, ``shard=s<bits>``; a shard is written by one task, since it is bounded.
    ``read_shards`` gives the rows back with the names of their shards."""
    named = sharded.withColumn("shard", F.concat(F.lit(_FOLDER), "shard"))
    named.repartition("shard").write.partitionBy("shard").format(fmt).save(path)


def read_shards(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """The rows of ``write_shards`` with their ``shard``. ``schema`` (of the written frame) is
    needed only where no row was written."""
    reader = spark.read.format(fmt)
    back = (reader.schema(schema) if schema is not None else reader).load(path)
    return back.withColumn("shard", F.substring("shard", len(_FOLDER) + 1, 1 << 30))
