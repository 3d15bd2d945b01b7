"""Table-level cleaning operators.

All functions take and return a DataFrame and stay lazy, but for the method
``repeated`` of ``dedupe``, which first finds the keys that repeat.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiers.functions.audit import stamp
from tiers.session import shared_dir


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def require_keys(df: DataFrame, keys) -> DataFrame:
    """Drop rows with a NULL in any key column (F1).

    Written as an IS NOT NULL conjunction, not ``dropna``: the conjunction is
    pushed into the Parquet scan, ``dropna``'s AtLeastNNonNulls is not.
    """
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in _names(keys)])
    return df.filter(cond)


def repeated_keys(df: DataFrame, keys) -> DataFrame:
    """The keys that more than one row has, with their number of rows ``n``, as a table of its own.

    A hash count: only keys are read and shuffled, and a key is one row per map
    task however often it occurs. The result is written under the shared folder,
    so its size is known when a join with it is planned.
    """
    counts = df.groupBy(*_names(keys)).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    path = shared_dir(df.sparkSession, "repeated_keys")
    counts.write.parquet(path)
    return df.sparkSession.read.schema(counts.schema).parquet(path)


# Repeated keys that are broadcast at most, as 64-bit hashes.
BROADCAST_KEYS = 2_000_000


def _dedupe_repeated(df: DataFrame, keys: list[str], order_by) -> DataFrame:
    """Rows of keys that stand once pass as they are; the ordered choice is made among the others.

    Keys are told apart by a hash: those that only share one with another key are
    among "the others" too, where the choice is made by the key itself. With more
    than ``BROADCAST_KEYS`` repeated ones all rows go through the one shuffle of
    the plain aggregate.
    """
    key = F.xxhash64(*keys)
    found = repeated_keys(df.select(key.alias("__k")), "__k").select("__k")
    n = found.count()
    if n == 0:
        return df
    if n > BROADCAST_KEYS:
        return dedupe(df, keys, order_by)
    found = F.broadcast(found)
    once = df.join(found, key == F.col("__k"), "left_anti")
    return once.unionByName(dedupe(df.join(found, key == F.col("__k"), "left_semi"), keys, order_by))


def dedupe(df: DataFrame, keys, order_by: Sequence[str | Column] | None = None,
           method: str = "aggregate") -> DataFrame:
    """Keep one row per key (A4, A5), chosen repeatably (trap T1).

    The kept row is the first under ``order_by`` (default: every non-key
    column ascending, NULLs first, in table order); remaining columns break
    ties, so the choice never depends on partitioning.

    ``method``:
      * ``aggregate`` (default) - ``min(struct(order..., rest...))`` per key.
        Partial aggregation runs before the shuffle, so a hot key with a third
        of all rows is cut to one row per map task and never lands whole in
        one reducer. Needs ascending column names in ``order_by``.
      * ``repeated`` - the same rows in two phases: a hash count finds the keys
        that repeat (a job of its own, which shuffles 8 bytes a key and count), and
        only their rows are aggregated. The rows of all other keys are neither sorted
        nor shuffled. Reads ``df`` three times, once for the keys alone: for stored
        tables, and only for inputs that give the same rows each time.
      * ``window`` - ``row_number() = 1`` over the key; any sort order.
      * ``any`` - ``dropDuplicates``: Spark keeps an undefined row (the
        reference's behaviour, not repeatable).
    """
    keys = _names(keys)
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"dedupe keys not in table: {missing}")
    rest = [c for c in df.columns if c not in keys]
    if method == "any" or not rest:
        return df.dropDuplicates(keys)
    if method == "repeated":
        return _dedupe_repeated(df, keys, order_by)
    order = list(order_by) if order_by else list(rest)
    plain = all(isinstance(o, str) and o in rest for o in order)
    if method == "aggregate" and plain:
        fields = order + [c for c in rest if c not in order]
        pos = {c: i for i, c in enumerate(fields)}
        row = F.min(F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)]))
        agg = df.groupBy(*keys).agg(row.alias("__first"))
        return agg.select(*[F.col(c) if c in keys else F.col(f"__first.f{pos[c]}").alias(c)
                            for c in df.columns])
    if method not in ("aggregate", "window"):
        raise ValueError(f"unknown dedupe method {method!r}")
    sort = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)}
    sort += [F.col(c).asc_nulls_first() for c in rest if c not in named]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1).drop("__rn"))


def dedupe_counted(df: DataFrame, required, keys, order_by: Sequence[str] | None = None,
                   raw: str = "__raw", keyed: str = "__keyed") -> DataFrame:
    """``require_keys`` and ``dedupe`` in one aggregate that also counts what they drop.

    One row per key, its columns those of the row that ``dedupe`` keeps (NULLs where
    no row of the key has all required columns), with ``raw``, the rows of the key,
    and ``keyed``, those with all required columns. The counts ride on the
    shuffle that the dedup makes anyway, and rows without a key are one row per map task.
    """
    keys = _names(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order_by) if order_by else list(rest)
    fields = order + [c for c in rest if c not in order]
    pos = {c: i for i, c in enumerate(fields)}
    has = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in _names(required)])
    row = F.struct(F.lit(0).alias("f"), *[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(raw), F.count_if(has).alias(keyed),
                                F.min(F.when(has, row)).alias("__first"))
    return agg.select(*[F.col(c) if c in keys else F.col(f"__first.f{pos[c]}").alias(c) for c in df.columns], raw, keyed)


def fill_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default per column (C21). A blank text is not NULL."""
    return df.fillna(dict(defaults))


def with_stamp(df: DataFrame, name: str) -> DataFrame:
    """Add (or overwrite) an audit timestamp column (P5)."""
    return df.withColumn(name, stamp())


def apply_rules(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Apply ordered column rules.

    Each rule sees the columns the earlier rules wrote, as chained
    ``withColumn`` calls do; Catalyst collapses the chain into one Project.
    """
    for name, expr in rules:
        df = df.withColumn(name, expr)
    return df
