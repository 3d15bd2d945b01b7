"""Data-quality checks as DataFrames.

The reference checked its tables by eye with ad-hoc SQL cells. Here each
check is a lazy DataFrame: one pass, aggregated on the executors, with a
small result for the caller to show, assert or store.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def count_all(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """``SELECT count(*)`` as a one-row table (A1, A2)."""
    return df.agg(F.count(F.lit(1)).alias(name))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column in one pass, long form ``(column_name, n_null)`` (A3).

    One aggregate over all columns (partial sums per task), then a tiny
    unpivot of the single result row.
    """
    cols = list(cols) if cols else list(df.columns)
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    wide = wide.select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "n_null")


def find(df: DataFrame, cond: Column | None = None, **equals) -> DataFrame:
    """Rows matching a condition and/or column equalities.

    Filters reach the Parquet scan as pushed predicates.
    """
    parts = [F.col(k) == F.lit(v) if v is not None else F.col(k).isNull()
             for k, v in equals.items()]
    if cond is not None:
        parts.append(cond)
    if not parts:
        return df
    return df.filter(reduce(lambda a, b: a & b, parts))


def sample(df: DataFrame, n: int, order_by: Sequence[str | Column]) -> DataFrame:
    """A repeatable sample: the first ``n`` rows by ``order_by`` (K8, L1).

    Planned as a top-k (TakeOrderedAndProject): each task keeps ``n`` rows,
    so nothing grows with the table.
    """
    return df.orderBy(*order_by).limit(n)


def unique_key(df: DataFrame, keys) -> DataFrame:
    """Keys that are not unique, with their row count.

    Empty result = the key is unique. Partial aggregation before the shuffle.
    """
    keys = _names(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def orphans(left: DataFrame, right: DataFrame, left_on, right_on=None) -> DataFrame:
    """Rows of ``left`` whose key has no match in ``right``.

    A left anti join; a NULL key is an orphan too, as in the left join. The
    right side is cut to its distinct keys first (partial aggregation), so a
    right key held by a third of all rows is one row per task before the
    shuffle; an anti join gives the same rows either way.
    """
    left_on = _names(left_on)
    right_on = _names(right_on) if right_on is not None else left_on
    alias = [f"__rk{i}" for i in range(len(right_on))]
    keys = right.select(*[F.col(r).alias(a) for r, a in zip(right_on, alias)]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(lk) == F.col(a) for lk, a in zip(left_on, alias)])
    return left.join(keys, cond, "left_anti")


def reconcile(stages: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row counts of named stages side by side, ``(stage, n_rows)``.

    Shows rows lost by key checks and dedup, or gained by join fan-out.
    Each stage is counted by its own aggregate; results are unioned.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
             for name, df in stages]
    return reduce(DataFrame.unionByName, parts)


def count_where(df: DataFrame, conditions: Mapping[str, Column], label: str = "stage") -> DataFrame:
    """Rows meeting each named condition, all in one pass: ``(label, n_rows)``.

    E.g. rows read and rows with all keys in one scan, instead of one job per
    count.
    """
    wide = df.agg(*[F.count_if(cond).alias(name) for name, cond in conditions.items()])
    return wide.unpivot([], list(conditions), label, "n_rows")


def parse_losses(df: DataFrame, parsed: Mapping[str, Column]) -> DataFrame:
    """Per column, values present before a parse and NULL after it: ``(column_name, n_lost)``.

    ``parsed`` maps a raw column to the expression that parses it; one
    aggregate over ``df``, no join.
    """
    wide = df.agg(*[F.count_if(F.col(c).isNotNull() & e.isNull()).alias(c) for c, e in parsed.items()])
    return wide.unpivot([], list(parsed), "column_name", "n_lost")
