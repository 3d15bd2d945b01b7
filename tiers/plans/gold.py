"""Compile a gold spec into one lazy plan.

``build`` is the planned form: checked lookups, multiplicity joins where no
right column is used. ``build_plain`` is
the reference's form (chained ``join(..., "left")`` + ``select``), kept for
timing comparisons; both return the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tiers.functions.audit import stamp as now
from tiers.operators.model import check_key_types, lookup, project, repeat_rows
from tiers.plans.specs import GOLD, GOLD_SPECS, GoldSpec


def build(spec: GoldSpec | str, tables: Mapping[str, DataFrame], stamp: bool = True,
          on_duplicate: str = "allow", broadcast_max_rows: int | None = None,
          with_product_code: bool = False) -> DataFrame:
    """Silver tables (by name) -> one gold table.

    ``on_duplicate='allow'`` is the reference's fan-out (T10); ``dedupe``
    keeps one right row per key; ``error`` raises on a repeated right key.
    ``with_product_code`` adds the short product key to ``dim_product`` so
    the star can join on it (T9).
    """
    spec = GOLD_SPECS[spec] if isinstance(spec, str) else spec
    df = tables[spec.base]
    base_cols = set(df.columns)
    # Consecutive lookups that carry no column only repeat rows: they are
    # planned together, with one explode for all of them (model.repeat_rows).
    pending: list = []

    def flush(df: DataFrame) -> DataFrame:
        if pending:
            df = repeat_rows(df, list(pending))
            pending.clear()
        return df

    for lk in spec.lookups:
        right = tables[lk.table]
        if not lk.keep and on_duplicate == "allow":
            check_key_types(df, right, lk.left_on, lk.right_on)
            pending.append((right, lk.left_on, lk.right_on))
            continue
        df = flush(df)
        df = lookup(df, right, lk.left_on, lk.right_on, keep=lk.keep,
                    on_duplicate=on_duplicate, broadcast_max_rows=broadcast_max_rows)
    df = flush(df)
    cols = list(spec.columns)
    if with_product_code and spec.name == "dim_product" and "prd_id" in base_cols:
        cols.append(("product_code", "prd_id"))
    if stamp:
        cols.append((GOLD, now()))
    return project(df, cols)


def build_plain(spec: GoldSpec | str, tables: Mapping[str, DataFrame], stamp: bool = True) -> DataFrame:
    """The reference's form: chained left joins, then select."""
    spec = GOLD_SPECS[spec] if isinstance(spec, str) else spec
    df = tables[spec.base]
    for lk in spec.lookups:
        right = tables[lk.table]
        cond = None
        for lc, rc in zip(lk.left_on, lk.right_on):
            c = df[lc] == right[rc]
            cond = c if cond is None else cond & c
        df = df.join(right, cond, "left")
    cols = [df[src].alias(dst) for dst, src in spec.columns]
    if stamp:
        cols.append(now().alias(GOLD))
    return df.select(*cols)
