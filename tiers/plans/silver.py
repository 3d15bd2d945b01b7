"""Compile a silver spec into one lazy plan."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tiers.operators.clean import apply_rules, dedupe, dedupe_counted, require_keys
from tiers.plans.specs import CLEANED, SILVER, SilverSpec


def build(df: DataFrame, spec: SilverSpec | str, strict: bool = False,
          dedupe_method: str = "aggregate", dedupe_after_rules: bool = False,
          stamp: bool = True, keep_source_id: bool = False) -> DataFrame:
    """Bronze rows -> silver rows.

    Steps: drop NULL keys (pushed to the scan), keep one row per dedup key
    (one shuffle), then the column rules (one Project).

    ``dedupe_after_rules`` moves the dedup after the key rewrites, so the
    final key is unique (the fix for trap T2); the default keeps the
    reference's order. ``stamp=False`` leaves out ``_cleaned_timestamp``.
    ``keep_source_id`` keeps a column a rule overwrites under a new name
    (``prd_info.prd_num``, trap T8).
    """
    spec = SILVER[spec] if isinstance(spec, str) else spec
    out = require_keys(df, spec.required)
    rules = [(name, rule(strict)) for name, rule in spec.rules if stamp or name != CLEANED]
    if keep_source_id and spec.source_id:
        rules.insert(0, (spec.source_id[1], F.col(spec.source_id[0])))
    order = list(spec.order_by) if spec.order_by else None
    if dedupe_after_rules:
        out = apply_rules(out, rules)
        return dedupe(out, spec.key or spec.dedupe_on, order, method=dedupe_method)
    out = dedupe(out, spec.dedupe_on, order, method=dedupe_method)
    return apply_rules(out, rules)


def build_counted(df: DataFrame, spec: SilverSpec | str, strict: bool = False, stamp: bool = True,
                  keep_source_id: bool = False) -> tuple[DataFrame, Observation]:
    """The rows of ``build`` and an observation of what became of its input.

    The action that writes the rows fills in ``rows_read``, ``no_key`` (a required
    column is NULL), ``repeated`` (dropped by the dedup), ``kept``, and
    ``lost_<column>`` for each column of the spec's ``parsed``: values there before
    the parse and NULL after it, among the rows kept. No scan is added. The
    counts are taken after the shuffle, in the stage that writes, where a task's
    figures enter once; a map task that runs again after a lost executor changes
    nothing. The key check is not pushed to the scan here, as its rows are counted.
    """
    spec = SILVER[spec] if isinstance(spec, str) else spec
    rules = [(name, rule(strict)) for name, rule in spec.rules if stamp or name != CLEANED]
    if keep_source_id and spec.source_id:
        rules.insert(0, (spec.source_id[1], F.col(spec.source_id[0])))
    out = dedupe_counted(df, spec.required, spec.dedupe_on, spec.order_by)
    kept = F.col("__keyed") > 0
    lenient = {name: rule(False) for name, rule in spec.rules if name in spec.parsed}
    observed = Observation(f"silver_{spec.name}_{uuid.uuid4().hex[:8]}")
    out = out.observe(
        observed, F.sum("__raw").alias("rows_read"), F.sum(F.col("__raw") - F.col("__keyed")).alias("no_key"),
        F.sum(F.when(kept, F.col("__keyed") - 1)).alias("repeated"), F.count_if(kept).alias("kept"),
        *[F.count_if(kept & F.col(c).isNotNull() & e.isNull()).alias(f"lost_{c}") for c, e in lenient.items()])
    return apply_rules(out.filter(kept).drop("__raw", "__keyed"), rules), observed
