"""Table operators: cleaning, modelling and checks. All take and return DataFrames."""

from tiers.operators.checks import (count_all, count_where, find, null_counts,
                                    orphans, parse_losses, reconcile, sample, unique_key)
from tiers.operators.clean import apply_rules, dedupe, fill_default, require_keys, with_stamp
from tiers.operators.layout import needs_spread, spread
from tiers.operators.model import (bounded_broadcast, check_key_types, duplicate_keys, lookup,
                                   project)

__all__ = [
    "apply_rules", "bounded_broadcast", "check_key_types", "count_all", "count_where", "dedupe",
    "duplicate_keys", "fill_default", "find", "lookup", "needs_spread", "null_counts",
    "orphans", "parse_losses", "project", "reconcile", "require_keys", "sample", "spread", "unique_key", "with_stamp",
]
