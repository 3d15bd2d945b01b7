"""Column rules: every function returns a built-in Spark Column expression."""

from tiers.functions.audit import base_name, display_path, source_file, stamp
from tiers.functions.parse import money, to_date, to_decimal, to_int
from tiers.functions.text import (by_prefix, by_value, code, folded, initial, key_prefix,
                                  key_suffix, remove, replace, strip_prefix, title, trimmed)

__all__ = [
    "base_name", "by_prefix", "by_value", "code", "display_path", "folded", "initial",
    "key_prefix", "key_suffix", "money", "remove", "replace", "source_file", "stamp",
    "strip_prefix", "title", "to_date", "to_decimal", "to_int", "trimmed",
]
