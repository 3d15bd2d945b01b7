"""Text and key rules as Column expressions.

Every function takes a column name or Column and returns a Column built
from Spark built-ins only, so the rules stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c) -> Column:
    """Spaces removed on both sides (C1). Tabs and CRs are kept, as in Spark."""
    return F.trim(_c(c))


def title(c) -> Column:
    """Trimmed, first letter of each space-separated word upper, rest lower."""
    return F.initcap(F.trim(_c(c)))


def code(c) -> Column:
    """Trimmed and upper-cased."""
    return F.upper(F.trim(_c(c)))


def folded(c) -> Column:
    """Trimmed and lower-cased (C4)."""
    return F.lower(F.trim(_c(c)))


def initial(c, default: str | None = None) -> Column:
    """First letter of the trimmed text, upper-cased.

    With ``default`` a NULL input gives the default (C18); a blank input
    gives '' either way, because only NULL is tested (trap T7).
    """
    letter = F.upper(F.substring(F.trim(_c(c)), 1, 1))
    if default is None:
        return letter
    return F.when(_c(c).isNotNull(), letter).otherwise(F.lit(default))


def by_prefix(c, prefixes: Sequence[tuple[str, str]], default: str) -> Column:
    """Map by the prefix of the folded text, first match wins."""
    key = folded(c)
    out = None
    for prefix, value in prefixes:
        cond = key.startswith(prefix)
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def by_value(c, groups: Mapping[str, Iterable[str]], otherwise=None) -> Column:
    """Map members of each group to the group's value.

    Values in no group are kept as they are unless ``otherwise`` is given;
    NULL matches no group and stays NULL.
    """
    src = _c(c)
    out = None
    for value, members in groups.items():
        cond = src.isin(list(members))
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    rest = src if otherwise is None else F.lit(otherwise)
    return rest if out is None else out.otherwise(rest)


def key_prefix(c, n: int) -> Column:
    """The first ``n`` characters of a key."""
    return F.substring(_c(c), 1, n)


def key_suffix(c, pos: int) -> Column:
    """The key from 1-based position ``pos`` to its end."""
    return F.substring(_c(c), F.lit(pos), F.length(_c(c)))


def strip_prefix(c, n: int = 3, only_if: str | None = None) -> Column:
    """Drop the first ``n`` characters.

    The faithful rule cuts always, so a key without the prefix loses real
    characters (trap T6); ``only_if`` cuts only keys that start with it.
    """
    cut = F.substring(_c(c), F.lit(n + 1), F.length(_c(c)))
    if only_if is None:
        return cut
    return F.when(_c(c).startswith(only_if), cut).otherwise(_c(c))


def remove(c, pattern: str) -> Column:
    """Delete every match of a regular expression."""
    return F.regexp_replace(_c(c), pattern, "")


def replace(c, pattern: str, replacement: str) -> Column:
    """Replace every match of a regular expression."""
    return F.regexp_replace(_c(c), pattern, replacement)
