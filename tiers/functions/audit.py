"""Audit columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stamp() -> Column:
    """The query's timestamp: one value per query, constant-folded (P5)."""
    return F.current_timestamp()


def source_file() -> Column:
    """Path of the file a row came from, from the hidden file metadata.

    The value is URI-encoded ('a%20b.csv', trap T14); ``display_path``
    decodes it for people.
    """
    return F.col("_metadata.file_path")


def display_path(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.url_decode(col)


def base_name(c) -> Column:
    """The last path element, decoded."""
    col = F.col(c) if isinstance(c, str) else c
    return F.url_decode(F.regexp_extract(col, r"([^/]+)$", 1))
