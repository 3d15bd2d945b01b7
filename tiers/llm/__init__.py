"""Operators of a training-data pipeline: ten methods, one module each.

Nothing else in the library imports this subpackage. Rules that all of its
operators keep:

* Input columns are taken by name and position (``frame.take``), so extra
  columns, also ones with clashing names, never matter. A NULL text counts as
  the empty text. Rows are never dropped, capped or sampled unless the
  operator's result says so.
* An empty table gives an empty result of the same schema.
* Intermediate tables are written below ``spark.checkpoint.dir``.
"""
