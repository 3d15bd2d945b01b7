"""Input layout: spread the rows of a scan that cannot use the cluster's cores.

A Parquet file is split by row groups, so a table stored as a few files with
one row group each is scanned by a few tasks, whatever the cluster size. All
work up to the first shuffle (joins with broadcast sides, column rules, the
map side of a dedup) then runs on those few cores. Such a scan can be spread
once by a hash of a row key, so every later narrow step runs on all cores.

Nothing does so by itself: a caller that knows its table is stored in a handful
of files asks for it, and only a scan of at most ``FEW_TASKS`` tasks is spread,
so a table of more than a few files or of a gigabyte is never shuffled for it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tiers.operators.model import estimated_bytes
from tiers.session import conf_bytes


# A scan with more tasks than this is never spread.
FEW_TASKS = 8


def _max_partition_bytes(df: DataFrame) -> int:
    return conf_bytes(df.sparkSession, "spark.sql.files.maxPartitionBytes", "128m")


def needs_spread(df: DataFrame, cores: int | None = None) -> bool:
    """True if the scan behind ``df`` yields at most ``FEW_TASKS`` tasks, and at most half
    as many as ``cores``.

    A scan gets about one task per file, or per
    ``spark.sql.files.maxPartitionBytes`` of a large file, whichever is more
    (fewer when files hold one row group each). Only a wide gap is worth a
    shuffle of the scanned rows. Decided from the optimizer's size estimate and,
    for small inputs only, the number of files; no job runs.
    """
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    most = min(FEW_TASKS, cores // 2)
    # size first: a large table is decided without a file list
    by_bytes = math.ceil(estimated_bytes(df) / _max_partition_bytes(df))
    if by_bytes > most:
        return False
    files = len(df._jdf.inputFiles())
    return 0 < files and max(files, by_bytes) <= most


def spread(df: DataFrame, keys: Sequence[str], cores: int | None = None) -> DataFrame:
    """Hash-repartition ``df`` over the cluster's cores if its scan cannot use them.

    ``keys`` should identify a row (a primary key), so that no key value -
    however hot - lands in one task; a hash partitioning is deterministic, so
    a retried task gets the same rows (no pre-sort as for round-robin). Column
    pruning and pushed filters still reach the scan below the exchange.
    """
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    if not needs_spread(df, cores):
        return df
    return df.repartition(cores, *keys)
