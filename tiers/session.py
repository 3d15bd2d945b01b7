"""Session helpers.

The library never builds its own cluster settings into operators: it reads
what the session says. ``get_session`` is for scripts and tests on one host;
on a cluster the caller's session is passed in unchanged.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the layered jobs rely on. AQE re-plans joins and coalesces
# partitions from runtime sizes; skew-join splitting keeps a hot key from
# landing in one task.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tiers", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the job defaults.

    ``spark.checkpoint.dir`` names the shared folder for staging and lineage cuts on a
    cluster; where nothing configured it, a local master gets a folder of its own.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    _ensure_checkpoint_dir(spark)
    return spark


#: The folder chosen for an application that names none, by application id: a running
#: session does not let ``spark.checkpoint.dir`` be set.
_chosen: dict[str, str] = {}


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not conf.get("spark.master", "local").startswith("local") or "local-cluster" in conf.get("spark.master", ""):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = _chosen.setdefault(spark.sparkContext.applicationId,
                                  os.path.join(os.environ.get("TMPDIR", "/tmp"), "tiers-checkpoints"))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A folder under the shared checkpoint directory.

    Used for staging files and cut lineage; never a machine-local temp folder,
    because every executor (and a restarted one) must see it.
    """
    base = _ensure_checkpoint_dir(spark).rstrip("/")
    sub = "/".join(p.strip("/") for p in parts if p)
    path = f"{base}/tiers/{sub}" if sub else f"{base}/tiers"
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path


def conf_bytes(spark: SparkSession, key: str, default: str) -> int:
    """A size setting of the session in bytes ('64m', '128MB', '134217728')."""
    return conf_size(spark.conf.get(key, default))


def conf_size(text: str) -> int:
    s = text.strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(float(s[:-1]) * units[s[-1]]) if s and s[-1] in units else int(s)


def size_shuffle_partitions(spark: SparkSession, *dfs) -> int:
    """Raise ``spark.sql.shuffle.partitions`` so the largest input fits.

    AQE merges small shuffle partitions but never splits one, so the count a
    job starts from must cover its biggest input: estimated input bytes over
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` (the size AQE then
    aims at). Only ever raised, never lowered below what the session has.
    Estimates come from the optimizer (file sizes), no job runs. Returns the
    count in force.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    target = conf_bytes(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    biggest = 0
    for df in dfs:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        biggest = max(biggest, int(str(stats.sizeInBytes())))
    needed = math.ceil(biggest / max(target, 1))
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
        return needed
    return current


@contextmanager
def shuffle_partitions_for(spark: SparkSession, *dfs) -> Iterator[int]:
    """``size_shuffle_partitions`` for the jobs inside the block; the previous
    setting is restored afterwards, so later jobs of the session are unaffected."""
    before = spark.conf.get("spark.sql.shuffle.partitions", None)
    try:
        yield size_shuffle_partitions(spark, *dfs)
    finally:
        if before is None:
            spark.conf.unset("spark.sql.shuffle.partitions")
        else:
            spark.conf.set("spark.sql.shuffle.partitions", before)


@contextmanager
def aqe_broadcast(spark: SparkSession, size: str) -> Iterator[None]:
    """Let AQE broadcast join sides that it has measured at up to ``size``, for the block.

    Only raised, never lowered below what the session has, and left alone where the
    session has broadcasts turned off. Static plans are not touched: their
    sizes are estimates.
    """
    key, static = "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key, None)
    now = before or spark.conf.get(static, "10485760")
    off = now.strip().startswith("-")
    try:
        if not off and conf_bytes(spark, key if before else static, "10485760") < conf_size(size):
            spark.conf.set(key, size)
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def label_jobs(spark: SparkSession, layer: str, table: str) -> Iterator[None]:
    """Tag the calling thread's jobs with the table they build, for the block.

    The scheduler pool gives each table of a layer, run from its own
    thread, a fair share of the executors when the cluster schedules FAIR
    (under FIFO the property is ignored); the description names the table
    in the event log. The thread's previous values are restored afterwards.
    """
    sc = spark.sparkContext
    keys = ("spark.scheduler.pool", "spark.job.description")
    before = {k: sc.getLocalProperty(k) for k in keys}
    sc.setLocalProperty("spark.scheduler.pool", f"{layer}.{table}")
    sc.setJobDescription(f"{layer} {table}")
    try:
        yield
    finally:
        for k, v in before.items():
            sc.setLocalProperty(k, v)
