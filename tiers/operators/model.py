"""Star-model operators: checked lookup joins and projection.

A lookup is a left outer equi-join of a table onto a reference table.
Three properties are checked or made explicit instead of being left to chance:

* key types must agree (trap T17: a string/int key pair is cast to BIGINT
  and fails under ANSI); integral types of different width are widened, as
  CSV inference gives them per file;
* what happens when the right key repeats (``on_duplicate``): ``allow``
  keeps the reference's fan-out, ``dedupe`` keeps one right row per key,
  ``error`` raises;
* a side is broadcast by the planner and AQE from byte sizes; this module
  only hints a broadcast when the caller names a bound in rows and bytes.

Building a join runs no job, except for ``on_duplicate='error'``, a caller's
broadcast bound, and the hot-key check of a right side large enough to hold one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.operators.clean import dedupe
from tiers.session import conf_bytes, shared_dir

_MULT = "__copies"

# A right key with more rows than this is split over salts in a shuffle join.
HOT_KEY_ROWS = 1_000_000
# Copies one array holds at most when rows are repeated.
PIECE = 1024

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def check_key_types(left: DataFrame, right: DataFrame, left_on, right_on) -> None:
    """Raise unless every key pair has one type, or two integral ones (which widen without loss)."""
    lt = {f.name: f.dataType for f in left.schema.fields}
    rt = {f.name: f.dataType for f in right.schema.fields}
    for lk, rk in zip(_names(left_on), _names(right_on)):
        if lk not in lt or rk not in rt:
            raise ValueError(f"lookup key missing: {lk!r} / {rk!r}")
        if lt[lk] != rt[rk] and not (isinstance(lt[lk], _INTEGRAL) and isinstance(rt[rk], _INTEGRAL)):
            raise TypeError(f"lookup key types differ: {lk} {lt[lk].simpleString()} vs "
                            f"{rk} {rt[rk].simpleString()}; cast one side explicitly")


def bounded_broadcast(df: DataFrame, max_rows: int | None, max_bytes: int = 256 << 20) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows and reads at most ``max_bytes``.

    The row check is a bounded count job (each task stops at the bound, and only
    counts reach the driver); beyond a bound the side is left to the planner.
    """
    if max_rows is None or input_bytes(df) > max_bytes:
        return df
    n = df.limit(max_rows + 1).agg(F.count(F.lit(1))).first()[0]
    return F.broadcast(df) if n <= max_rows else df


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a plan (from file sizes, no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def input_bytes(df: DataFrame) -> int:
    """Bytes the plan reads: the optimizer's sizes of its leaves (scans), no job.

    Unlike ``estimated_bytes`` this does not grow through joins, whose size
    the optimizer bounds by the product of their sides when it has no
    statistics.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length()))


def _broadcast_limit(df: DataFrame) -> int:
    """The planner's broadcast threshold in bytes ('10MB' or '10485760'; -1 = off)."""
    return conf_bytes(df.sparkSession, "spark.sql.autoBroadcastJoinThreshold", "10485760")


def _planner_broadcasts(df: DataFrame) -> bool:
    return 0 <= estimated_bytes(df) <= _broadcast_limit(df)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their count (partial-aggregated)."""
    keys = _names(keys)
    return (df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
              .groupBy(*keys).agg(F.count(F.lit(1)).alias(_MULT))
              .filter(F.col(_MULT) > 1))


def _pieces(counts: DataFrame, n: str) -> DataFrame:
    """Rows with a count ``n`` as rows with counts of at most ``PIECE`` that add up to it.

    Cut by 2^30, 2^20 and 2^10 in turn, so that no array has more than ``PIECE``
    elements for counts up to 2^40 (beyond, the first cut has more).
    """
    for size in (PIECE ** 3, PIECE ** 2, PIECE):
        i = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({n} - 1) div {size}L")))
        counts = counts.withColumn("__i", i)
        counts = counts.withColumn(n, F.least(F.lit(size).cast("long"), F.col(n) - F.col("__i") * F.lit(size))).drop("__i")
    return counts


def _copies(n: Column) -> Column:
    """One row per copy; ``n`` is at most ``PIECE``."""
    return F.explode(F.array_repeat(F.lit(True), F.coalesce(n, F.lit(1)).cast("int")))


def multiplicities(left: DataFrame, sides: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]],
                   pieces: bool = False) -> tuple[DataFrame, list[str]]:
    """``left`` with one count column per side: how many right rows match (NULL: at most one).

    Each left row stands for the product of its counts; multiply them as decimals.
    With ``pieces`` a count is cut into several rows with at most ``PIECE`` each.
    """
    out, columns = left, []
    for i, (right, left_on, right_on) in enumerate(sides):
        left_on, right_on = _names(left_on), _names(right_on)
        check_key_types(left, right, left_on, right_on)
        alias = [f"__rk{i}_{j}" for j in range(len(right_on))]
        copies = f"{_MULT}{i}"
        mult = duplicate_keys(right, right_on).select(
            *[F.col(rk).alias(a) for rk, a in zip(right_on, alias)], F.col(_MULT).alias(copies))
        mult = _pieces(mult, copies) if pieces else mult
        # a stage of its own: AQE then knows how few keys are left and can broadcast them
        mult = mult.hint("rebalance")
        cond = reduce(lambda a, b: a & b, [F.col(lk) == F.col(a) for lk, a in zip(left_on, alias)])
        out = out.join(mult, cond, "left").drop(*alias)
        columns.append(copies)
    return out, columns


def repeat_rows(left: DataFrame, sides: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """The rows of left joins onto every side that carry no right column.

    Such joins can only repeat left rows: each by the number of matching
    right rows, one if none. Each side shrinks to the keys that occur more
    than once, with their count (partial-aggregated, a small table whatever the
    side's width); a large count is cut into pieces of at most ``PIECE`` copies
    before the join, and each piece is repeated after it. So no number is the
    product of two counts and no array holds a fan-out: exact at any multiplicity.
    Lazy; the planner and AQE decide by bytes how the small sides are joined.
    """
    out, columns = multiplicities(left, sides, pieces=True)
    for c in columns:
        out = out.withColumn(c, _copies(F.col(c)))
    return out.select(*left.columns)


def lookup(left: DataFrame, right: DataFrame, left_on, right_on=None,
           keep: Sequence[str] | Mapping[str, str] = (), on_duplicate: str = "allow",
           broadcast_max_rows: int | None = None,
           hot_key_rows: int | None = HOT_KEY_ROWS) -> DataFrame:
    """Left outer equi-join of ``left`` onto ``right``.

    ``keep`` names the right columns to carry (a mapping renames them).
    Unmatched rows get NULLs, no "unknown member" row (T12).

    When ``keep`` is empty the join can only repeat left rows (T10). It is
    then planned as a multiplicity join: the right side shrinks to the keys
    that occur more than once with their count, and each left row is
    repeated that many times - the same rows as the full join, without
    moving any right-side column. With ``on_duplicate`` ``dedupe`` or
    ``error`` such a join changes nothing and is removed.

    When columns are kept and the right side is too large to broadcast, right
    keys with more than ``hot_key_rows`` rows are split over salts (see
    ``_salted_join``); ``None`` turns this off. The keys are counted only if the
    side reads at least a byte for each row of such a key.
    """
    left_on = _names(left_on)
    right_on = _names(right_on) if right_on is not None else list(left_on)
    if len(left_on) != len(right_on):
        raise ValueError("left_on and right_on differ in length")
    check_key_types(left, right, left_on, right_on)
    keep_map = dict(keep) if isinstance(keep, Mapping) else {c: c for c in keep}
    clash = [dst for dst in keep_map.values() if dst in left.columns]
    if clash:
        raise ValueError(f"kept columns already in the left table: {clash}; rename them")
    if on_duplicate not in ("allow", "dedupe", "error"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")

    if on_duplicate == "error":
        dups = duplicate_keys(right, right_on).limit(1).count()
        if dups:
            raise ValueError(f"lookup keys {right_on} are not unique in the right table")

    alias = [f"__rk{i}" for i in range(len(right_on))]
    cond = reduce(lambda a, b: a & b, [F.col(lk) == F.col(a) for lk, a in zip(left_on, alias)])

    if not keep_map:
        if on_duplicate != "allow":
            return left
        return repeat_rows(left, [(right, left_on, right_on)])

    src = right.select(*[F.col(rk).alias(a) for rk, a in zip(right_on, alias)],
                       *[F.col(s).alias(d) for s, d in keep_map.items()])
    src = src.filter(reduce(lambda a, b: a & b, [F.col(a).isNotNull() for a in alias]))
    if on_duplicate == "dedupe":
        src = dedupe(src, alias)
    elif (hot_key_rows is not None and broadcast_max_rows is None and not _planner_broadcasts(src)
          and input_bytes(src) > max(hot_key_rows, _broadcast_limit(src))):
        # a side that reads more than AQE would broadcast, and a byte per row of a hot key
        salted = _salted_join(left, src, left_on, alias, hot_key_rows)
        if salted is not None:
            return salted
    joined = left.join(bounded_broadcast(src, broadcast_max_rows), cond, "left")
    return joined.drop(*alias)


def _salted_join(left: DataFrame, src: DataFrame, left_on: list[str], alias: list[str],
                 hot_rows: int) -> DataFrame | None:
    """Left join of ``left`` onto ``src`` with hot right keys split over salts.

    A right key with more than ``hot_rows`` rows (a group of re-sent copies,
    say) would put all its rows, and its whole fan-out, in one task: AQE
    splits the left side of a left join, never the right. For such a key:

    * identical right rows are collapsed to one row with a count (partial
      aggregation, so copies combine before the shuffle);
    * each collapsed row is cut into at most ``s = ceil(n / hot_rows)``
      shares with consecutive salts (from a hash of the row), so distinct
      rows and copies alike spread over ``s`` tasks;
    * each left row of the key is repeated once per salt and joined on
      (key, salt); a repeat that meets no share is dropped (a hot key always
      has right rows), and each share is expanded back to its copies.

    The output rows are exactly those of the plain left join. Returns None
    when no key is hot, after one aggregation of the right keys.
    """
    path = shared_dir(src.sparkSession, "hot_keys")
    (src.groupBy(*alias).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_rows)
        .select(*alias, F.ceil(F.col("__n") / F.lit(hot_rows)).cast("int").alias("__s"))
        .write.parquet(path))      # right rows / hot_rows keys at most; sized by its files from here on
    hot = src.sparkSession.read.parquet(path)
    if hot.isEmpty():
        return None
    payload = [c for c in src.columns if c not in alias]
    salts = F.coalesce(F.col("__s"), F.lit(1))
    row_hash = F.xxhash64(*[F.col(c) for c in payload]) if payload else F.lit(0)
    right = _pieces(src.groupBy(*src.columns).agg(F.count(F.lit(1)).alias("__c"))
                .join(hot, alias, "left")
                .withColumn("__k", F.least(F.col("__c"), salts.cast("long")).cast("int"))
                .withColumn("__j", F.explode(F.sequence(F.lit(0), F.col("__k") - 1)))
                # reduce the hash first: hash + j could overflow a long (an error under ANSI)
                .withColumn("__rs", F.pmod(F.pmod(row_hash, salts) + F.col("__j"), salts).cast("int"))
                .withColumn("__rc", F.expr("__c div __k") + F.when(F.col("__j") < F.col("__c") % F.col("__k"), 1)
                                                            .otherwise(0))
                .drop("__s", "__c", "__k", "__j"), "__rc")
    hk = [f"__hk{i}" for i in range(len(alias))]
    hot_left = hot.select(*[F.col(a).alias(h) for a, h in zip(alias, hk)], F.col("__s").alias("__ln"))
    on_hot = reduce(lambda a, b: a & b, [F.col(lk) == F.col(h) for lk, h in zip(left_on, hk)])
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("__ln"), F.lit(1)) - 1)
    lefts = left.join(hot_left, on_hot, "left").withColumn("__ls", F.explode(repeats)).drop(*hk)
    cond = reduce(lambda a, b: a & b, [F.col(lk) == F.col(a) for lk, a in zip(left_on, alias)])
    joined = (lefts.join(right, cond & (F.col("__ls") == F.col("__rs")), "left")
                   .filter(F.col("__ln").isNull() | F.col("__rs").isNotNull()))
    return joined.withColumn("__rep", _copies(F.col("__rc"))).drop(*alias, "__ln", "__ls", "__rs", "__rc", "__rep")


def project(df: DataFrame, mapping: Mapping[str, str] | Sequence[tuple[str, str]]) -> DataFrame:
    """Select and rename: ``{output_name: input_column}`` in output order."""
    items = mapping.items() if isinstance(mapping, Mapping) else mapping
    return df.select(*[(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in items])
