"""URL filters by dated lists, as a temporal join.

A list says at which time a pattern was added or removed. Per pattern these
events become validity intervals; every capture is judged by the entries that
were active when it was fetched (an as-of join), so a page is neither judged
by a later entry nor by one that had been withdrawn.

Patterns: kind ``domain`` matches a host and its subdomains, kind ``url`` a whole
address without scheme, user, port, query, fragment and trailing slashes. Built
from column expressions and joins only.

Edge cases: NULL or malformed URLs have an empty host and match nothing, NULL
times neither; of events of one pattern at one time a removal wins; repeated
events count once; events with a NULL in pattern, kind, list, time or action are
ignored; repeated captures are all returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tiers.llm.frame import take, written

_SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*://"

#: Intervals of one pattern up to which captures meet all of them in the join; patterns
#: with more are cut by day, so that a capture meets those of its day. Shapes the work only.
FEW = 16

_KEY = ("list", "kind", "pattern")


def host(url: Column) -> Column:
    """The host of an absolute URL in lower case, without user, port and trailing dots; else ''."""
    h = F.regexp_extract(url, _SCHEME + "(?:[^/?#@]*@)?([^/?#:@]*)", 1)
    return F.coalesce(F.regexp_replace(F.lower(h), "[.]+$", ""), F.lit(""))


def address(url: Column) -> Column:
    """Host and path of a URL without trailing slashes; '' without a host."""
    path = F.regexp_replace(F.regexp_extract(url, _SCHEME + "[^/?#]*([^?#]*)", 1), "/+$", "")
    return F.when(host(url) != "", F.concat(host(url), path)).otherwise(F.lit(""))


def domains(name: Column) -> Column:
    """A host and the domains above it, without the top-level one."""
    parts = F.split(name, "[.]")
    n = F.size(parts)
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)),
                        lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))
    return F.when(name != "", above).otherwise(F.array().cast("array<string>"))


def intervals(events: DataFrame) -> DataFrame:
    """``list, kind, pattern, valid_from, valid_to``: when each entry was active (valid_to
    NULL: still is). ``events``: list, kind, pattern, at, action ('add' or 'remove').

    The next event of a pattern is looked up inside its day, and for a day's last
    event among the days' first ones: a pattern that holds a third of all events
    is spread over its days, and what remains per pattern is one row a day.
    """
    e = (take(events, *_KEY, "at", "action").dropna()
         .groupBy(*_KEY, "at").agg(F.max(F.col("action") == "remove").alias("removed"))
         .withColumn("day", F.to_date("at")))
    days = e.groupBy(*_KEY, "day").agg(F.min("at").alias("first"))
    days = days.withColumn("next_day", F.lead("first").over(W.partitionBy(*_KEY).orderBy("day"))).drop("first")
    inside = e.withColumn("next", F.lead("at").over(W.partitionBy(*_KEY, "day").orderBy("at")))
    return (inside.filter("not removed").join(days, [*_KEY, "day"])
            .select(*_KEY, F.col("at").alias("valid_from"), F.coalesce("next", "next_day").alias("valid_to")))


def judge(captures: DataFrame, events: DataFrame) -> DataFrame:
    """``capture_id, url, fetched_at, host, n_active, lists, pattern, active_since, blocked`` of
    every row of ``captures`` (capture_id, url, fetched_at).

    ``lists`` names the lists with an active entry in order, comma-separated ('' if
    none), ``pattern`` is the longest active pattern (of equals the smallest) and
    ``active_since`` its earliest start among the lists.
    """
    rows = take(captures, "capture_id", "url", "fetched_at")
    spans = written(intervals(events), "intervals")
    often = written(spans.groupBy("kind", "pattern").count().filter(F.col("count") > FEW).select("kind", "pattern"), "often")
    wanted = (rows.filter("url is not null and fetched_at is not null").select("url", "fetched_at").distinct()
              .withColumn("host", host(F.col("url"))).filter("host <> ''"))
    keyed = wanted.select("url", "fetched_at", F.explode(F.concat(
        F.transform(domains(F.col("host")), lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("pattern"))),
        F.array(F.struct(F.lit("url").alias("kind"), address(F.col("url")).alias("pattern"))))).alias("k")
    ).select("url", "fetched_at", "k.kind", "k.pattern")
    active = (F.col("fetched_at") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to")))
    few = spans.join(often, ["kind", "pattern"], "left_anti")
    hits = _asof(keyed, few, ["kind", "pattern"], active)
    # cut by day: a span that is still open ends with the last capture
    many = spans.join(often, ["kind", "pattern"])
    last_day = F.lit(rows.agg(F.to_date(F.max("fetched_at"))).first()[0]).cast("date")
    first_day = F.to_date("valid_from")
    many = many.withColumn("day", F.explode(F.when(
        first_day <= last_day, F.sequence(first_day, F.least(last_day, F.coalesce(F.to_date("valid_to"), last_day))))))
    hits = hits.unionAll(_asof(keyed.withColumn("day", F.to_date("fetched_at")), many, ["kind", "pattern", "day"], active))
    best = (hits.groupBy("url", "fetched_at").agg(
        F.count("*").alias("n_active"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("lists"),
        F.min(F.struct((-F.length("pattern")).alias("short"), "pattern", "valid_from")).alias("top")))
    best = written(best.select("url", "fetched_at", "n_active", "lists", "top.pattern",
                               F.col("top.valid_from").alias("active_since")), "verdicts")
    return (rows.join(best, ["url", "fetched_at"], "left")
            .select("capture_id", "url", "fetched_at", host(F.col("url")).alias("host"),
                    F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"),
                    F.coalesce("lists", F.lit("")).alias("lists"), "pattern", "active_since",
                    F.col("n_active").isNotNull().alias("blocked")))


def _asof(keyed: DataFrame, spans: DataFrame, on: list[str], active: Column) -> DataFrame:
    both = keyed.alias("c").join(spans.alias("s"), [F.col(f"c.{x}") == F.col(f"s.{x}") for x in on] + [active])
    return both.select("c.url", "c.fetched_at", "s.list", "s.pattern", "s.valid_from")
