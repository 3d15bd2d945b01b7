import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import empty_like
from tiers.llm import url_lists

T0 = dt.datetime(2024, 1, 1)
CAPTURE = "capture_id bigint, url string, fetched_at timestamp"
EVENT = "list string, kind string, pattern string, at timestamp, action string"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


@pytest.mark.parametrize("url,host,address", [
    ("http://WWW.Example.com:80/a/b/?q=1#x", "www.example.com", "www.example.com/a/b"),
    ("https://u:p@a.b.c./", "a.b.c", "a.b.c"), ("ftp://h", "h", "h"), ("no url", "", ""), ("", "", ""), (None, "", ""),
    ("http:///path", "", "")])
def test_parts_of_a_url(spark, url, host, address):
    df = spark.createDataFrame([(url,)], "u string")
    assert tuple(df.select(url_lists.host(F.col("u")), url_lists.address(F.col("u"))).first()) == (host, address)


def test_domains(spark):
    df = spark.createDataFrame([("a.b.example.org",), ("localhost",), ("",)], "h string")
    assert [r[0] for r in df.select(url_lists.domains(F.col("h"))).collect()] == [
        ["a.b.example.org", "b.example.org", "example.org"], ["localhost"], []]


def plain(captures, events):
    """For every capture and pattern the last event up to the fetch decides."""
    out = []
    for cid, url, when in captures:
        hits = []
        for key in {(e[0], e[1], e[2]) for e in events if None not in e}:
            name, kind, pattern = key
            h = (url or "").split("://")[-1].split("/")[0] if "://" in (url or "") else ""
            a = (url or "").split("://")[-1].rstrip("/")
            parts = h.split(".")
            doms = [".".join(parts[i:]) for i in range(max(1, len(parts) - 1))] if h else []
            if when is None or (pattern not in doms if kind == "domain" else pattern != a or not h):
                continue
            past = [(e[3], e[4] == "remove") for e in events if None not in e and e[:3] == key and e[3] <= when]
            if past and not max(past)[1]:
                start = max(t for t, _ in past)
                hits.append((name, pattern, start))
        best = min(((-len(p), p) for _, p, _ in hits), default=(0, None))[1]
        out.append((cid, len(hits), ",".join(sorted({n for n, _, _ in hits})), best,
                    min((s for _, p, s in hits if p == best), default=None), bool(hits)))
    return sorted(out, key=str)


@pytest.mark.parametrize("few", [0, 3, 1000])
def test_against_plain_as_of(spark, monkeypatch, few):
    monkeypatch.setattr(url_lists, "FEW", few)
    rng = random.Random(few)
    hosts = ["a.x.org", "b.x.org", "x.org", "q.net", "w.q.net"]
    events = [(rng.choice("LM"), *rng.choice([("domain", rng.choice(hosts)), ("url", rng.choice(hosts) + "/p")]),
               at(rng.randrange(24 * 12)), rng.choice(["add", "add", "remove"])) for _ in range(250)]
    events += events[:20] + [(None, "domain", "x.org", at(1), "add"), ("L", "domain", "x.org", None, "add")]
    captures = [(i, f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/p', '/p/', '/z'])}", at(rng.randrange(24 * 14)))
                for i in range(150)]
    captures += [(900, None, at(5)), (901, "http://x.org", None), (902, "junk", at(5)), (903, "http://x.org", at(300))] * 2
    got = url_lists.judge(spark.createDataFrame(captures, CAPTURE), spark.createDataFrame(events, EVENT)).collect()
    assert sorted(((r.capture_id, r.n_active, r.lists, r.pattern, r.active_since, r.blocked) for r in got), key=str) \
        == plain(captures, events)


def test_empty_tables_and_clashing_columns(spark):
    captures = spark.createDataFrame([(1, "http://x.org", at(1))], CAPTURE)
    none = empty_like(spark, EVENT)
    assert [r.blocked for r in url_lists.judge(captures, none).collect()] == [False]
    assert url_lists.judge(empty_like(spark, CAPTURE), none).count() == 0
    more = captures.withColumn("list", F.lit(1)).withColumn("pattern", F.lit(2))
    assert url_lists.judge(more.select("*", F.lit("u").alias("URL")), none).count() == 1


def test_plan_has_no_python(spark):
    captures = spark.createDataFrame([(1, "http://x.org", at(1))], CAPTURE)
    events = spark.createDataFrame([("L", "domain", "x.org", at(0), "add")], EVENT)
    plan = url_lists.judge(captures, events)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
