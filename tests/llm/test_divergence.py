"""Source divergence: the row accumulation against sums over every kept term."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import ODD_TEXTS, empty_like
from tiers.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def brute(rows, top=200):
    """Both reports from (text, lang, source) rows, term by term."""
    n, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(UPPER) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        n.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    kept = {lang: [t for (x, t), c in docs.items() if x == lang and c >= 3] for lang, _ in groups}

    def shares(count, terms):
        total = sum(count(t) for t in terms)
        return {t: 1 + 10**9 * (count(t) + 1) // (total + len(terms)) for t in terms}
    p = {(lang, s): shares(lambda t, lang=lang, s=s: n[lang, s, t], kept[lang]) for lang, s in groups}
    q = {lang: shares(lambda t, lang=lang: sum(n[lang, s, t] for x, s in groups if x == lang), kept[lang]) for lang in kept}
    out = []
    for lang, s in groups:
        pairs = [(-sum((p[lang, s][t] - p[lang, o][t]) ** 2 // p[lang, o][t] for t in kept[lang]), o.encode(), o)
                 for x, o in groups if x == lang and o != s]
        terms = [(-((p[lang, s][t] - q[lang][t]) ** 2 // q[lang][t]), t.encode(), t) for t in kept[lang]
                 if n[lang, s, t] and p[lang, s][t] > q[lang][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, s, part, item, -value, i + 1) for i, (value, _, item) in enumerate(found)]
    return sorted(out)


def both(df, top=200):
    audit = divergence.Audit(df)
    return sorted((r.lang, r.source, part, r.item, r.value, r.rank)
                  for part, found in (("pair", audit.pairs()), ("term", audit.terms(top))) for r in found.collect())


def texts(seed, n):
    rng = random.Random(seed)
    vocab = ["Ab", "ab", "été", "ÉTÉ", "x1y", "don't", "ẞ", "日本", *(f"w{chr(97 + i)}" for i in range(20))]
    return [(" ".join(rng.choices(vocab, weights=range(len(vocab), 0, -1), k=rng.randrange(30))),
             rng.choice(["en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "c", None, "", "é"])) for _ in range(n)]


def test_against_all_terms_of_all_pairs(spark):
    rows = texts(1, 150) + [(t, "en", "odd") for t in ODD_TEXTS] + [("only here", "xx", "a"), (None, "xx", "b"), ("", "yy", "z")]
    df = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], SCHEMA)
    assert both(df) == brute(rows)
    assert both(df, top=3) == brute(rows, top=3)
    assert both(df.union(df)) == brute(rows + rows)  # a repeated row is a document of its own
    assert both(df.toDF("doc_id", "text", "lang", "source", "SOURCE")) == brute(rows)


def test_empty_table(spark):
    assert both(empty_like(spark, SCHEMA)) == []


@pytest.mark.parametrize("block, scatter, peers, entries", [(1, 1, 1, 1), (7, 3, 2, 5)])
def test_blocks_accumulators_and_flushes_of_any_size(spark, monkeypatch, block, scatter, peers, entries):
    rows = texts(2, 60)
    for name, value in (("BLOCK", block), ("SCATTER", scatter), ("PEERS", peers), ("ENTRIES", entries)):
        monkeypatch.setattr(divergence, name, value)
    batch = pa.RecordBatch.from_pydict({
        "lang": ["e"] * 7, "term": list("aabbbcd"), "source": list("xyxyzxz"),
        "p": np.arange(5, 12), "p0": np.full(7, 2)})
    got = Counter()
    for out in divergence._scatter(batch.slice(i, 1) for i in range(7)):
        for lang, s, item, value in zip(*(c.to_pylist() for c in out.columns)):
            got[s, item] += value
    p = {("x", "a"): 5, ("y", "a"): 6, ("x", "b"): 7, ("y", "b"): 8, ("z", "b"): 9, ("x", "c"): 10, ("z", "d"): 11}
    f = lambda a, b: (a - b) ** 2 // b
    want = Counter()
    for (s, t), a in p.items():
        for (o, u), b in p.items():
            if t == u and s != o:
                want[s, o] += f(a, b) - f(a, 2) - f(2, b) + f(2, 2)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    df = spark.createDataFrame([(i, t, lang, s, 0) for i, (t, lang, s) in enumerate(rows)], SCHEMA)
    assert both(df) == brute(rows)


def test_large_counts_stay_exact(spark):
    n = spark.createDataFrame([(8_999_999_999_999, 9_100_000_000_000_000, 77)], "n bigint, total bigint, v bigint")
    assert n.select(divergence.share("n", "total", "v")).first()[0] == 1 + 10**9 * 9_000_000_000_000 // (9_100_000_000_000_077)
    assert n.select(divergence.share("n", "0", "0")).first()[0] == 1
