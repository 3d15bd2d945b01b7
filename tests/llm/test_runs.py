"""Periodic runs: the grammar's runs against a search of every period at every place."""

import hashlib
import random
import time
import zlib

import pytest

from __spark_entry__ import queries
from tests.llm.conftest import ODD_TEXTS, empty_like
from tiers.llm import runs

SF = "/root/testdata/sf0.001"


def brute(words):
    """All maximal stretches with a smallest period q and at least max(6, 4 q) words."""
    found, n = set(), len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(
                    all(words[x] == words[x + p] for x in range(i, i + size - p)) for p in range(1, q)):
                found.add((i, size, q))
            i = max(i + 1, j)
    return sorted(found)


def sequences(seed, n):
    rng = random.Random(seed)
    for _ in range(n):
        words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 50))]
        if rng.random() < .5:
            block = [rng.randrange(4) for _ in range(rng.randint(1, 8))]
            words = words + block * rng.randint(1, 8) + block[:rng.randint(0, 8)] + words[:rng.randint(0, 9)]
        yield (words * 5)[:200] if rng.random() < .3 else words


def test_against_every_period_at_every_place():
    for words in sequences(7, 1500):
        assert runs.find(words) == brute(words), words


def test_grammar_derives_the_text_and_no_pair_occurs_twice():
    for words in sequences(8, 300):
        number = {}
        w = [number.setdefault(x, len(number)) for x in words]
        g = runs.Grammar(w, len(number))

        def derive(s):
            if s < g.n_terminals:
                return [s]
            a, b, at = g.rules[s - g.n_terminals]
            out = derive(a) + derive(b)
            assert w[at:at + len(out)] == out and g.size[s] == len(out)
            return out
        assert [x for _, s in g.start for x in derive(s)] == w
        left = [s for _, s in g.start]
        pairs = list(zip(left, left[1:]))
        for p in set(pairs):  # overlapping occurrences (x x x) count once
            assert pairs.count(p) == 1 or p[0] == p[1]


def test_very_long_periodic_and_nearly_periodic_texts_in_linear_time():
    long = {"one word": [0] * 200_000, "a block": list(range(5_000)) * 40,
            "near squares": [x for i in range(200) for x in [0] * 500 + [i + 1]]}
    for name, words in long.items():
        t = time.perf_counter()
        found = runs.find(words)
        assert time.perf_counter() - t < 20, name
        assert found
    assert runs.find(long["one word"]) == [(0, 200_000, 1)]
    assert runs.find(long["a block"]) == [(0, 200_000, 5_000)]
    assert runs.find(long["near squares"]) == [(501 * i, 500, 1) for i in range(200)]


def test_odd_rows_and_clashing_columns(spark, documents, clashing, rows):
    texts = [*ODD_TEXTS, "la la la la la la", "la la la la la"]
    got = {r.doc_id: r for r in runs.detect(clashing(texts)).collect()}
    for i, text in enumerate(texts):
        words = runs.words_of((text or "").encode())
        assert got[i].n_words == len(words)
        assert [tuple(r) for r in got[i].runs] == ([(0, 30_000, 1)] if text == "word " * 30_000 else brute(words))
    assert got[len(texts) - 2].collapsed == "la" and got[len(texts) - 1].collapsed == "la la la la la"
    assert runs.detect(empty_like(spark, documents([]).schema)).count() == 0
    twice = documents([(1, "x x x x x x"), (1, "x x x x x x"), (None, "y")])
    assert runs.detect(twice).count() == 3


def expected(doc_id, text):
    """The contract, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    drop = {i for s, size, q in found for i in range(s + q, s + size)}
    sha = [hashlib.sha256(x).hexdigest() for x in (
        "".join(f"{s},{size},{q}\n" for s, size, q in found).encode(),
        b" ".join(x for i, x in enumerate(words) if i not in drop))]
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, *sha)


@pytest.mark.parametrize("table", [SF])
def test_query_against_the_contract(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet").select("doc_id", "text").collect()
    got = queries()["op13_periodic_runs"](spark, table).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    short = {r.doc_id: r for r in docs if len((r.text or "").split()) < 1500}
    assert got.count() == len(docs) and len(short) > 150
    assert {tuple(r) for r in got.collect() if r.doc_id in short} == {expected(r.doc_id, r.text) for r in short.values()}
    assert {t: c for t, c in got.dtypes}["n_runs"] == "bigint"
