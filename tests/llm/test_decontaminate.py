import random
import re
import time
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, empty_like
from tiers.llm import decontaminate

WORD = re.compile(r"[0-9a-z\u0080-\U0010ffff]+")
ITEM = "item_id bigint, text string"


def words(text):
    return WORD.findall((text or "").lower())


def plain_leaks(docs, items):
    """Every (document, item) with a stretch on any diagonal that counts as an overlap."""
    out = set()
    for i, text in docs:
        d = words(text)
        for k, item in items:
            b = words(item)
            for shift in range(-len(b) + 1, len(d)):
                same = np.array([0 <= shift + j < len(d) and d[shift + j] == b[j] for j in range(len(b))])
                lo, hi = max(0, -shift), min(len(b), len(d) - shift)
                for a in range(lo, hi):
                    for z in range(a + min(13, len(b)), hi + 1):
                        if same[a] and same[z - 1] and same[a:z].sum() >= 0.8 * (z - a):
                            out.add((i, k))
    return out


@pytest.mark.parametrize("n,changed", [(13, 2), (15, 3), (20, 4)])
def test_no_placement_of_substitutions_escapes_the_masks(n, changed):
    windows = [{i + j for j, c in enumerate(m) if c == "1"} for m in decontaminate.MASKS for i in range(n - len(m) + 1)]
    for places in combinations(range(n), changed):
        assert any(w.isdisjoint(places) for w in windows)


@pytest.mark.parametrize("n", range(1, 13))
def test_no_placement_in_a_short_item_escapes_its_masks(n):
    windows = [{i + j for j, c in enumerate(m) if c == "1"} for m in decontaminate.short_masks(n) for i in range(n - len(m) + 1)]
    for places in combinations(range(1, n - 1), max(0, min(n - 2, n // 5))):
        assert any(w.isdisjoint(places) for w in windows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=40))
def test_longest_stretch(same):
    same = np.array(same)
    first, length, matched = decontaminate.best_stretch(same)
    want = max([0] + [b - a for a in range(len(same)) for b in range(a + 1, len(same) + 1)
                      if same[a] and same[b - 1] and same[a:b].sum() >= 0.8 * (b - a)])
    assert length == want and same[first:first + length].sum() == matched >= 0.8 * length


def test_against_brute_force(spark, documents):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(200)] + ["the", "of", "a"] * 20
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([*range(1, 13), *range(13, 31, 2)])]
    items += [(99, items[15][1]), (None, items[16][1])]
    docs = []
    for i in range(80):
        t = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 2:
            b = words(items[i // 2 % len(items)][1])
            if i % 3 == 0:
                b = b[:rng.randint((len(b) + 1) // 2, len(b))]
            for j in rng.sample(range(1, len(b) - 1), len(b) // 5 if len(b) > 4 else 0):
                b[j] = "swapped"
            at = rng.randrange(len(t) + 1)
            t[at:at] = [w.upper() + "," for w in b]
        docs.append((i, " ".join(t)))
    docs += [(1000 + i, t) for i, t in enumerate(ODD_TEXTS) if t is None or len(t) < 1000]
    got = decontaminate.overlaps(documents(docs), spark.createDataFrame(items, ITEM)).collect()
    found = {(r.doc_id, r.item_id) for r in got}
    truth = plain_leaks(docs, items)
    assert found == truth and len(found) == len(got)
    sizes = dict(items)
    assert len(truth) > 40 and {len(words(sizes[k])) for _, k in truth} > set(range(1, 13))
    assert {(i, 99) for i, k in truth if k == 15} <= found and (None in {k for _, k in truth})
    text = dict(docs)
    for r in got:  # the reported place is the place
        d, b = words(text[r.doc_id]), words(sizes[r.item_id])
        pairs = [(d[r.first_word + j], b[r.item_first_word + j]) for j in range(r.n_words)]
        assert sum(x == y for x, y in pairs) == r.n_matched >= 0.8 * r.n_words


def test_odd_rows(spark, documents, clashing):
    passage = " ".join(f"p{i}" for i in range(30))
    items = spark.createDataFrame([(3, passage), (2, passage), (None, "x " * 20), (4, None), (5, ""), (6, "too short")], ITEM)
    docs = documents([(1, passage), (1, passage), (None, passage), (2, None), (3, "long " * 50_000 + passage)])
    got = decontaminate.overlaps(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in got) == sorted((i, k) for i in ("1", "1", "3", "None") for k in (2, 3))
    assert [r.first_word for r in got if r.doc_id == 3] == [50_000] * 2
    assert [(r.doc_id, r.text) for r in decontaminate.clean(docs, items).collect()] == [(2, None)]
    assert decontaminate.overlaps(clashing([passage]), items).count() == 2  # both ids of the text
    assert decontaminate.overlaps(empty_like(spark, DOCUMENTS), items).count() == 0
    assert decontaminate.overlaps(docs, empty_like(spark, ITEM)).count() == 0


def test_no_item_and_no_column_is_lost(spark, documents, clashing):
    """NULL ids, equal texts and short items; ``clean`` takes the leaking documents out."""
    short, long = "Who wrote the Origin of Species?", " ".join(f"q{i}" for i in range(20))
    items = spark.createDataFrame([(None, long), (1, long), (2, long), (2, long), (3, short), (4, "why")], ITEM)
    docs = documents([(1, "he asked who wrote the origin of species again"), (2, f"a {long} z"), (3, "who wrote the origin"),
                      (4, "he wrote to say why")])
    got = sorted((r.doc_id, str(r.item_id)) for r in decontaminate.overlaps(docs, items).collect())
    assert got == [(1, "3"), (2, "1"), (2, "2"), (2, "None"), (4, "4")]
    assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [3]
    odd = clashing([long, "kept"])
    left = decontaminate.clean(odd, items)
    assert left.columns == odd.columns and [r[:2] for r in left.collect()] == [(1, "kept")]


def test_repeated_words_stay_linear(spark, documents):
    """Every diagonal of such a pair is hit; stretches of the document are verified, not the whole per diagonal."""
    n = 32_000
    items = spark.createDataFrame([(1, "la " * 20), (2, "la " * 19 + "end"), (3, "la " * 400)], ITEM)
    text = "x " * 9_000 + "la " * n + "end"
    began = time.monotonic()
    got = {r.item_id: r for r in decontaminate.overlaps(documents([(1, text), (2, "la " * 10)]), items).collect()}
    assert time.monotonic() - began < 30
    assert [(got[k].first_word, got[k].n_words, got[k].n_matched) for k in (1, 2, 3)] == [
        (9_000, 20, 20), (9_000 + n - 19, 20, 20), (9_000, 400, 400)]
