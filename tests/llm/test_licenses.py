import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, empty_like
from tiers.llm import licenses
from tiers.llm.frame import word_hashes
from tiers.llm.license_texts import TEMPLATES


def filler(rng, n):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def plain_align(template, text):
    """The best local alignment's score by the full table."""
    h = np.zeros((len(template) + 1, len(text) + 1), dtype=int)
    for i, a in enumerate(template, 1):
        for j, b in enumerate(text, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (licenses.SAME if a == b else licenses.DIFFERS),
                          h[i - 1, j] + licenses.GAP, h[i, j - 1] + licenses.GAP)
    return h.max()


def test_winnowing_guarantees_a_shared_fingerprint():
    rng = np.random.default_rng(0)
    n = licenses.GRAM + licenses.WINDOW - 1
    for _ in range(200):
        shared = rng.integers(0, 2 ** 63, size=n, dtype=np.uint64)
        a = np.concatenate([rng.integers(0, 2 ** 63, size=rng.integers(0, 9), dtype=np.uint64), shared])
        b = np.concatenate([shared, rng.integers(0, 2 ** 63, size=rng.integers(0, 9), dtype=np.uint64)])
        fa, fb = (set(licenses.winnow(x, np.zeros(len(x), dtype=np.int64))[1].tolist()) for x in (a, b))
        assert fa & fb


def test_rows_of_a_batch_are_winnowed_alone():
    rng = np.random.default_rng(1)
    parts = [rng.integers(0, 2 ** 63, size=n, dtype=np.uint64) for n in (7, 0, 2, 3, 4, 30)]
    row = np.repeat(np.arange(6), [len(p) for p in parts])
    at, hashes = licenses.winnow(np.concatenate(parts), row)
    alone = [licenses.winnow(p, np.zeros(len(p), dtype=np.int64)) for p in parts]
    assert [h.tolist() for h in (hashes[row[at] == i] for i in range(6))] == [h.tolist() for _, h in alone]


def test_alignment_matches_the_full_table():
    rng = random.Random(2)
    for _ in range(150):
        template = np.array([rng.randrange(6) for _ in range(rng.randint(3, 25))])
        text = [int(x) for x in template]
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(text) + 1)
            text[at:at + rng.randint(0, 1)] = [rng.randrange(6)] * rng.randint(0, 1)
        text = np.array([9] * rng.randint(0, 5) + text + [9] * rng.randint(0, 5))
        first, end, matched = licenses.align(template, text, 40)
        span = text[first:end]
        assert plain_align(template, span) == plain_align(template, text)
        assert matched <= min(len(template), len(span))


def test_scan_finds_planted_notices_with_edits(spark, documents):
    rng = random.Random(4)
    docs, want = [], {}
    for i, (name, text) in enumerate(TEMPLATES):
        words = text.split()
        for j in range(len(words) // 25):  # a substitution, an extra and a missing word now and then
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = ["edited"]
        docs.append((i, filler(rng, 30) + "\n" + " ".join(words).upper() + "\n" + filler(rng, 30)))
        want[i] = name
    docs += [(100 + i, filler(rng, 200)) for i in range(20)] + [(200 + i, t) for i, t in enumerate(ODD_TEXTS)]
    got = licenses.scan(documents(docs)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert {(i, n) for i, n in want.items()} <= found
    assert not [r for r in got if r.doc_id >= 100]
    for r in got:
        if len(TEMPLATES[r.template][1].split()) < 25:
            assert r.coverage == 1.0 or r.doc_id != r.template
        assert r.first_word < r.end_word and r.n_matched >= 0.8 * len(word_hashes(pa.array([TEMPLATES[r.template][1]]))[0])


def test_spans_are_places_in_the_text(documents):
    text = "é Intro words here. Released under the MIT License. More.\nReleased under the MIT license!"
    rows = sorted(licenses.scan(documents([text])).collect(), key=lambda r: r.first_word)
    assert [(r.license, r.first_word, r.end_word) for r in rows] == [("MIT", 4, 9), ("MIT", 10, 15)]
    raw = text.lower().encode()
    assert [raw[r.first_byte:r.end_byte].decode() for r in rows] == ["released under the mit license"] * 2


def test_many_copies_in_a_row_are_each_found_once(documents):
    text = "Released under the MIT License. " * 50 + "x " * 30 + "Licensed under CC BY-NC 4.0. " * 3
    rows = licenses.scan(documents([text])).collect()
    mit = sorted(r.first_word for r in rows if r.license == "MIT")
    assert mit == [5 * i for i in range(50)]
    assert sorted(r.first_word for r in rows if r.license == "CC-BY-NC-4.0") == [280, 287, 294]


def test_odd_rows(spark, clashing):
    with pytest.raises(ValueError):
        licenses.index([("X", "one two")])
    assert licenses.scan(empty_like(spark, DOCUMENTS)).count() == 0
    assert licenses.scan(clashing([(None, "Released under the MIT License.")] * 2)).count() == 2


def test_a_notice_is_not_its_neighbour(documents):
    """Every template alone gives its license and no other; unknown neighbours give none."""
    unknown = ["This work is licensed under the GNU General Public License, version 4.",
               "This project is licensed under the terms of the Zope license.", "Licensed under CC BY-NC 2.5.",
               "Licensed under the Apache License, Version 1.1."]
    docs = [(i, f"zz yy xx {t} ww vv uu") for i, t in enumerate([t for _, t in TEMPLATES] + unknown)]
    got = {}
    for r in licenses.scan(documents(docs)).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == {i: {name} for i, (name, _) in enumerate(TEMPLATES)}
