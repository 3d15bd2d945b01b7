"""Substring dedup: the factors' spans against every window of every document."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, empty_like
from tiers.llm import substring

W = substring.WINDOW


def brute(rows):
    """(doc_id, words, removed words, kept text), window by window."""
    owner = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, words in split:
        if i is not None:
            for a in range(len(words) - W + 1):
                key = tuple(words[a:a + W])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        if i is not None:
            for a in range(len(words) - W + 1):
                if owner[tuple(words[a:a + W])] < i:
                    gone.update(range(a, a + W))
        out.append((i, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=str)


def result(df, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.remove_repeats(df, **options).collect()), key=str)


def corpus(seed, n=60):
    """Documents that share passages of 30 to 120 words, whole copies, edited copies, repeats of one phrase."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["é", "日本", "\x85x"]
    say = lambda k: rng.choices(vocab, k=k)
    passages = [say(rng.randint(30, 120)) for _ in range(6)] + [say(3) * 30, ["la"] * 80]
    texts = []
    for _ in range(n):
        words = say(rng.randint(0, 80))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p) // 3)
            words += p[a:] + say(rng.randint(0, 60))
        if texts and rng.random() < .3:
            words = rng.choice(texts).split()
            if words and rng.random() < .7:
                words[rng.randrange(len(words))] = "edited"
        texts.append(rng.choice([" ", "\n", "  \t"]).join(words))
    return texts


@pytest.mark.parametrize("seed, hot", [(1, substring.HOT), (2, substring.HOT), (3, 1), (4, 4)])
def test_against_every_window(spark, documents, seed, hot):
    rows = list(enumerate(corpus(seed), 10))
    random.Random(seed).shuffle(rows)
    assert result(documents(rows), hot=hot) == brute(rows)


def test_odd_rows(spark, documents, clashing):
    texts = corpus(5, 25)
    rows = [*enumerate([*ODD_TEXTS, *texts]), (3, texts[0]), (3, texts[1]), (3, texts[1]), (None, texts[2]), (None, None),
            (-5, texts[3]), (90, "word " * 70), (91, "word " * 49), (92, texts[4] + " " + "word " * 60)]
    assert result(documents(rows)) == brute(rows)
    assert result(clashing(texts)) == brute(list(enumerate(texts)))
    assert result(empty_like(spark, DOCUMENTS)) == []


def test_a_passage_in_very_many_documents(spark, documents):
    """More wordings around one passage than a block takes: windows become keys."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(55)]
    rows = [(i, " ".join([f"a{rng.random()}"] * 3 + passage + [f"b{rng.random()}"] * 60)) for i in range(300)]
    assert result(documents(rows), hot=50) == brute(rows)


def test_pieces_cover_every_window_once_and_depend_on_its_words_alone():
    rng = random.Random(9)
    texts = [" ".join(rng.choices("abc", k=rng.randint(0, 200))) for _ in range(30)]
    words, first = substring.word_hashes(pa.array(texts))
    row, anchor, form, at, n = substring.pieces_of(words, first)
    seen = {}
    for r, a, f, i, k in zip(row, anchor, form, at, n):
        for j in range(i, i + k):
            assert (r, j) not in seen
            seen[r, j] = a
            split = texts[r].split()
            key = tuple(split[j:j + W])
            assert seen.setdefault(key, a) == a  # equal windows, equal anchors
    assert sum(isinstance(k[1], (int, np.integer)) for k in seen) == sum(max(0, len(t.split()) - W + 1) for t in texts)


def test_block_against_every_stretch():
    rng = random.Random(10)
    for _ in range(150):
        size, base = rng.choice([3, 5, 8]), rng.choices(range(4), k=30)
        forms = [rng.choices(range(4), k=rng.randrange(6)) + base[(a := rng.randrange(20)):a + rng.randrange(14)]
                 + rng.choices(range(4), k=rng.randrange(6)) for _ in range(rng.randint(1, 7))]
        docs = rng.choices(range(5), k=len(forms))
        block = substring.Block(np.array(sum(forms, []), dtype=np.uint64), np.array([len(f) for f in forms]), np.array(docs))
        got = {(int(f), j) for f, x, y in zip(*block.repeated(size)) for j in range(x, y + 1)}
        want = {(i, j) for i, f in enumerate(forms) for j in range(len(f) - size + 1)
                if any(docs[o] < docs[i] and any(g[k:k + size] == f[j:j + size] for k in range(len(g)))
                       for o, g in enumerate(forms))}
        assert got == want


def test_hot_anchors_cost_no_further_pass_over_the_texts(spark, documents):
    rows = list(enumerate(corpus(5)))
    seen = {}
    for hot in (1, substring.HOT):
        counted = spark.sparkContext.accumulator(0)

        def count(batches, counted=counted):
            for batch in batches:
                counted.add(batch.num_rows)
                yield batch

        df = documents(rows)
        assert result(df.mapInArrow(count, df.schema), hot=hot) == brute(rows)
        seen[hot] = counted.value
    assert seen[1] == seen[substring.HOT] > 0


def test_parse_lets_hot_rows_through_behind_the_others():
    rng = np.random.default_rng(7)
    same = rng.integers(0, 1 << 62, 2 * W).astype(np.uint64).tobytes()
    rows = [(1, 10, 5, False), (1, 11, 6, False), (9, 12, 5, True), (9, 13, 6, True), (9, 14, 7, True)]
    columns = [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows]),
               pa.array([W + 1] * 5, pa.int32()), pa.array([r[3] for r in rows]), pa.array([same] * 5, pa.binary())]
    batch = pa.RecordBatch.from_arrays(columns, names=["anchor", "form", "doc_id", "n", "hot", "words"])
    for cut in range(6):  # a batch may end anywhere
        parts = [b for b in (batch.slice(0, cut), batch.slice(cut)) if b.num_rows]
        out = pa.Table.from_batches(list(substring._parse(iter(parts)))).to_pylist()
        assert [(r["form"], r["low"], r["high"]) for r in out if r["words"] is None] == [(11, 0, W)]
        assert [(r["form"], r["doc_id"], r["n"], r["words"]) for r in out if r["words"]] == [(f, d, W + 1, same) for _, f, d, h in rows if h]
