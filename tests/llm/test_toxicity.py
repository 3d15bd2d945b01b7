import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, empty_like
from tiers.llm import toxicity
from tiers.llm.frame import mix, word_hashes

BAD = ["grub", "vile", "rotter"]


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        t = rng.choices(words, k=rng.randint(5, 120))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                t.insert(rng.randrange(len(t)), rng.choice(BAD))
        docs.append((i, " ".join(t)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_rows_are_scored_right_and_not_learned_from(spark, documents):
    docs, labels = corpus()
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    frame = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    seen = frame.filter(~toxicity.held_out(F.col("doc_id")))
    assert {r.doc_id for r in seen.collect()} == {i for i, _ in docs} - held
    model = toxicity.fit(documents(docs), seen)
    assert 0 < len(model.index) < 2000  # sparse
    got = {r.doc_id: r.p for r in documents(docs).select("doc_id", toxicity.score(spark, model, F.col("text")).alias("p")).collect()}
    right = [(got[i] >= 0.5) == bool(y) for i, y in labels if i in held]
    assert np.mean(right) > 0.97
    assert not [i for i, y in labels if not y and got[i] >= 0.5]


def test_score_of_a_column_equals_the_sum_over_distinct_features(spark, documents):
    docs, labels = corpus(400, 2)
    model = toxicity.fit(documents(docs), spark.createDataFrame(labels, "doc_id bigint, toxic int"), bits=16)
    w = dict(zip(model.index.tolist(), model.weight.tolist()))
    texts = [t for _, t in docs[:60]] + ODD_TEXTS
    got = {r.doc_id: r.p for r in documents(texts).select("doc_id", toxicity.score(spark, model, F.col("text")).alias("p")).collect()}
    for i, t in enumerate(texts):
        h = [int(x) for x in word_hashes(pa.array([t or ""]))[0]]
        m = (1 << 64) - 1
        feats = set(h) | {int(mix(np.array([(a * int(toxicity._PAIR) + b) & m], dtype=np.uint64))[0]) for a, b in zip(h, h[1:])} \
            | {int(mix(np.array([(a * int(toxicity._SKIP) + b) & m], dtype=np.uint64))[0]) for a, b in zip(h, h[2:])}
        total = model.bias + sum(w.get(f, 0.0) for f in {x >> 48 for x in feats})
        assert abs(got[i] - 1 / (1 + np.exp(-total))) < 1e-9


def test_ftrl_follows_its_equations():
    learner = toxicity.Ftrl.new(4)
    z, n = np.zeros(17), np.zeros(17)
    rng = random.Random(0)
    for _ in range(200):
        at = np.array(sorted(rng.sample(range(16), 4)) + [16])
        y = float(at[0] < 4)
        w = np.array([0.0 if abs(z[i]) <= (toxicity.L1 if i < 16 else 0) else
                      -(z[i] - np.sign(z[i]) * (toxicity.L1 if i < 16 else 0)) /
                      ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2) for i in at])
        g = 1 / (1 + np.exp(-w.sum())) - y
        for i, x in zip(at, w):
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / toxicity.ALPHA * x
            n[i] += g * g
        learner.learn(at, y)
    assert np.allclose(learner.z, z) and np.allclose(learner.n, n)


def test_odd_rows(spark, documents, clashing):
    model = toxicity.fit(clashing(["a b", "c d"]), empty_like(spark, "doc_id bigint, toxic int"), bits=10)
    assert len(model.index) == 0 and model.bias == 0
    scored = documents([(None, t) for t in ODD_TEXTS]).select(toxicity.score(spark, model, F.col("text")).alias("p")).collect()
    assert [r.p for r in scored] == [0.5] * len(ODD_TEXTS)
    empty = empty_like(spark, DOCUMENTS)
    assert empty.select(toxicity.score(spark, model, F.col("text"))).count() == 0
    labels = spark.createDataFrame([(0, 1), (0, 0), (0, 1), (None, 1), (1, None)], "doc_id bigint, toxic int")
    toxicity.fit(documents([(0, "x"), (0, "y"), (1, None)]), labels, bits=10)
    toxicity.fit(empty, labels, bits=10)


def test_long_text_scores_like_its_words(spark, documents):
    docs, labels = corpus(400, 3)
    model = toxicity.fit(documents(docs), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    texts = ["word1 word2 " * 200_000 + "vile", "word1 word2 word1 vile"]
    p = [r.p for r in documents(texts).orderBy("doc_id").select(toxicity.score(spark, model, F.col("text")).alias("p")).collect()]
    assert p[0] >= 0.5 and p[1] >= 0.5


def test_evidence_below_the_threshold_adds_up_over_the_rounds(spark, documents):
    """30 toxic words, each in one toxic row of every shard: no shard alone brings one near L1."""
    rng = random.Random(5)
    ids = spark.range(4000).select("id", F.pmod(F.xxhash64("id", F.lit("shard")), F.lit(toxicity.SHARDS)).alias("s")).collect()
    of_shard = [[r.id for r in ids if r.s == s] for s in range(toxicity.SHARDS)]
    docs, labels = [], []
    for own in of_shard:
        for j, i in enumerate(own[:230]):
            text = [f"clean{rng.randrange(40)}" for _ in range(12)]
            docs.append((i, " ".join([f"bad{j}", *text] if j < 30 else text)))
            labels.append((i, int(j < 30)))
    model = toxicity.fit(documents(docs), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    at = word_hashes(pa.array([" ".join(f"bad{j}" for j in range(30))]))[0] >> np.uint64(64 - toxicity.BITS)
    w = dict(zip(model.index.tolist(), model.weight.tolist()))
    assert [j for j, x in enumerate(at.tolist()) if w.get(x, 0) <= 0] == []


def test_a_fit_equals_shards_that_send_everything(spark, documents):
    """The rounds in plain numpy, with whole states averaged."""
    docs, labels = corpus(200, 4)
    bits, y = 12, dict(labels)
    rows = documents(docs).select("doc_id", F.xxhash64("doc_id").alias("turn"),
                                  F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(toxicity.SHARDS)).alias("shard")).collect()
    texts = dict(docs)
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    for _ in range(toxicity.ROUNDS):
        ends = []
        for s in range(toxicity.SHARDS):
            state = toxicity.Ftrl(z.copy(), n.copy())
            for r in sorted((r for r in rows if r.shard == s), key=lambda r: r.turn):
                _, at = toxicity.features(pa.array([texts[r.doc_id]]), bits)
                state.learn(np.append(np.unique(at), 1 << bits), float(y[r.doc_id]))
            ends.append(state)
        z, n = np.mean([e.z for e in ends], axis=0), np.mean([e.n for e in ends], axis=0)
    w = toxicity.Ftrl(z, n).weights(np.arange(len(z)))
    model = toxicity.fit(documents(docs), spark.createDataFrame(labels, "doc_id bigint, toxic int"), bits=bits)
    assert np.allclose(model.dense(), w[:-1], atol=1e-3) and abs(model.bias - w[-1]) < 1e-3
