import random
import re
import string

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, empty_like
from tiers.llm import components, simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, max_bits=2):
    """The smallest key of each key's group, by comparing all pairs."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in prints}


@pytest.mark.parametrize("text", [t for t in ODD_TEXTS if t is None or len(t) < 1000] + ["A B C d e F g " * 20])
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint_of(text or "") == plain_fingerprint(text)


def test_fingerprint_column_equals_spark_hash(spark):
    # one shingle: the fingerprint is the shingle's hash, which Spark computes too
    row = spark.sql("select 'Ab\t c' t").select(simhash.fingerprint(__import__("pyspark").sql.functions.col("t")).alias("f"))
    assert row.first()[0] == spark.sql("select xxhash64('ab c')").first()[0]


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 2 ** 32), st.integers(1, 400))
def test_index_finds_exactly_the_near_members(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2 ** 63, size=max(1, n // 4), dtype=np.uint64)
    noise = np.uint64(1) << rng.integers(0, 64, size=n, dtype=np.uint64)
    members = np.unique(base[rng.integers(0, len(base), size=n)] ^ noise)
    members = members[np.argsort(simhash.gray_rank(members), kind="stable")]
    queries = np.concatenate([members, rng.integers(0, 2 ** 63, size=20, dtype=np.uint64)])
    found = {(int(q), int(m)) for a, b in simhash.search(simhash.build(members), queries) for q, m in zip(a, b)}
    near = np.bitwise_count(queries[:, None] ^ members[None, :]) <= 2
    assert found == {(int(q), int(m)) for q, m in zip(*np.nonzero(near))}


def test_gray_rank_inverts_the_gray_code():
    x = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(x ^ (x >> np.uint64(1))) == x).all()


@pytest.mark.parametrize("node_members,node_rows", [(1024, 1 << 18), (4, 40), (2, 8)])
def test_links_connect_like_all_pairs(spark, node_members, node_rows):
    rng = random.Random(node_members)
    prints = set()
    for _ in range(40):  # clusters, chains and strangers
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 12])):
            prints.add(x)
            x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    signed = {x: x - (1 << 64) if x >> 63 else x for x in prints}
    fps = spark.createDataFrame([(v,) for v in signed.values()], "fp bigint")
    got = {r.u: r.root for r in components.components(simhash.links(fps, 2, node_members, node_rows)).collect()}
    groups = plain_groups({signed[x]: x for x in prints})
    assert {k: got.get(k, k) for k in groups} == groups


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(7, 7), (2000, 1999), (1999, 2000)]
    got = {r.u: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(40)} | {1999: 1999, 2000: 1999}


def test_near_duplicates_against_all_pairs(spark, documents):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = list(ODD_TEXTS)
    for _ in range(60):
        t = rng.choices(words, k=rng.randint(3, 400))
        texts.append(" ".join(t))
        if rng.random() < 0.5:
            t[rng.randrange(len(t))] = "changed"
            texts += [" ".join(t), " ".join(t)]
    rows = simhash.near_duplicates(documents(texts)).collect()
    assert len(rows) == len(texts)
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.fp & (1 << 64) - 1 for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == plain_groups(prints)


def test_null_and_repeated_ids(spark, documents):
    docs = documents([(None, "a b c d"), (5, "a b c d"), (None, "lonely words here now"), (7, "q r s"), (7, "q r s"), (7, "t u v")])
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [
        ("5", "5"), ("7", "7"), ("7", "7"), ("7", "7"), ("None", "5"), ("None", "None")]
    kept = simhash.keep_one(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == [
        ("5", "a b c d"), ("7", "q r s"), ("7", "t u v"), ("None", "lonely words here now")]


def test_empty_table_and_clashing_columns(spark, clashing):
    assert simhash.near_duplicates(empty_like(spark, DOCUMENTS)).count() == 0
    assert simhash.near_duplicates(clashing(["a b c", "a b c"])).select("doc_id", "component_id").collect() == [(0, 0), (1, 0)]
