import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import empty_like
from tiers.llm import sharding


def plain_shards(sizes, limit):
    """Split by the next bit of the key's digest until a bucket fits or is a single row."""
    bits = {k: bin(int(hashlib.md5(f'{{"k":{k}}}'.encode()).hexdigest()[:15], 16))[2:].zfill(60) for k in sizes}
    out = {}

    def split(keys, d):
        if len(keys) <= 1 or sum(sizes[k] for k in keys) <= limit:
            out.update({k: bits[k][:d] for k in keys})
            return
        for b in "01":
            split([k for k in keys if bits[k][d] == b], d + 1)
    split(list(sizes), 0)
    return out


@pytest.mark.parametrize("limit", [1, 50, 700, 10 ** 6])
def test_like_plain_extendible_hashing(spark, limit):
    sizes = {i: (i * 37) % 91 + (5000 if i == 17 else 0) for i in range(300)}
    df = spark.createDataFrame(list(sizes.items()), "k bigint, size bigint")
    got = {r.k: r.shard for r in sharding.shard(df, ["k"], limit, F.col("size")).collect()}
    assert got == plain_shards(sizes, limit)


def test_several_levels_of_the_directory(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SPAN", 2)
    sizes = {i: 10 for i in range(400)}
    df = spark.createDataFrame(list(sizes.items()), "k bigint, size bigint")
    got = {r.k: r.shard for r in sharding.shard(df, ["k"], 60, F.col("size")).collect()}
    assert got == plain_shards(sizes, 60)


def test_a_hot_key_and_a_hot_row_are_split_and_nothing_is_lost(spark):
    rows = [(1, i, 10) for i in range(200)] + [(2, 0, 10)] * 150 + [(i, i, 10) for i in range(3, 200)] + [(None, 1, 10)]
    df = spark.createDataFrame(rows, "k bigint, v bigint, size bigint")
    got = sharding.shard(df, ["k"], 100, F.col("size")).collect()
    assert Counter((r.k, r.v, r["size"]) for r in got) == Counter(rows)
    size = defaultdict(int)
    for r in got:
        size[r.shard] += r["size"]
    assert max(size.values()) <= 100
    copies = Counter(r.shard for r in got if r.k == 2)
    assert len(copies) == 15 and set(copies.values()) == {10}


def test_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, None, "old"), (1, "é", "x"), (1, "é", "x")], "k bigint, t string, shard string")
    got = sharding.shard(df, ["k"], 1 << 20, F.octet_length("t"))
    assert got.columns == ["k", "t", "shard"] and {r.shard for r in got.collect()} == {""} and got.count() == 3
    assert sharding.shard(empty_like(spark, "k bigint, t string"), ["k"], 10, F.length("t")).columns == ["k", "t", "shard"]
    big = spark.createDataFrame([(i, "x" * 1000) for i in range(20)] + [(99, "y" * 100_000)], "k bigint, t string")
    out = sharding.shard(big, ["k"], 3000, F.length("t"))
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = sharding.read_shards(spark, str(tmp_path / "shards"))
    assert Counter(map(tuple, back.select("k", "t", "shard").collect())) == Counter(map(tuple, out.select("k", "t", "shard").collect()))
    assert {r.shard[0] for r in back.collect()} == {"0", "1"} and back.count() == 21
    alone = [r for r in out.groupBy("shard").agg(F.sum(F.length("t")).alias("b"), F.count("*").alias("n")).collect() if r.b > 3000]
    assert [(r.b, r.n) for r in alone] == [(100_000, 1)]


def test_written_shards_keep_their_names(spark, tmp_path):
    """Names that would read as one number, the root shard, copies of a row, and no rows at all."""
    names = ["00", "010", "10", "011", "110", "111"]
    cases = {"bits": names, "root": [""], "copies": ["01.0", "01.1", "1"], "none": []}
    for case, shards in cases.items():
        df = spark.createDataFrame([(i, s) for i, s in enumerate(shards)], "k bigint, shard string")
        sharding.write_shards(df, str(tmp_path / case))
        back = sharding.read_shards(spark, str(tmp_path / case), schema=df.schema)
        assert back.columns == df.columns
        assert sorted(map(tuple, back.collect())) == sorted(enumerate(shards))
