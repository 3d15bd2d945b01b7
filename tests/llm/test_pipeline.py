import os
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.conftest import DOCUMENTS
from tests.llm.test_decontaminate import plain_leaks
from tests.llm.test_quality import plain_stats
from tests.llm.test_simhash import plain_fingerprint, plain_groups
from tiers.llm import queries, toxicity
from tiers.llm.frame import read
from tools.oracle_check import compare, duck

SF = os.environ.get("TIERS_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs_and_matches_its_sql(spark, con, name):
    res = compare(spark, name, SF, con)
    assert res["status"] in ("ok", "no-oracle"), res
    assert (res["status"] == "ok") == (name in queries.SQL)


def test_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_contract_columns(spark):
    want = {
        "op4_simhash": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
        "op5_toxicity": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
        "op9_token_counts": [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")],
        "op10_quality_rules": [("doc_id", "bigint"), *((n, "bigint") for n in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", "boolean"), ("kept", "boolean")],
    }
    for name, columns in want.items():
        got = dict(queries.QUERIES[name](spark, SF).dtypes)
        assert all(got.get(c) == t for c, t in columns), (name, got)


def test_simhash_and_quality_queries_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    rows = queries.QUERIES["op4_simhash"](spark, SF).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == plain_groups(prints)
    for r in queries.QUERIES["op10_quality_rules"](spark, SF).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_stats(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_toxicity_query_holds_out_and_ignores_ids(spark):
    for r in queries.QUERIES["op5_toxicity"](spark, SF).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_stages_against_brute_force(spark):
    docs, sf = read(spark, SF, "documents"), SF
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, sf)
        if name != "sentencepiece":
            assert out.dtypes == docs.dtypes
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before)
        if name == "near_duplicates":
            groups = plain_groups({i: plain_fingerprint(r.text) for i, r in before.items()})
            assert set(after) == set(groups.values())
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
            short = [(i, r.text) for i, r in before.items() if len(r.text) < 3000]
            leaking = {i for i, _ in plain_leaks(short, items)}
            assert {i for i, _ in short} - set(after) == leaking
        elif name == "quality_rules":
            failed = {i for i, r in before.items()
                      for s in [plain_stats(r.text)] if s[0] < 50 or 100 * s[4] > 50 * s[0]}
            assert not failed & set(after)
        elif name == "sentencepiece":
            assert set(after) == set(before)
            continue
        if name != "sentencepiece":
            assert all(after[i] == before[i] for i in after)
        docs = out


def test_run_equals_its_stages(spark):
    docs = read(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    rows = lambda df: sorted((r.doc_id, r["sample"], tuple(r.ids)) for r in df.collect())
    assert rows(docs) == rows(corpus_pipeline.run(spark, SF))


def test_odd_documents_pass_all_stages(spark, tmp_path):
    for t in ("labels", "benchmark"):
        read(spark, SF, t).write.parquet(str(tmp_path / f"{t}.parquet"))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0),
                                 (2, "word " * 20_000, None, "s", 5), (None, "a b c", "en", None, 5)], DOCUMENTS)
    for frame in (odd, odd.limit(0), odd.select("*", F.lit(1).alias("score"), F.lit("x").alias("TEXT"))):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        docs.collect()


def test_training_uses_only_rows_not_held_out(spark):
    labels = read(spark, SF, "labels").filter(~toxicity.held_out(F.col("doc_id")))
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in labels.collect())
