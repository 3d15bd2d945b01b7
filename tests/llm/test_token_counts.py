import os
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DOCUMENTS, ODD_TEXTS, empty_like
from tiers.llm import queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="tokenizer files not present")


def library_counts(path, texts):
    if path.endswith(".model"):
        import sentencepiece
        return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)]
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|>  x", "it's we'll 12 345\r\n\t x", "  two  blanks \n\n lines ",
           "x\n y\n\nz \t\n w", "tail  ", "\n", "a b c　d"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1 \n\t\xa0 '.,é<|\x1c", max_size=40))
def test_chunks_count_like_the_whole_text(text):
    assert token_counts._counter(PATH)([text]) == library_counts(PATH, [text])


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_every_library(documents, name):
    path = public_tokenizers.path(name)
    texts = [t for t in ODD_TEXTS if t is None or len(t) < 50_000] + SPECIAL
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(documents(texts), path).collect()}
    want = library_counts(path, [t or "" for t in texts])
    assert got == {i: (len((t or "").encode()), n) for i, (t, n) in enumerate(zip(texts, want))}


def test_cache_holds_distinct_misses_and_is_used(spark, documents, tmp_path):
    cache = str(tmp_path / "cache")
    token_counts.count_tokens(documents(["one two", "one two", "three", None, ""]), PATH, cache).collect()
    stored = spark.read.parquet(cache)
    assert stored.count() == 3 and stored.select("digest").distinct().count() == 3
    # a hit takes the stored count, a miss is appended
    stored.withColumn("n_tokens", stored.n_tokens + 1000).write.parquet(str(tmp_path / "other"))
    got = token_counts.count_tokens(documents(["one two", "four"]), PATH, str(tmp_path / "other")).collect()
    assert sorted(r.n_tokens for r in got)[0] < 10 and sorted(r.n_tokens for r in got)[1] > 1000
    assert spark.read.parquet(str(tmp_path / "other")).count() == 4
    # another tokenizer's counts are not met
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_counts.tokenizer_version(path) != token_counts.tokenizer_version(PATH)
    got = token_counts.count_tokens(documents(["one two"]), path, cache).first()
    assert got.n_tokens == library_counts(path, ["one two"])[0] and spark.read.parquet(cache).count() == 4


def test_odd_rows(spark, documents, clashing):
    docs = documents([(None, "a b"), (None, "a b"), (1, "a b"), (1, "c"), (1, "c"), (2, None)])
    rows = sorted((str(r.doc_id), r.n_tokens) for r in token_counts.count_tokens(docs, PATH).collect())
    assert rows == [("1", 1), ("1", 1), ("1", 2), ("2", 0), ("None", 2), ("None", 2)]
    assert token_counts.count_tokens(empty_like(spark, DOCUMENTS), PATH).count() == 0
    assert token_counts.count_tokens(clashing(["a b"]), PATH).first().n_tokens == 2


def test_equal_rows_and_rows_without_id_are_encoded_once(spark, documents, tmp_path):
    cache = str(tmp_path / "cache")
    docs = documents([(1, "same text")] * 50 + [(None, "no id")] * 30 + [(2, "no id"), (3, None), (None, "")])
    got = token_counts.count_tokens(docs.repartition(4), PATH, cache)
    assert Counter((r.doc_id, r.n_bytes) for r in got.collect()) == {
        (1, 9): 50, (None, 5): 30, (2, 5): 1, (3, 0): 1, (None, 0): 1}
    assert spark.read.parquet(cache).count() == 3


def test_the_query_counts_like_the_library_and_meets_its_cache(spark, documents, tmp_path):
    texts = [t for t in ODD_TEXTS if t is None or len(t) < 50_000] + SPECIAL + SPECIAL
    documents(texts).write.parquet(str(tmp_path / "documents.parquet"))
    query = queries.QUERIES["op9_token_counts"]
    first = {r.doc_id: tuple(r) for r in query(spark, str(tmp_path)).collect()}
    want = library_counts(PATH, [t or "" for t in texts])
    assert first == {i: (i, len((t or "").encode()), n, n > 512) for i, (t, n) in enumerate(zip(texts, want))}
    cache = token_counts.shared_cache(spark, PATH)
    stored = spark.read.parquet(cache).count()
    assert {r.doc_id: tuple(r) for r in query(spark, str(tmp_path)).collect()} == first
    assert spark.read.parquet(cache).count() == stored  # nothing was encoded again
