"""Token counts with a digest cache.

Every text gets a digest of (tokenizer version, content). Digests found in the
cache table take their stored count; of the others each distinct one is
encoded once, and its count is appended to the cache.

Content is normalised by the identity except that NULL is the empty text: any
other folding could change a count. The tokenizer version is a digest of the
tokenizer file and the library's version, so a changed file never meets counts
of the old one.

Edge cases: NULL and empty texts count 0 bytes and whatever the tokenizer
makes of the empty text (0 tokens); repeated rows, also with equal ids, all
come back; a NULL id stays NULL; very long texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiers.llm.frame import take, text_slices, texts_of, written
from tiers.session import shared_dir

CACHE_SCHEMA = T.StructType([
    T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType())])

#: Distinct chunks whose counts one Python worker keeps; the table is emptied
#: and refilled beyond it, which costs time, never a count.
CHUNK_TABLE = 300_000

_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_CHUNK = re.compile("[ \n]*[^ \n]+|[ \n]+")


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer file's bytes and of the library that reads it."""
    with open(path, "rb") as f:
        content = hashlib.sha256(f.read()).hexdigest()
    if path.endswith(".model"):
        import sentencepiece as lib
    else:
        import tokenizers as lib
    return hashlib.sha256(f"{lib.__name__} {lib.__version__} {content}".encode()).hexdigest()


def _splits_at_spaces(path: str) -> bool:
    """Whether counts of chunks add up to the count of the text.

    True for byte-level BPE with its standard split: no token crosses from a
    non-space character to a following blank or line feed, so a text may be cut
    there. Normalisers, prefix blanks and added tokens that strip blanks would
    break this; such tokenizers encode whole texts.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and spec.get("normalizer") is None
            and (spec.get("model") or {}).get("type") == "BPE"
            and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
                        for t in spec.get("added_tokens") or []))


@lru_cache(maxsize=4)
def _counter(path: str) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts, built once per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    if not _splits_at_spaces(path):
        return whole
    known: dict[str, int] = {}

    def by_chunk(texts: list[str]) -> list[int]:
        out, direct = [0] * len(texts), []
        for i, text in enumerate(texts):
            if _OTHER_SPACE.search(text):
                direct.append(i)
                continue
            chunks = _CHUNK.findall(text)
            distinct = set(chunks)
            new = [c for c in distinct if c not in known]
            if new:
                if len(known) + len(new) > CHUNK_TABLE:
                    known.clear()
                    new = list(distinct)
                known.update(zip(new, whole(new)))
            out[i] = sum(map(known.__getitem__, chunks))
        for i, n in zip(direct, whole([texts[i] for i in direct]) if direct else []):
            out[i] = n
        return out

    return by_chunk


def _encode(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in text_slices(batches):
            counts = count(texts_of(batch).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("digest")), pa.array(counts, pa.int64())],
                names=["digest", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs`` (doc_id, text).

    ``cache`` is a folder of a Parquet table (digest, n_tokens) in shared
    storage, created when absent and appended to; without one the call uses a
    new cache of its own under the shared folder. Appended digests are distinct
    misses; should two runs append at once, a digest may be stored twice with
    the same count, which reading folds.

    Plan: one representative id per missing digest (a hash aggregate that is
    combined map-side, so copies that make up a third of the rows shrink to a
    row per task), then texts meet it by (id, digest). Rows equal in both, and all
    rows without id of a text, fold map-side before that shuffle, which the join
    shares: one row per missing digest is left to encode.
    """
    spark = docs.sparkSession
    cache = cache or shared_dir(spark, "llm", "token_cache")
    version = tokenizer_version(tokenizer)
    content = F.coalesce(F.col("text"), F.lit(""))
    keyed = (take(docs, "doc_id", "text").withColumn("text", content)
             .withColumn("digest", F.unhex(F.sha2(F.concat(F.lit(version + " ").cast("binary"),
                                                           F.col("text").cast("binary")), 256))))
    light = keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    stored = _read_cache(spark, cache)
    # ids as text, so that a missing one is a value like any other
    place = F.to_json(F.struct("doc_id")).alias("place")
    missing = (light.groupBy("digest").agg(F.min(place).alias("place"))
               .join(stored, "digest", "left_anti"))
    to_encode = (keyed.groupBy(place, "digest").agg(F.first("text").alias("text"))
                 .join(missing, ["place", "digest"], "left_semi").select("digest", "text"))
    (to_encode.mapInArrow(_encode(tokenizer), CACHE_SCHEMA)
     .write.mode("append").parquet(cache))
    # digests that two runs stored are folded. Written, so that the join reads both
    # sides straight from a shuffle and the copies of a text that holds a third of
    # the rows are split between tasks at run time
    counts = written(_read_cache(spark, cache).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens")), "counts")
    return light.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")


def shared_cache(spark: SparkSession, tokenizer: str) -> str:
    """The cache of a tokenizer version under the shared folder, which later calls meet again."""
    return shared_dir(spark, "llm", "token_counts", tokenizer_version(tokenizer), unique=False)


def _read_cache(spark: SparkSession, cache: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(CACHE_SCHEMA).parquet(cache)
    return spark.createDataFrame([], CACHE_SCHEMA)
