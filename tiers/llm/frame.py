"""Column picking, text batches and written intermediates for the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.session import shared_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

#: Bytes of text that one numpy pass works on; bounds a task's arrays (about
#: 60 bytes of work space per byte). A single longer row is taken alone.
SLICE_BYTES = 1 << 20


def take(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The named columns, whatever else the frame holds.

    ``take(df, "a", b="x")`` gives columns ``a`` and ``b`` (from ``x``). Where
    several columns carry a name, the first with the exact case wins, then the
    first without regard to case. Columns are addressed by position, so clashing
    names never make a reference ambiguous.
    """
    wanted = {n: n for n in names} | renamed
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    picked = []
    for out, name in wanted.items():
        picked.append(F.col(f"_{place(df, name)}").alias(out))
    return plain.select(*picked)


def place(df: DataFrame, name: str) -> int:
    """Position of the column that ``take`` picks for a name."""
    at = next((i for i, c in enumerate(df.columns) if c == name),
              next((i for i, c in enumerate(df.columns) if c.lower() == name.lower()), None))
    if at is None:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return at


#: Bytes of a batch that goes to a Python worker, where the session has Spark's default
#: (64 MB, which both ends hold several times over).
BATCH_BYTES = "4m"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of a data folder. Sets the session's batches to ``BATCH_BYTES`` unless they were set."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in (None, "64MB", "67108864b"):
        spark.conf.set(key, BATCH_BYTES)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, its
    lineage cut, readable by every executor and column-pruned when read."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> Column:
    """A digest of a text, by which rows find their text again without carrying it."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def label_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """``doc_id, label`` of at most about ``rows`` labelled ids, chosen by a hash of the id.

    Distinct pairs first, so an id repeated in a third of the rows counts once;
    the share kept aims at 95 % of the bound, which a binomial spread does not
    overstep. No sort and no single task is involved.
    """
    pairs = take(labels, "doc_id", label=label).filter("doc_id is not null and label is not null").distinct()
    n = pairs.count()
    if n <= rows:
        return pairs
    return pairs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * 0.95 * rows / n))


def labelled(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``doc_id, label, text`` of a bounded sample; where an id has several texts,
    the smallest one. The sample is broadcast: its size is bounded by ``label_sample``."""
    return (take(docs, "doc_id", "text").join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")))


def text_slices(batches, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about ``size`` bytes of text."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def array_slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """An array of texts in parts of about ``size`` bytes."""
    for batch in text_slices([pa.RecordBatch.from_arrays([texts], names=["text"])], size=size):
        yield batch.column(0)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")


# ---- words and 64-bit word hashes of a whole batch at once ----------------

_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_WORD = np.zeros(256, dtype=bool)
for _c in (*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)):
    _WORD[_c] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse (both modulo 2^64)."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_MULT, pow(_MULT, -1, 1 << 64)):
            a = np.ones(size, dtype=np.uint64)
            have = 1
            while have < size:
                a[have:2 * have] = a[:have] * np.uint64(pow(base, have, 1 << 64))
                have *= 2
            out.append(a)
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch of texts: (hash, start byte, end byte, row).

    A word is a run of letters, digits and non-ASCII characters, lower-cased;
    start and end are byte offsets inside the row's lower-cased text. Equal
    words have equal hashes on every machine and in every batch.
    """
    texts = pc.utf8_lower(texts.cast(pa.large_utf8()))
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    empty = np.zeros(0, dtype=np.int64)
    if n == 0 or texts.buffers()[2] is None or offsets[-1] == offsets[0]:
        return empty.astype(np.uint64), empty, empty, empty
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    is_word = _WORD[data]
    starts = is_word.copy()
    starts[1:] &= ~is_word[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    starts[firsts] = is_word[firsts]  # a row never continues the word before it
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[1:] = is_word
    ends[1:-1] &= ~is_word[1:] | starts[1:]
    at = np.flatnonzero(starts)
    to = np.flatnonzero(ends)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    hashes = mix((sums[to] - sums[at]) * inverse[at])
    row = np.searchsorted(offsets, at, side="right") - 1
    # rows without bytes share their offset with the next row: the last of them owns it
    begin = offsets[row]
    return hashes, at - begin, to - begin, row
