"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are its distinct words, word pairs and skip-grams (two words
with one between them), hashed into ``2 ** BITS`` coordinates; a feature's value
is 1 whatever its count. Each coordinate has its own learning rate, and the L1
term keeps coordinates at exactly zero until their evidence outweighs it, so the
model that is broadcast is sparse.

Training is bounded: at most ``FIT_ROWS`` labelled rows, in ``SHARDS`` shards that
learn side by side and have their states averaged after every round. Every change
of a shard's state counts, also that of a coordinate whose weight is still zero.
Scoring covers every whole text.

Edge cases: NULL and empty texts have only the bias and score its probability;
repeated rows score alike; without labels every weight is zero and every score
0.5; very long texts are cut into slices only to bound memory, never in result.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiers.llm.frame import array_slices, label_sample, labelled, mix, text_slices, texts_of, word_hashes

BITS = 22
#: Labelled rows that a model is fitted on at most, chosen by a hash of the id.
FIT_ROWS = 40_000
SHARDS = 4
ROUNDS = 6

#: Learning rate, its smoothing, and the L1 and L2 terms.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.1

#: Coordinates of a piece of the state, as shards send it.
PIECE = 1 << 16
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_PAIR, _SKIP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Model:
    """Non-zero weights by coordinate, and the bias."""

    index: np.ndarray
    weight: np.ndarray
    bias: float
    bits: int = BITS

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.index] = self.weight
        return out


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, coordinate) of every word, pair and skip-gram of a batch, repeats included."""
    h, _, _, row = word_hashes(texts)
    rows, found = [row], [h]
    for gap, mult in ((1, _PAIR), (2, _SKIP)):
        if len(h) > gap:
            same = row[:-gap] == row[gap:]
            rows.append(row[:-gap][same])
            found.append(mix(h[:-gap][same] * mult + h[gap:][same]))
    at = np.concatenate(found) >> np.uint64(64 - bits)
    return np.concatenate(rows), at.astype(np.int64)


def _logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Ftrl:
    """State of the learner: per coordinate the adjusted gradient sum ``z`` and the
    squared gradient sum ``n``. The last coordinate is the bias, without L1."""

    def __init__(self, z: np.ndarray, n: np.ndarray):
        self.z, self.n = z, n

    @classmethod
    def new(cls, bits: int = BITS) -> Ftrl:
        return cls(np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1))

    def weights(self, at) -> np.ndarray:
        return self._weights(np.asarray(at), self.z[at], np.sqrt(self.n[at]))

    def _weights(self, at: np.ndarray, z: np.ndarray, root: np.ndarray) -> np.ndarray:
        over = np.abs(z) - np.where(at == len(self.z) - 1, 0.0, L1)
        return np.where(over <= 0, 0.0, -np.sign(z) * over / ((BETA + root) / ALPHA + L2))

    def learn(self, at: np.ndarray, label: float) -> None:
        z, n = self.z[at], self.n[at]
        root = np.sqrt(n)
        w = self._weights(at, z, root)
        g = _logistic(w.sum()) - label
        n += g * g
        self.z[at] = z + g - (np.sqrt(n) - root) / ALPHA * w
        self.n[at] = n


_ADDED = "shard int, first int, at binary, z binary, n binary"


def _pieces(state: Ftrl, start: np.ndarray, shard: int) -> Iterator[pa.RecordBatch]:
    """What a shard adds to the state, a piece at a time: the places it changed, and by how much."""
    for a in range(0, len(state.z), PIECE):
        z, n = (x[a:a + PIECE] - y[a:a + PIECE] for x, y in zip((state.z, state.n), start))
        at = np.flatnonzero((z != 0) | (n != 0))
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([a], pa.int32()),
                 *(pa.array([x.tobytes()], pa.binary()) for x in
                   (at.astype(np.uint16), z[at].astype(np.float32), n[at].astype(np.float32)))],
                names=["shard", "first", "at", "z", "n"])


def _featured(bits: int):
    """Texts of rows replaced by their distinct coordinates (``at``, 32-bit integers in order)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices([batch]):
                row, at = features(texts_of(part), bits)
                code = np.unique(row * (1 << bits) + at)
                cuts = np.searchsorted(code, np.arange(part.num_rows + 1) * (1 << bits))
                at = (code & ((1 << bits) - 1)).astype(np.int32)
                found = pa.array([at[a:b].tobytes() for a, b in pairwise(cuts)], pa.binary())
                kept = part.select([c for c in part.schema.names if c != "text"])
                yield kept.append_column("at", found)
    return run


def _train(batches: Iterator[pa.RecordBatch], start: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Each shard's pass over its rows, which come in order, a batch at a time."""
    state, shard = None, None
    bias = np.array([1 << bits], dtype=np.int32)
    for batch in batches:
        for of_shard, label, at in zip(*(batch.column(batch.schema.get_field_index(c)) for c in ("shard", "label", "at"))):
            if of_shard.as_py() != shard:
                if state is not None:
                    yield from _pieces(state, start, shard)
                state, shard = Ftrl(*(x.astype(float) for x in start)), of_shard.as_py()
            met = np.frombuffer(at.as_buffer(), dtype=np.int32)
            state.learn(np.concatenate([met, bias]), float(label.as_py()))
    if state is not None:
        yield from _pieces(state, start, shard)


def _mean(group: pd.DataFrame, shards: int) -> pd.DataFrame:
    """One piece of what the shards add, averaged: a shard that sent none adds nothing."""
    group = group.sort_values("shard")  # always summed in the same order
    z, n = np.zeros(PIECE), np.zeros(PIECE)
    for at, *added in zip(group["at"], group["z"], group["n"]):
        for state, x in zip((z, n), added):
            state[np.frombuffer(at, dtype=np.uint16)] += np.frombuffer(x, dtype=np.float32)
    at = np.flatnonzero((z != 0) | (n != 0))
    return pd.DataFrame({"first": group["first"].iloc[:1], "at": [at.astype(np.uint16).tobytes()],
                         **{c: [(x[at] / shards).astype(np.float32).tobytes()] for c, x in (("z", z), ("n", n))}})


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark deletes a query's shuffle files as soon as its result is there: a round's are not needed again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, shards: int = SHARDS,
        rounds: int = ROUNDS, bits: int = BITS) -> Model:
    """A model learned from ``labels`` (doc_id, toxic) and the texts of ``docs``.

    Shards send every place of the state that they change, in single precision; Spark
    averages by piece, and the driver adds up in double precision. A round shuffles
    ``10 * shards * 2 ** bits`` bytes at most and the driver gets ``10 * 2 ** bits``,
    whatever the input. Texts become coordinates once, where they are read; a task of a
    round holds one state, the start of the round and a batch of coordinates.
    """
    spark: SparkSession = docs.sparkSession
    rows = labelled(docs, label_sample(labels, "toxic", fit_rows)).select(
        "doc_id", "label", "text", F.xxhash64("doc_id").alias("turn"),
        F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards)).cast("int").alias("shard"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    rows = rows.select(*[c for c in rows.columns if c != "text"], "text").mapInArrow(_featured(bits), f"{kept}, at binary")
    rows = (rows.repartition(shards, "shard").sortWithinPartitions("shard", "turn", "doc_id", "label")
            .select("shard", "label", "at").persist())
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
    try:
        for _ in range(rounds):
            start = spark.sparkContext.broadcast(np.stack([z, n]).astype(np.float32))

            def shard_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                return _train(batches, start.value, bits)

            with _shuffles_dropped(spark):
                added = (rows.mapInArrow(shard_pass, _ADDED).groupBy("first")
                         .applyInPandas(lambda group: _mean(group, shards), "first int, at binary, z binary, n binary")
                         .toArrow())
            for first, at, *parts in zip(added["first"].to_pylist(), added["at"], added["z"], added["n"]):
                at = np.frombuffer(at.as_buffer(), dtype=np.uint16).astype(np.int64) + first
                for state, part in zip((z, n), parts):
                    state[at] += np.frombuffer(part.as_buffer(), dtype=np.float32)
            del added
            start.destroy()
    finally:
        rows.unpersist()
    met = np.append(np.flatnonzero(np.abs(z[:-1]) > L1), len(z) - 1)  # the rest has no weight
    w = Ftrl(z, n).weights(met)
    at = np.flatnonzero(w[:-1])
    return Model(met[at], w[at], float(w[-1]), bits)


def score(spark: SparkSession, model: Model, text: Column) -> Column:
    """The probability of label 1 for a text column."""
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxicity(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sent.value
        w = model.dense()  # once for all batches of a task
        used = w != 0
        for texts in batches:
            out = []
            for part in array_slices(texts.fill_null("")):
                row, at = features(part, model.bits)
                hit = used[at]
                code = np.unique(row[hit] * len(w) + at[hit])
                total = np.bincount(code // len(w), weights=w[code % len(w)], minlength=len(part))
                out.append(_logistic(total + model.bias))
            yield pa.array(np.concatenate(out) if out else np.zeros(0))
    return toxicity(text)


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from; a NULL id has no label and is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
