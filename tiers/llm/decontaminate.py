"""Benchmark decontamination with spaced seeds.

A seed is a window of words under a fixed mask: the masked positions are hashed,
the others are ignored, so a substituted word there does not matter. Seeds of
benchmark items and of documents are joined on their hash; around every hit the
item is laid over the document on the hit's diagonal, and the longest stretch in
which at least ``IDENTITY`` of the words agree is the overlap. A document leaks
an item when the overlap spans ``MIN_WORDS`` words, or the whole of a shorter
item.

With ``MASKS`` no overlap of 13 words with up to 2 substitutions, of 15 with 3 or
of 20 with 4 goes without a hit; ``short_masks`` meet every overlap that an item
of 1 to 12 words can have (a test goes through all placements). A document is
hashed only under the masks that some item uses.

Edge cases: NULL or empty texts and items have no word and no overlap; items
whose id is NULL, and items with equal texts, are all reported, each id once per
text; repeated rows, also with equal or NULL ids, are all reported; very long
texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.llm.frame import mix, place, take, text_key, text_slices, texts_of, word_hashes, written

#: Positions of a window that count (1) and that are ignored (0).
MASKS = ("11101011", "1101000111", "1110001011", "1111101")
MIN_WORDS = 13
IDENTITY = 0.8

#: Words of a document that are verified together; an item is laid over such a
#: stretch and its own length on either side.
STRETCH = 4096

#: Bits of the seed filter, and probes per seed. The filter has this size
#: whatever the benchmark; a fuller one lets more seeds through to the join,
#: which decides.
FILTER_BITS = 24
PROBES = 4


def short_masks(n: int) -> tuple[str, ...]:
    """Masks of an item of ``n`` words, fewer than ``MIN_WORDS``. Its first and last word must
    agree: up to 4 words none may differ, up to 9 one may, up to 12 two."""
    if n <= 4:
        return ("1" * n,)
    return ("11011", "10111", "11101") if n == 5 else ("1111", "11011")


def masks_of(n: int) -> tuple[str, ...]:
    """The masks under which an item of ``n`` words is hashed."""
    return () if n == 0 else MASKS if n >= MIN_WORDS else short_masks(n)


def seeds(hashes: np.ndarray, row: np.ndarray, masks: tuple[str, ...]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """For each mask (mask, places of windows, their seed hashes) over the words of a batch."""
    for mask in masks:
        n = len(hashes) - len(mask) + 1
        if n <= 0:
            continue
        total = np.full(n, int(mask, 2), dtype=np.uint64)
        for at, c in enumerate(mask):
            if c == "1":
                total += hashes[at:at + n] * np.uint64(2 * pow(0x9E3779B97F4A7C15, at + 1, 1 << 62) + 1)
        ok = row[:n] == row[len(mask) - 1:]
        yield mask, np.flatnonzero(ok), mix(total[ok])


def _probe(hashes: np.ndarray, number: int) -> np.ndarray:
    return (hashes >> np.uint64(10 * number)) & np.uint64((1 << FILTER_BITS) - 1)


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item_key, words (hashes of all words) and seeds of every item."""
    masks = tuple(dict.fromkeys(m for n in range(MIN_WORDS + 1) for m in masks_of(n)))
    for batch in text_slices(batches):
        yield _seeded(batch, "item_key", masks, None)


def _seeded(batch: pa.RecordBatch, key: str, masks: tuple[str, ...], bits: np.ndarray | None) -> pa.RecordBatch:
    """``key``, words and seeds of rows that have one: without ``bits`` the seeds under each
    row's own masks, else those that pass the filter. A seed comes with its places, by
    ``STRETCH`` of the text."""
    h, _, _, row = word_hashes(texts_of(batch))
    n = batch.num_rows
    first = np.searchsorted(row, np.arange(n + 1))  # a row's first word
    length = np.minimum(np.diff(first), MIN_WORDS)
    rows, places, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
    for mask, at, seed in seeds(h, row, masks):
        if bits is None:
            own = np.array([mask in masks_of(k) for k in range(MIN_WORDS + 1)])
            ok = own[length[row[at]]]
            at, seed = at[ok], seed[ok]
        else:
            for p in range(PROBES):
                at_bit = _probe(seed, p)
                ok = (bits[at_bit >> np.uint64(3)] >> (at_bit & np.uint64(7)).astype(np.uint8)) & 1 != 0
                at, seed = at[ok], seed[ok]
        places.append(at - first[row[at]])
        found.append(seed)
        rows.append(row[at])
    rows, places, found = np.concatenate(rows), np.concatenate(places), np.concatenate(found)
    order = np.lexsort((places, found, rows))
    rows, places, found = rows[order], places[order], found[order]
    part = places // STRETCH
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (found[1:] != found[:-1]) | (part[1:] != part[:-1])
    at = np.flatnonzero(new)
    hit = np.unique(rows)
    words = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.view(np.int64))).take(pa.array(hit))
    seed = pa.StructArray.from_arrays(
        [pa.array(found[at].view(np.int64)), pa.array(part[at].astype(np.int32)),
         pa.ListArray.from_arrays(pa.array(np.append(at, len(rows)).astype(np.int32)), pa.array(places.astype(np.int32)))],
        names=["seed", "part", "places"])
    cuts = np.append(np.searchsorted(rows[at], hit), len(at)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [batch.column(batch.schema.get_field_index(key)).take(pa.array(hit)),
         words, pa.ListArray.from_arrays(pa.array(cuts), seed)], names=[key, "words", "seeds"])


_SEEDED = "words array<bigint>, seeds array<struct<seed:bigint,part:int,places:array<int>>>"


def _filter(item_seeds: DataFrame) -> np.ndarray:
    """The seed filter's bits: at most ``2 ** FILTER_BITS / 32`` words reach the driver."""
    bits = [F.shiftrightunsigned("seed", 10 * p).bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) for p in range(PROBES)]
    words = (item_seeds.select(F.explode(F.array(*bits)).alias("bit"))
             .groupBy(F.shiftright("bit", 5).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 31 as int))")).alias("set")).toArrow())
    out = np.zeros(1 << (FILTER_BITS - 5), dtype="<u4")
    out[words["word"].to_numpy()] = words["set"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)


def best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """(first, length, agreeing words) of the longest stretch that starts and ends with words
    that agree and in which at least ``IDENTITY`` of the words do; of equal ones the first."""
    at = np.flatnonzero(same)
    if not len(at):
        return 0, 0, 0
    # with these weights a stretch has the identity if its sum is not negative
    gain = np.cumsum(np.concatenate([[0], np.where(same, round(100 * (1 - IDENTITY)), -round(100 * IDENTITY))]))
    low = np.minimum.accumulate(gain[at])  # the least sum before any start so far
    k = np.searchsorted(-low, -gain[at + 1], side="left")  # the earliest start that is low enough for an end
    length = at + 1 - at[np.minimum(k, len(at) - 1)]
    best = int(np.argmax(length))
    first = int(at[k[best]])
    return first, int(length[best]), int(same[first:first + length[best]].sum())


def best_overlap(words: np.ndarray, item: np.ndarray, shifts: np.ndarray) -> tuple[int, int, int, int] | None:
    """(matched, length, first word, first word of the item) of the best overlap on the diagonals
    ``shifts`` (in order), or None: most words agree, then shortest, then first."""
    least = min(MIN_WORDS, len(item))
    best = None
    for shift in shifts.tolist():
        skip, at = max(0, -shift), max(0, shift)
        n = min(len(item) - skip, len(words) - at)
        same = words[at:at + n] == item[skip:skip + n]
        if 100 * np.count_nonzero(same) < round(100 * IDENTITY) * least:
            continue
        first, length, matched = best_stretch(same)
        if length < least or 100 * matched < round(100 * IDENTITY) * length:
            continue
        if best is None or (matched, -length, -at - first, skip + first) > (best[0], -best[1], -best[2], best[3]):
            best = matched, length, at + first, skip + first
            if matched == len(item):  # none is better, and those that follow start later
                break
    return best


def _overlap(words: Column, item: Column, offset: Column, hits: Column) -> Column:
    @F.arrow_udf("struct<matched:int,length:int,first:int,item_first:int>")
    def overlap(words: pa.Array, item: pa.Array, offset: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for w, b, start, pairs in zip(words, item, offset.to_pylist(), hits):
            w, b = w.values.to_numpy(), b.values.to_numpy()
            met = np.zeros(len(w) + len(b) + 1, dtype=bool)  # diagonals, the first one at -len(b)
            for place, item_place in zip(*(pairs.values.field(i) for i in range(2))):
                place = place.values.to_numpy() - start + len(b)
                for i in item_place.values.to_numpy():
                    met[place - i] = True
            out.append(best_overlap(w, b, np.flatnonzero(met) - len(b)))
        parts = [pa.array([f and f[i] for f in out], pa.int32()) for i in range(4)]
        return pa.StructArray.from_arrays(parts, names=["matched", "length", "first", "item_first"])
    return overlap(words, item, offset, hits)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item (id and text) that it leaks: ``doc_id,
    text_key, item_id, first_word, item_first_word, n_words, n_matched, coverage``.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. Words are counted from 0
    in the lower-cased text (runs of letters, digits and non-ASCII characters).

    Documents are scanned once. A filter of fixed size, built from the item seeds
    and broadcast, drops seeds that no item has; documents with a seed left are
    written with their word hashes and take part in the joins, texts do not. Copies
    of a text, and of an item, are verified once. A document meets an item by
    stretches of ``STRETCH`` words, cut out before the item joins: however often a
    seed repeats in both, what is carried grows with the document's length.
    """
    spark = docs.sparkSession
    named = take(benchmark, "item_id", "text").select("item_id", text_key(F.col("text")).alias("item_key"), "text")
    items = written(named.select("item_key", "text").dropDuplicates(["item_key"])
                    .mapInArrow(_item_seeds, f"item_key binary, {_SEEDED}"), "items")
    item_seeds = items.select("item_key", F.size("words").alias("item_n"), F.explode("seeds").alias("s")).select(
        "item_key", "item_n", "s.seed", F.col("s.places").alias("item_places"))
    lengths = items.agg(F.collect_set(F.least(F.size("words"), F.lit(MIN_WORDS)))).first()[0]  # MIN_WORDS at most
    masks = tuple(dict.fromkeys(m for n in sorted(lengths) for m in masks_of(n)))
    sent = spark.sparkContext.broadcast(_filter(item_seeds))

    def doc_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            yield _seeded(batch, "row", masks, sent.value)

    rows = take(docs, "doc_id", "text").select(F.struct("doc_id", text_key(F.col("text")).alias("text_key")).alias("row"),
                                               "text")
    suspects = written(rows.mapInArrow(doc_seeds, f"row {dict(rows.dtypes)['row']}, {_SEEDED}")
                       .select("row.*", "words", "seeds"), "suspects")
    one = suspects.dropDuplicates(["text_key"])  # equal texts have equal words and seeds
    pairs = (one.select("text_key", F.explode("seeds").alias("s")).select("text_key", "s.*")
             .join(item_seeds, "seed").groupBy("text_key", "item_key", "item_n", "part")
             .agg(F.collect_list(F.struct("places", "item_places")).alias("hits")))
    offset = F.greatest(F.lit(0), F.col("part") * STRETCH - F.col("item_n"))
    stretch = (pairs.join(one.select("text_key", "words"), "text_key")
               .select("text_key", "item_key", "item_n", "hits", offset.alias("offset"),
                       F.slice("words", offset + 1, F.lit(STRETCH) + 2 * F.col("item_n")).alias("words")))
    laid = (stretch.join(items.select("item_key", F.col("words").alias("item_words")), "item_key")
            .select("text_key", "item_key", "item_n", "offset",
                    _overlap(F.col("words"), F.col("item_words"), F.col("offset"), F.col("hits")).alias("o")))
    leaks = (laid.filter("o.matched is not null")
             .select("text_key", "item_key", F.col("o.matched").alias("n_matched"), F.col("o.length").alias("n_words"),
                     (F.col("offset") + F.col("o.first")).alias("first_word"), F.col("o.item_first").alias("item_first_word"),
                     (F.col("o.matched") / F.col("item_n")).alias("coverage"))
             .groupBy("text_key", "item_key")
             .agg(F.max(F.struct("n_matched", (-F.col("n_words")).alias("short"), (-F.col("first_word")).alias("early"),
                                 "item_first_word", "n_words", "first_word", "coverage")).alias("best")))
    found = written(leaks.join(named.select("item_id", "item_key").distinct(), "item_key"), "leaks")
    return (suspects.select("doc_id", "text_key").join(found, "text_key")
            .select("doc_id", "text_key", "item_id", "best.first_word", "best.item_first_word", "best.n_words",
                    "best.n_matched", "best.coverage"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that leak no item, with the columns of ``docs`` (names may clash)."""
    leaks = written(overlaps(docs, benchmark).select(F.col("doc_id").alias("_leak_id"), F.col("text_key").alias("_leak_key"))
                    .distinct(), "leaking")
    plain = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))
    doc_id, text = (F.col(f"_{place(docs, name)}") for name in ("doc_id", "text"))
    kept = plain.join(leaks, doc_id.eqNullSafe(F.col("_leak_id")) & (text_key(text) == F.col("_leak_key")), "left_anti")
    return kept.toDF(*docs.columns)
