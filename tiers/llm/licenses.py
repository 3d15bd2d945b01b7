"""License scans: winnowed fingerprints pick candidates, banded alignment reports them.

Templates are cut into word k-grams whose hashes are winnowed (of every window
of hashes the smallest stays); an inverted index leads from a fingerprint to the
templates and places that have it. Documents are winnowed alike, so a shared run
of ``GRAM + WINDOW - 1`` words always shares a fingerprint. Hits of one template on
nearby diagonals form a candidate region, and a banded local alignment of
template and region tells how much of the template is there and where. A copy must
agree with its template in the words that tell licenses apart (names, versions),
and of overlapping copies the one with most words in line stays.

The index is a parameter's size (the templates), is checked against
``MAX_TEMPLATE_WORDS`` and is broadcast. One scan, no shuffle: every document is
judged alone.

Edge cases: NULL and empty texts hold no license; templates with fewer than
``GRAM`` words are refused; repeated rows and repeated notices are each reported;
very long texts are scanned whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tiers.llm.frame import mix, take, text_slices, texts_of, word_hashes
from tiers.llm.license_texts import KEY_NUMBERS, KEY_WORDS, TEMPLATES

#: Words of a gram, and grams of a winnowing window.
GRAM, WINDOW = 3, 3
#: Words by which a copy may gain or lose against its template inside one region.
BAND = 16
MIN_COVERAGE = 0.8
MAX_TEMPLATE_WORDS = 1_000_000

#: Scores of the alignment: a word that agrees, one that differs, one that is extra or missing.
SAME, DIFFERS, GAP = 2, -1, -1


_KEYS = tuple(frozenset(word_hashes(pa.array([" ".join(k)]))[0].tolist()) for k in (KEY_WORDS, KEY_NUMBERS))


def agrees(template: set[int], text: set[int]) -> bool:
    """Whether a copy's words have the template's telling words, and of a kind it has no others."""
    return all(not (own := template & kind) or own == text & kind for kind in _KEYS)


def best(found: list[tuple]) -> list[tuple]:
    """Of (first, end, matched, template, size) that overlap the one with most words in line,
    then with the highest coverage; in order of place."""
    kept: list[tuple] = []
    for x in sorted(found, key=lambda f: (-f[2], f[4], f[1] - f[0], f[0], f[3])):
        at = bisect_left(kept, x)
        if (at == 0 or kept[at - 1][1] <= x[0]) and (at == len(kept) or x[1] <= kept[at][0]):
            kept.insert(at, x)
    return kept


def winnow(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the fingerprints of a batch of word sequences: in every
    window of ``WINDOW`` grams of a row the smallest hash, the last of equal ones.
    A row with fewer grams keeps the smallest of those it has."""
    n = len(h) - GRAM + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    gram = h[:n].copy()
    for i in range(1, GRAM):
        gram = mix(gram * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n])
    at = np.flatnonzero(row[:n] == row[GRAM - 1:])
    gram, of = gram[at], row[at]
    best = np.arange(len(at))
    count = np.bincount(of, minlength=int(of[-1]) + 1 if len(of) else 0)[of] if len(of) else of
    first = np.searchsorted(of, of)  # the row's first gram
    place = np.arange(len(at)) - first
    for i in range(1, WINDOW):  # best of the window that starts here
        j = np.minimum(np.arange(len(at)) + i, len(at) - 1)
        inside = (of[j] == of) & (np.arange(len(at)) + i < len(at))
        best = np.where(inside & (gram[j] <= gram[best]), j, best)
    full = (place + WINDOW <= count) | (place == 0)  # a short row has one window
    keep = np.unique(best[full])
    return at[keep], gram[keep]


@dataclass(frozen=True)
class Index:
    """Fingerprints in order, with the template and the place each one comes from."""

    hashes: np.ndarray
    template: np.ndarray
    place: np.ndarray
    words: tuple[np.ndarray, ...]
    names: tuple[str, ...]


def index(templates: Sequence[tuple[str, str]] = TEMPLATES) -> Index:
    """The inverted index of (license, text) templates."""
    h, _, _, row = word_hashes(pa.array([t for _, t in templates], pa.string()))
    words = tuple(h[row == i] for i in range(len(templates)))
    if len(h) > MAX_TEMPLATE_WORDS or any(len(w) < GRAM for w in words):
        raise ValueError(f"templates need {GRAM} words each and {MAX_TEMPLATE_WORDS} at most in all")
    at, hashes = winnow(h, row)
    order = np.argsort(hashes, kind="stable")
    first = np.searchsorted(row, np.arange(len(templates)))
    return Index(hashes[order], row[at][order], (at - first[row[at]])[order], words, tuple(n for n, _ in templates))


def _regions(ix: Index, h: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row, template, first word, end, own, own end) of the candidate regions of a batch.

    Hits whose templates would start within ``BAND`` words of a region's first belong to
    it, so a region is no longer than its template and three bands. Regions overlap;
    a copy belongs to the one in whose own stretch it starts."""
    at, hashes = winnow(h, row)
    low = np.searchsorted(ix.hashes, hashes, side="left")
    n = np.searchsorted(ix.hashes, hashes, side="right") - low
    entry = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(at, n)
    if not len(at):
        return
    template = ix.template[entry]
    begin = at - ix.place[entry]  # where the template would start
    of = row[at]
    first, last = np.searchsorted(row, of, side="left"), np.searchsorted(row, of, side="right")
    order = np.lexsort((begin, template, of))
    groups: dict[tuple[int, int], list] = {}
    for r, t, b, a, z in zip(*(x[order].tolist() for x in (of, template, begin, first, last))):
        found = groups.setdefault((r, t), [])
        if found and b - found[-1][0] <= BAND:
            found[-1][1] = b
        else:
            found.append([b, b, a, z])
    for (r, t), found in groups.items():
        size = len(ix.words[t])
        own = [max(a, b - BAND) for b, _, a, _ in found]
        for (b, e, a, z), lo, hi in zip(found, own, [*own[1:], found[-1][3]]):
            yield r, t, max(a, b - BAND), min(z, e + size + BAND), lo, hi


def align(template: np.ndarray, text: np.ndarray, band: int) -> tuple[int, int, int]:
    """(first word, end, words that agree) of the best local alignment whose diagonals lie
    in the band: template word i meets text words i - band .. i + len(text) - len(template) + band."""
    low = -band
    width = max(1, len(text) - len(template) + 2 * band + 1)
    cols = np.arange(width)
    score = np.zeros(width, dtype=np.int64)
    start = cols + low  # text word at which the cell's alignment starts
    same_n = np.zeros(width, dtype=np.int64)
    best = (0, 0, 0, 0)
    for i, w in enumerate(template):
        at = i + low + cols  # column c of row i is text word i + low + c
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, dtype=bool)
        same[inside] = text[at[inside]] == w
        diag = np.where(inside, score + np.where(same, SAME, DIFFERS), 0)
        fresh = score <= 0  # an alignment starts here
        d_start, d_same = np.where(fresh, at, start), np.where(fresh, 0, same_n) + same
        up = np.append(score[1:], 0) + GAP  # a template word that the text lacks
        take_up = up > diag
        value = np.where(take_up, up, diag)
        begin = np.where(take_up, np.append(start[1:], 0), d_start)
        agree = np.where(take_up, np.append(same_n[1:], 0), d_same)
        slack = value - GAP * cols  # extra text words: the best cell to the left, less their gaps
        reach = np.maximum.accumulate(slack)
        source = np.maximum.accumulate(np.where(slack == reach, cols, 0))
        left = reach + GAP * cols
        use = left > value
        score = np.maximum(0, np.where(use, left, value))
        start, same_n = np.where(use, begin[source], begin), np.where(use, agree[source], agree)
        c = int(np.argmax(score))
        if score[c] > best[0]:
            best = (int(score[c]), int(start[c]), int(at[c]) + 1, int(same_n[c]))
    return best[1], best[2], best[3]


def copies(template: np.ndarray, text: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """All alignments of a template in a text, one after the other, with ``least`` words that agree."""
    found, open_ = [], [(0, len(text))]
    while open_:
        a, z = open_.pop()
        if z - a < GRAM:
            continue
        first, end, matched = align(template, text[a:z], 2 * BAND)
        if matched >= least:
            found.append((a + first, a + end, matched))
            open_ += [(a, a + first), (a + end, z)]
    return sorted(found)


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
         min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """``doc_id, license, template, first_word, end_word, first_byte, end_byte, n_matched, coverage``:
    a row for every place where a row of ``docs`` (doc_id, text) has at least ``min_coverage``
    of a template's words in line and its telling words; of overlapping places the best.

    Words count from 0; bytes are offsets in the lower-cased UTF-8 text.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(index(templates))
    rows = take(docs, "doc_id", "text")
    id_type = dict(rows.dtypes)["doc_id"]

    def copied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = sent.value
        words = [set(w.tolist()) for w in ix.words]
        keys = [{k for kind in _KEYS for k in w & kind} for w in words]
        for batch in text_slices(batches):
            h, start, end, row = word_hashes(texts_of(batch))
            of_row: dict[int, list[tuple]] = {}
            for r, t, a, z, own, own_end in _regions(ix, h, row):
                text = h[a:z].tolist()
                if not keys[t] <= set(text):  # no copy here can agree
                    continue
                for b, e, matched in copies(ix.words[t], h[a:z], min_coverage * len(ix.words[t])):
                    if own <= a + b < own_end and agrees(words[t], set(text[b:e])):
                        of_row.setdefault(r, []).append((a + b, a + e, matched, t, len(ix.words[t])))
            found = [(r, *x) for r in sorted(of_row) for x in best(of_row[r])]
            r, a, z, matched, t, size = (np.array([f[i] for f in found], dtype=np.int64) for i in range(6))
            first = np.searchsorted(row, r)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(r)), pa.array([ix.names[i] for i in t], pa.string()),
                 *(pa.array(x, pa.int32()) for x in (t, a - first, z - first)), pa.array(start[a]), pa.array(end[z - 1]),
                 pa.array(matched, pa.int32()), pa.array(matched / size, pa.float64())],
                names=["doc_id", "license", "template", "first_word", "end_word", "first_byte", "end_byte", "n_matched",
                       "coverage"])

    return rows.mapInArrow(copied, f"doc_id {id_type}, license string, template int, first_word int, end_word int, "
                                   "first_byte bigint, end_byte bigint, n_matched int, coverage double")
