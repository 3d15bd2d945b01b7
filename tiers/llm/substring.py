"""Substring dedup: relative Lempel-Ziv parsing of documents against indexed blocks of the corpus.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window
that covers it also stands in a document with a smaller id; windows are judged on
the input, so what is removed elsewhere does not matter.

* **Pieces.** Every window chooses the least-hashed run of ``GRAM`` words in it (its
  anchor); neighbouring windows with one anchor are one piece of the document.
  Equal windows choose equal anchors wherever they stand, so a piece needs to be
  compared only with pieces of its own anchor. Pieces of one wording are one form:
  only its smallest document is parsed, in every other one the whole form is
  repeated. Copies of a document, however many, cost a row a piece.
* **Blocks.** Forms of anchors that several wordings share are dealt by anchor and
  indexed block by block: a suffix array with the smallest id over its ranges.
  Every form of the block is factored greedily: the longest match with a smaller
  document from where the last factor ended.
* **Spans.** A factor of ``WINDOW`` words or more is a repeated span. A repeated window that no
  factor holds crosses one factor boundary, and the factor behind the boundary
  reaches to its end or past it (the match is the longest); only such windows are looked up.
* An anchor with more than ``HOT`` forms (a short passage in very many documents) is
  not gathered: its windows themselves become keys, with the smallest id that has
  them, summed map-side. Its words are cut in the same pass over the texts as the others'.

Texts are joined with what is asked of them, and with what goes, by the same sorted
merge at every size. Words and windows are compared by 64-bit hashes, an anchor's and a wording's together.

Edge cases: NULL, empty and short texts keep all words (none, if there are none); a
NULL id is neither smaller nor larger than any: such rows keep all words and take none
away; rows of one id take nothing from each other, each is held against smaller ids;
an empty table gives an empty table; other columns, also with clashing names, are
ignored; a very long text is cut into pieces like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.frame import _powers, array_slices, mix, take, texts_of, written

WINDOW, GRAM = 50, 12
#: Forms of an anchor that are parsed in one block; words of a block of whole anchors.
HOT, BLOCK = 2000, 1 << 18

_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_SALT = np.uint64(0xA0761D6478BD642F)


# ---- words and pieces ------------------------------------------------------------

def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of a batch of texts, and the first word of each text (one more at the end)."""
    texts = texts.cast(pa.large_binary())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    if n == 0 or texts.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint64), np.zeros(n + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    inside = _IS_WORD[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    starts[firsts] = inside[firsts]  # a text never goes on with the word before it
    ends = np.zeros(len(data) + 1, dtype=bool)
    ends[1:] = inside
    ends[1:-1] &= ~inside[1:] | starts[1:]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends)
    power, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    return mix((sums[to] - sums[at]) * inverse[at]), np.searchsorted(at, offsets)


def pieces_of(words: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """(row, anchor, form, first window, number of windows) of every piece of a batch."""
    n = len(words)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if n < window:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    power, inverse = _powers(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(words * power[:n], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[:n - gram + 1])
    # the place of the least gram of every window, the first of equal ones
    width, least, have = window - gram + 1, np.arange(len(grams)), 1
    while have < width:
        step = min(have, width - have)
        a, b = least[:-step], least[step:]
        least = np.where(grams[a] <= grams[b], a, b)
        have += step
    start = np.arange(n - window + 1)
    whole = start + window <= first[1:][row[:len(start)]]
    new = whole.copy()
    new[1:] &= ~whole[:-1] | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    size = np.diff(np.append(np.cumsum(whole)[at] - 1, whole.sum()))
    end = at + size + window - 1
    form = mix((sums[end] - sums[at]) * inverse[at] + _SALT * ((least[at] - at) * 4096 + size).astype(np.uint64))
    return row[at], grams[least[at]], form, at - first[row[at]], size


# ---- parsing a block -------------------------------------------------------------

class Block:
    """Suffix array of the forms of a block, and for any range of it the smallest document."""

    def __init__(self, words: np.ndarray, size: np.ndarray, doc: np.ndarray):
        """``words`` of all forms one after another, the words and the document of each form."""
        self.size = size
        self.begin = np.cumsum(size + 1) - size - 1  # every form has an end mark of its own
        n = int(size.sum()) + len(size)
        marks = self.begin + size
        symbol = np.empty(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[marks] = False
        symbol[inside] = np.unique(words, return_inverse=True)[1]
        symbol[marks] = len(words) + np.arange(len(size))
        self.doc = np.repeat(np.unique(doc, return_inverse=True)[1], size + 1)
        # ranks of the first 1, 2, 4 .. words from every place, until all differ
        self.rank = [np.unique(symbol, return_inverse=True)[1]]
        while 1 << (len(self.rank) - 1) <= size.max(initial=0):
            last, h = self.rank[-1], 1 << (len(self.rank) - 1)
            nxt = np.zeros(n, dtype=np.int64)
            nxt[:-h or None] = last[h:] + 1
            self.rank.append(np.unique(last * (n + 1) + nxt, return_inverse=True)[1])
        self.suffix = np.argsort(self.rank[-1], kind="stable")
        self.place = np.empty(n, dtype=np.int64)
        self.place[self.suffix] = np.arange(n)
        # least[k][i]: smallest document of 2^k suffixes from i on
        self.least = [self.doc[self.suffix]]
        while 2 << (len(self.least) - 1) <= n:
            last, h = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-h], last[h:]))

    def _nearest(self, at: np.ndarray, forward: bool) -> np.ndarray:
        """The nearest suffix on one side whose document is smaller; -1 if there is none."""
        place, doc, n = self.place[at].copy(), self.doc[at], len(self.suffix)
        for k in range(len(self.least) - 1, -1, -1):
            h = 1 << k
            start = place + 1 if forward else place - h
            fits = (start + h <= n) if forward else (start >= 0)
            skip = fits & (self.least[k][np.where(fits, start, 0)] >= doc)
            place = np.where(skip, place + h if forward else place - h, place)
        place = place + 1 if forward else place - 1
        return np.where((place >= 0) & (place < n), self.suffix[np.clip(place, 0, n - 1)], -1)

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the texts from two places on have in common."""
        n, length = len(self.suffix), np.zeros(len(a), dtype=np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            x, y = np.minimum(a + length, n - 1), np.minimum(b + length, n - 1)
            length += (self.rank[k][x] == self.rank[k][y]) << k
        return np.where(b >= 0, length, 0)

    def match(self, at: np.ndarray) -> np.ndarray:
        """The longest match with a smaller document from each place on."""
        found = [self._nearest(at, forward) for forward in (False, True)]
        return np.maximum(*(self._common(at, np.where(b < 0, at, b)) * (b >= 0) for b in found))

    def parse(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Greedy factors of all forms: (form, place, length); 0 where no smaller document has the word."""
        at, form, out = self.begin.copy(), np.arange(len(self.begin)), []
        open_ = self.size > 0
        at, form = at[open_], form[open_]
        while len(at):
            length = self.match(at)
            out.append((form, at, length))
            at = at + np.maximum(length, 1)
            open_ = at < self.begin[form] + self.size[form]
            at, form = at[open_], form[open_]
        form, at, length = (np.concatenate(x) if out else np.zeros(0, dtype=np.int64) for x in (zip(*out) if out else ([],) * 3))
        order = np.argsort(at)
        return form[order], at[order], length[order]

    def repeated(self, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(form, first, last) window, counted inside the form, of repeated stretches of windows."""
        form, at, length = self.parse()
        whole = length >= window
        # windows that start inside a factor and end inside the next one
        same = np.flatnonzero(form[1:] == form[:-1]) if len(form) else np.zeros(0, dtype=np.int64)
        low = at[same] + 1
        n = np.maximum(np.minimum(at[same + 1] - 1, at[same + 1] + length[same + 1] - window) - low + 1, 0)
        n[length[same] + length[same + 1] <= window] = 0
        across = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        hit = self.match(across) >= window
        across, owner = across[hit], np.repeat(form[same], n)[hit]
        form = np.concatenate([form[whole], owner])
        first = np.concatenate([at[whole], across]) - self.begin[form]
        last = np.concatenate([at[whole] + length[whole] - window, across]) - self.begin[form]
        return form, first, last


# ---- Spark -----------------------------------------------------------------------

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for texts in array_slices(texts_of(batch)):
            row, anchor, form, first, n = pieces_of(*word_hashes(texts))
            at = pa.array(row + done)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(anchor.view(np.int64)),
                 pa.array(form.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["doc_id", "row_key", "anchor", "form", "first", "n"])
            done += len(texts)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of the pieces that are asked of each document."""
    for batch in batches:
        asked = batch.column(batch.schema.get_field_index("asked"))
        for i in range(batch.num_rows):
            words, _ = word_hashes(pa.array([batch.column(batch.schema.get_field_index("text"))[i].as_py()]))
            want = pa.RecordBatch.from_struct_array(asked[i].values)
            cut = [words[a:a + n + WINDOW - 1].tobytes() for a, n in zip(want["first"].to_pylist(), want["n"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [want["anchor"], want["form"], batch.column(0).take(pa.array([i] * len(cut))), want["n"], want["hot"],
                 pa.array(cut, pa.binary())], names=["anchor", "form", "doc_id", "n", "hot", "words"])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole anchors of about ``BLOCK`` words, from rows sorted by anchor."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += pc.sum(batch["n"]).as_py() + batch.num_rows * WINDOW
        if size >= BLOCK:
            table = pa.Table.from_batches(held).combine_chunks()
            anchor = table["anchor"].to_numpy()
            cut = int(np.searchsorted(anchor, anchor[-1]))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                size = sum(pc.sum(b["n"]).as_py() + b.num_rows * WINDOW for b in held)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the forms that are parsed; those of hot anchors, which are sorted last, go through."""
    batches, hot = iter(batches), []

    def parsed() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows - (pc.sum(batch["hot"]).as_py() or 0)
            if n:
                yield batch.slice(0, n)
            if n < batch.num_rows:
                hot.append(batch.slice(n))
                return

    for table in _blocks(parsed()):
        cut = table["words"].to_pylist()
        size = np.array([len(x) // 8 for x in cut])
        block = Block(np.frombuffer(b"".join(cut), dtype=np.uint64), size, table["doc_id"].to_numpy())
        form, first, last = block.repeated()
        if len(form):
            found = table.select(["anchor", "form"]).take(pa.array(form)).combine_chunks()
            found = found.append_column("low", pa.array(first.astype(np.int32))).append_column("high", pa.array(last.astype(np.int32)))
            for name in ("doc_id", "n", "words"):
                found = found.append_column(name, pa.nulls(len(form), table.schema.field(name).type))
            yield from found.to_batches()
    for batch in chain(hot, batches):
        none = pa.nulls(batch.num_rows, pa.int32())
        yield pa.RecordBatch.from_arrays([batch["anchor"], batch["form"], none, none, batch["doc_id"], batch["n"], batch["words"]],
                                         names=["anchor", "form", "low", "high", "doc_id", "n", "words"])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that a document's repeated windows cover, as few spans."""
    for batch in batches:
        spans = []
        for found in batch.column(2):
            merged: list[list[int]] = []
            for low, high in sorted((x["low"], x["high"] + WINDOW) for x in found.as_py()):
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(high, merged[-1][1])
                else:
                    merged.append([low, high])
            spans.append([{"start": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, _SPANS)],
                                         names=["doc_id", "row_key", "spans"])


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        spans = batch.column(2).to_pylist()
        for text, found in zip(batch.column(1).cast(pa.binary()), spans):
            words = (text.as_py() or b"").split()
            left, end = [], 0
            for span in found or ():
                left += words[end:span["start"]]
                end = span["end"]
            left += words[end:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array([x or [] for x in spans], _SPANS), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "spans", "kept"])


def _hot_spans(cut: DataFrame) -> DataFrame:
    """Repeated windows of anchors with very many forms: the smallest document of each window decides."""
    windows = written(
        cut.withColumn("low", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .select("anchor", "form", "doc_id", "low",
                F.xxhash64(F.expr(f"substring(words, 8 * low + 1, {8 * WINDOW})")).alias("window")), "substring/hot")
    smallest = written(windows.groupBy("anchor", "window").agg(F.min("doc_id").alias("owner")), "substring/hot_owners")
    return (windows.join(smallest, ["anchor", "window"]).filter("doc_id > owner")
            .select("anchor", "form", "low", F.col("low").alias("high")))


def remove_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept`` of every document: the spans of words that
    repeat a smaller document's, and the words that are left, joined by one space."""
    docs = take(docs, "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = docs.filter("doc_id is not null").withColumn("row_key", F.xxhash64("text"))
    pieces = written(known.select("doc_id", "row_key", "text").mapInArrow(
        _pieces, f"doc_id {kind}, row_key bigint, anchor bigint, form bigint, first int, n int"), "substring/pieces")
    shared = written(pieces.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
                     .filter("low < high").select("anchor"), "substring/shared")
    pieces = written(pieces.join(shared, "anchor", "left_semi"), "substring/shared_pieces")
    forms = written(pieces.groupBy("anchor", "form").agg(
        F.min(F.struct("doc_id", "row_key", "first", "n")).alias("at"), F.max("doc_id").alias("last"))
        .select("anchor", "form", "at.*", "last"), "substring/forms")
    several = written(
        forms.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("forms"))
        .filter("low < high").drop("low", "high"), "substring/several")
    wanted = written(forms.drop("last").join(several, "anchor"), "substring/wanted")

    asked = (wanted.groupBy("doc_id", "row_key")
             .agg(F.collect_list(F.struct("anchor", "form", "first", "n", (F.col("forms") > hot).alias("hot"))).alias("asked")))
    # one pass over the texts for both kinds; the forms of a hot anchor are dealt one by one
    words = (known.join(asked.hint("merge"), ["doc_id", "row_key"]).select("doc_id", "text", "asked")
             .mapInArrow(_cut, f"anchor bigint, form bigint, doc_id {kind}, n int, hot boolean, words binary"))
    found = written(words.repartition("anchor", F.expr("if(hot, form, null)")).sortWithinPartitions("hot", "anchor").mapInArrow(
        _parse, f"anchor bigint, form bigint, low int, high int, doc_id {kind}, n int, words binary"), "substring/found")
    parsed = found.filter("words is null").select("anchor", "form", "low", "high")
    if not wanted.filter(f"forms > {hot}").isEmpty():
        parsed = parsed.unionByName(_hot_spans(found.filter("words is not null").drop("low", "high")))
    parsed = parsed.groupBy("anchor", "form").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    # a table of its own: the join below then has plain inputs, and a form with very many copies can be split
    repeated = written(forms.withColumnRenamed("doc_id", "owner").select("anchor", "form", "owner", "last")
                       .join(parsed, ["anchor", "form"], "left").filter("last > owner or spans is not null").drop("last"),
                       "substring/repeated")
    whole = F.array(F.struct(F.col("first").alias("low"), (F.col("first") + F.col("n") - 1).alias("high")))
    part = F.transform("spans", lambda s: F.struct((s["low"] + F.col("first")).alias("low"),
                                                   (s["high"] + F.col("first")).alias("high")))
    removed = (pieces.join(repeated, ["anchor", "form"])
               .select("doc_id", "row_key", F.when(F.col("doc_id") > F.col("owner"), whole).otherwise(part).alias("spans"))
               .filter("spans is not null").groupBy("doc_id", "row_key")
               .agg(F.flatten(F.collect_list("spans")).alias("spans")))
    removed = written(removed.mapInArrow(_merge, f"doc_id {kind}, row_key bigint, spans array<struct<start:bigint,end:bigint>>"),
                      "substring/removed")
    judged = known.join(removed.hint("merge"), ["doc_id", "row_key"], "left").select("doc_id", "text", "spans")
    unknown = docs.filter("doc_id is null").withColumn("spans", F.lit(None).cast(judged.schema["spans"].dataType))
    return judged.unionByName(unknown).mapInArrow(
        _keep, f"doc_id {kind}, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept string")
