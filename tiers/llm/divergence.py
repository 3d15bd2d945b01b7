"""Source divergence audit: how far each source's use of words is from its peers'.

A group is a (lang, source) that occurs; a language keeps the terms that at least
``MIN_DOCS`` of its documents hold. With ``V`` kept terms and ``N`` occurrences of
them, a group gives each kept term the smoothed share ``p = 1 + floor(SCALE *
(count + 1) / (N + V))``; a language likewise. The divergence of ``p`` from ``q``
at a term is ``floor((p - q)^2 / q)``; all arithmetic is exact.

``pairs`` sums it over all kept terms for every two groups of a language. That is a
sparse product by rows (Gustavson): a group's terms are taken one after another,
each looked up in the term-major index (the groups that have the term), and its
contribution is scattered into a dense accumulator with a place for every peer. No
pair of postings ever becomes a row. What terms add that only one of two groups
has, or none, is the baseline of zero counts: it is added from the group's histogram of
shares, and the scattered contribution holds what has to be corrected.

The index is dealt by term, so a frequent group is spread over all tasks; a task
works through blocks of whole terms (``BLOCK`` postings), an accumulator is as long
as the block's groups, and the blocks' sums meet map-side. Texts are counted in
one map that sums before it shuffles: a hot source costs a row a term and task.

Edge cases: NULL text, language and source count as empty ones; a group without
terms, and a language that keeps none, still have their pairs (value 0 where ``V``
is 0); repeated rows count as documents of their own; an empty table gives none;
other columns, also with clashing names, are ignored; a very long text is one
word list in memory.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiers.llm.frame import take, written

#: Documents of its language that must hold a term.
MIN_DOCS = 3
SCALE = 1_000_000_000
#: Ranks of a group's own terms that are reported.
TOP_TERMS = 200

#: Entries that a task counts before it passes them on; postings of a block of whole terms;
#: contributions scattered at once; peers that one row of baselines takes.
ENTRIES, BLOCK, SCATTER, PEERS = 200_000, 1 << 20, 1 << 18, 4096

#: Terms are runs of letters and of characters beyond ASCII; only A-Z are lower-cased.
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, n_docs``: occurrences and documents of each term in each
    group; each group also has a row with the empty term and no occurrence."""
    docs = take(docs, "lang", "source", "text").fillna("")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict = defaultdict(Counter)
        n_docs: dict = defaultdict(Counter)

        def flush():
            for (lang, source), found in n.items():
                terms = [b"", *found]
                size = len(terms)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * size, pa.string()) for x in (lang, source)]
                    + [pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *found.values()], pa.int64()),
                       pa.array([0, *(n_docs[lang, source][t] for t in found)], pa.int64())],
                    names=["lang", "source", "term", "n", "n_docs"])
            n.clear()
            n_docs.clear()

        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                          batch.column(2).cast(pa.binary())):
                terms = terms_of(text.as_py())
                n[lang, source].update(terms)
                n_docs[lang, source].update(set(terms))
            if sum(map(len, n.values())) > ENTRIES:
                yield from flush()
        yield from flush()
    found = docs.mapInArrow(count, "lang string, source string, term string, n bigint, n_docs bigint")
    # dealt by term, which serves the sums of groups and those of languages
    return (found.repartition("lang", "term").groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")))


def share(count: str, total: str, kept: str) -> Column:
    """The smoothed share of a count; 1 where nothing is kept."""
    large = f"(cast({count} as decimal(19,0)) + 1) * {SCALE} div (cast({total} as decimal(19,0)) + {kept})"
    small = f"({count} + 1L) * {SCALE} div ({total} + {kept})"
    return F.expr(f"case when {kept} = 0 then 1L when {count} < 9000000000L then 1L + {small} else 1L + {large} end")


class Audit:
    """Group shares of a table of documents, ready for both reports (written tables)."""

    def __init__(self, docs: DataFrame):
        term = Window.partitionBy("lang", "term")
        own = (term_counts(docs).withColumns({
            "lang_n": F.sum("n").over(term), "lang_docs": F.sum("n_docs").over(term),
            "leads": F.col("source") == F.min("source").over(term)})
            .filter(f"lang_docs >= {MIN_DOCS} or term = ''").drop("n_docs", "lang_docs"))
        own = written(own, "divergence/kept")
        kept = own.filter("term <> ''")
        langs = kept.filter("leads").groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
        totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = (own.filter("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left")
                  .join(langs, "lang", "left").fillna(0, ["total", "v", "lang_total"]))
        #: lang, source, v, lang_total, total, p0 (share of a term the group lacks)
        self.groups = written(groups.withColumn("p0", share("0", "total", "v")), "divergence/groups")
        #: lang, source, term, p, p0, and the language's share q
        self.postings = written(
            kept.join(self.groups, ["lang", "source"]).select(
                "lang", "source", "term", share("n", "total", "v").alias("p"), "p0",
                share("lang_n", "lang_total", "v").alias("q")), "divergence/postings")

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """Each group's terms that it uses more than its language, by divergence: ``lang, source,
        item, value, rank`` up to a rank."""
        found = self.postings.filter("p > q").select(
            "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
        return _ranked(found).filter(F.col("rank") <= top)

    def pairs(self) -> DataFrame:
        """Every ordered pair of groups of a language: ``lang, source, item`` (the other source), ``value, rank``."""
        parts = self._baselines().unionByName(self._scattered())
        sums = (parts.groupBy("lang", "source", "item")
                .agg(F.sum(F.col("value").cast("decimal(20,0)")).cast("bigint").alias("value")))
        return _ranked(sums)

    def _baselines(self) -> DataFrame:
        """What pairs would come to if no term were in both groups of one."""
        shares = (self.postings.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
                  .groupBy("lang", "source").agg(F.collect_list(F.struct("p", "k")).alias("h")))
        sizes = self.groups.groupBy("lang").agg((F.count("*") / PEERS).cast("bigint").alias("more"))
        peers = (self.groups.join(sizes, "lang")
                 .groupBy("lang", F.expr("pmod(xxhash64(source), more + 1)").alias("block"))
                 .agg(F.collect_list("source").alias("peers"), F.collect_list("p0").alias("peers_p0")))
        rows = (self.groups.select("lang", "source", "v", "p0").join(shares, ["lang", "source"], "left")
                .select("lang", "source", "v", "p0", F.coalesce("h.p", F.array().cast("array<bigint>")).alias("p"),
                        F.coalesce("h.k", F.array().cast("array<bigint>")).alias("k"))
                .join(peers.drop("block"), "lang"))
        return rows.mapInArrow(_add_baselines, "lang string, source string, item string, value bigint")

    def _scattered(self) -> DataFrame:
        rows = (self.postings.select("lang", "term", "source", "p", "p0").repartition("lang", "term")
                .sortWithinPartitions("lang", "term"))
        return rows.mapInArrow(_scatter, "lang string, source string, item string, value bigint")


def _ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return df.withColumn("rank", F.row_number().over(order))


def _f(p, q):
    return (p - q) * (p - q) // q


def _rows(lang, source, item, value) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (lang, source, item)]
                                      + [pa.array(value, pa.int64())], names=["lang", "source", "item", "value"])


def _add_baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a group and its peers: all terms at both baselines, and what the group's own terms
    add over that, as the pair's first and as its second."""
    for batch in batches:
        for r in range(batch.num_rows):
            lang, source, v, p0 = (batch.column(i)[r].as_py() for i in range(4))
            p, k = (batch.column(i)[r].values.to_numpy() for i in (4, 5))
            names = batch.column(6)[r].as_py()
            q0 = batch.column(7)[r].values.to_numpy()
            step = max(1, SCATTER // max(1, len(p)))
            first, second = [], []
            for a in range(0, len(q0), step):
                q = q0[a:a + step, None]
                both = _f(p0, q[:, 0])
                first.append(v * both + ((_f(p[None, :], q) - both[:, None]) * k).sum(axis=1))
                second.append(((_f(q, p[None, :]) - _f(q[:, 0], p0)[:, None]) * k).sum(axis=1))
            other = np.array([x != source for x in names])
            names = [x for x, o in zip(names, other) if o]
            if names:
                size = len(names)
                yield _rows([lang] * size, [source] * size, names, np.concatenate(first)[other])
                yield _rows([lang] * size, names, [source] * size, np.concatenate(second)[other])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted postings in tables of whole terms of about ``BLOCK`` rows."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= BLOCK:
            table = pa.Table.from_batches(held).combine_chunks()
            new = _changes(table)
            if len(new) > 1:  # the last term may go on
                yield table.slice(0, new[-1])
                held = table.slice(new[-1]).to_batches()
                size = sum(b.num_rows for b in held)
    if size:
        yield pa.Table.from_batches(held).combine_chunks()


def _changes(table: pa.Table) -> np.ndarray:
    """First row of each term."""
    other = [pc.not_equal(table[c].slice(1), table[c].slice(0, table.num_rows - 1)).to_numpy() for c in ("lang", "term")]
    return np.concatenate([[0], np.flatnonzero(other[0] | other[1]) + 1])


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's groups row by row: each term of the group is looked up in the index, and what
    the term adds over the baselines goes to the accumulator's place of each peer that has it."""
    for block in _blocks(batches):
        first = _changes(block)
        size = np.diff(np.append(first, block.num_rows))
        term = np.repeat(np.arange(len(first)), size)
        names = [block[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
        names = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in names]
        lang, source = (x.indices.to_numpy().astype(np.int64) for x in names)
        codes, group = np.unique(lang * len(names[1].dictionary) + source, return_inverse=True)
        lang_of = names[0].dictionary.take(pa.array(codes // len(names[1].dictionary))).to_pylist()
        source_of = names[1].dictionary.take(pa.array(codes % len(names[1].dictionary))).to_pylist()
        p, p0 = block["p"].to_numpy(), block["p0"].to_numpy()
        by_group = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group, minlength=len(codes)))
        for g, (a, b) in enumerate(zip(np.append(0, ends), ends)):
            acc = np.zeros(len(codes), dtype=np.int64)
            row = by_group[a:b]
            reach = np.cumsum(size[term[row]])
            for part in np.split(row, np.flatnonzero(np.diff(reach // SCATTER)) + 1):
                n = size[term[part]]
                at = np.arange(n.sum()) + np.repeat(first[term[part]] - np.cumsum(n) + n, n)
                pg, p0g, q, q0 = np.repeat(p[part], n), p0[part[0]], p[at], p0[at]
                np.add.at(acc, group[at], _f(pg, q) - _f(pg, q0) - _f(p0g, q) + _f(p0g, q0))
            acc[g] = 0
            met = np.flatnonzero(acc)
            if len(met):
                yield _rows([lang_of[g]] * len(met), [source_of[g]] * len(met), [source_of[h] for h in met], acc[met])
