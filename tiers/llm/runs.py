"""Periodic runs of words: found in a Re-Pair grammar of each document.

A run is a stretch of consecutive words whose smallest period is ``q`` (words
``q`` apart are identical), at least ``max(SHORTEST, EXPONENT * q)`` words long,
that no neighbouring word extends keeping the period.

Re-Pair replaces the most frequent pair of neighbouring symbols by a new one
until no pair occurs twice; what is left of the text becomes the start rule, cut
in halves. A run inside a text crosses the boundary of exactly one lowest node of
the derivation. The runs that cross the boundary of a rule's two sides are
computed once for the rule, at its first occurrence, and translated to each place
where the derivation has that rule. What an outer rule shows to go on is merged.

A run that crosses a boundary has two of its periods on one side of it, so only
square prefixes (of the right side) and square suffixes (of the left side) can be
its periods. They are enumerated in ascending order; inside one that is already
known, no other primitive one starts (periodicity lemma), so there are few.

One map over the documents: nothing is shuffled, a task holds one document's
grammar at a time. Edge cases: NULL, empty and blank texts have no words and no
run; an empty table gives an empty table; repeated rows and NULL ids each give
their own row; other columns, also with clashing names, are ignored; a very long
text takes memory in proportion to its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.llm.frame import take

#: A run has at least this many words, and at least this many of its periods.
SHORTEST, EXPONENT = 6, 4

RUNS = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_GONE = -1


def words_of(text: bytes | None) -> list[bytes]:
    """The words of a text: runs of anything but space and the characters 9 to 13."""
    return text.split() if text else []


# ---- grammar ----------------------------------------------------------------

class Grammar:
    """Re-Pair grammar of a sequence of word numbers ``0 .. n_terminals - 1``.

    ``rules[k]`` is (left symbol, right symbol, first place) of symbol
    ``n_terminals + k``; ``size`` the words a symbol stands for; ``start`` the
    places and symbols that are left.
    """

    def __init__(self, word: list[int], n_terminals: int):
        self.n_terminals = n_terminals
        self.rules: list[tuple[int, int, int]] = []
        self.size = [1] * n_terminals
        self.start = self._reduce(list(word))

    def _reduce(self, symbol: list[int]) -> list[tuple[int, int]]:
        n = len(symbol)
        pairs = list(zip(symbol, symbol[1:]))
        counts = Counter(pairs)
        places: dict[tuple[int, int], list[int]] = {p: [] for p, c in counts.items() if c > 1}
        if places:
            for i, p in enumerate(pairs):
                if p in places:
                    places[p].append(i)
            after = list(range(1, n + 1))
            before = list(range(-1, n - 1))
            # most frequent first, ties in order of appearance
            queue = [(-len(at), k, p) for k, (p, at) in enumerate(places.items())]
            heapify(queue)
            serial = len(queue)
            while queue:
                known, _, pair = heappop(queue)
                at = self._valid(pair, places[pair], symbol, after, n)
                if len(at) < 2:
                    del places[pair]
                    continue
                places[pair] = at
                if len(at) < -known:  # replacements took some since: back to its rank
                    heappush(queue, (-len(at), serial, pair))
                    serial += 1
                    continue
                for new in self._replace(pair, at, symbol, before, after, places, n):
                    if len(places[new]) > 1:
                        heappush(queue, (-len(places[new]), serial, new))
                        serial += 1
                    else:
                        del places[new]
        return [(i, s) for i, s in enumerate(symbol) if s != _GONE]

    @staticmethod
    def _valid(pair, at, symbol, after, n):
        """The places where a pair still stands, without overlaps."""
        a, b = pair
        if a != b:
            return [i for i in at if symbol[i] == a and after[i] < n and symbol[after[i]] == b]
        out, end = [], -1
        for i in sorted(at):
            if i >= end and symbol[i] == a and after[i] < n and symbol[after[i]] == a:
                out.append(i)
                end = after[after[i]]
        return out

    def _replace(self, pair, at, symbol, before, after, places, n):
        """Put a new symbol at the places; the pairs that arise, with their places noted."""
        a, b = pair
        new = len(self.size)
        self.rules.append((a, b, min(at)))
        self.size.append(self.size[a] + self.size[b])
        del places[pair]
        arisen = {}
        for i in at:
            j = after[i]
            k = after[j]
            symbol[i], symbol[j] = new, _GONE
            after[i] = k
            if k < n:
                before[k] = i
                right = (new, symbol[k])
                arisen.setdefault(right, []).append(i)
            h = before[i]
            if h >= 0:
                arisen.setdefault((symbol[h], new), []).append(h)
        for p, where in arisen.items():
            # a pair whose right half was replaced after it was noted no longer stands
            places[p] = [i for i in dict.fromkeys(where) if symbol[i] == p[0] and after[i] < n and symbol[after[i]] == p[1]]
        return arisen


# ---- runs across one boundary --------------------------------------------------

def _common(w: list[int], i: int, j: int, limit: int) -> int:
    """Length of the common prefix of ``w[i:]`` and ``w[j:]``, ``limit`` at most."""
    done, step = 0, 8
    while done < limit:
        size = min(step, limit - done)
        if w[i + done:i + done + size] == w[j + done:j + done + size]:
            done += size
            step *= 2
        elif size > 8:  # the first difference is in this piece
            limit, step = done + size, size // 2
        else:
            while w[i + done] == w[j + done]:
                done += 1
            break
    return done


def _prefix_matches(v: list[int]) -> list[int]:
    """For each place the length of the common prefix with the whole list (Z function)."""
    n = len(v)
    z = [0] * n
    a = b = 0
    for i in range(1, n):
        k = min(b - i, z[i - a]) if i < b else 0
        while i + k < n and v[k] == v[i + k]:
            k += 1
        z[i] = k
        if i + k > b:
            a, b = i, i + k
    return z


def _squares(w: list[int], m: int, e: int, longest: int) -> Iterator[tuple[int, int]]:
    """(period, length) of the primitive square prefixes of ``w[m:e]`` up to a longest
    period; the length is how far the period holds."""
    first, q, budget, z = w[m], 1, 8 * (e - m), None
    while q <= longest:
        if z is None:
            try:
                q = w.index(first, m + q, m + longest + 1) - m
            except ValueError:
                return
            if q > 1 and w[m + 1] != w[m + q + 1]:
                q += 1
                continue
            reach = _common(w, m, m + q, e - m - q)
            budget -= min(reach, q)
            if budget < 0:  # many long near-squares: all matches in one linear pass
                z = _prefix_matches(w[m:e])
        else:
            reach = z[q]
        if reach >= q:
            yield q, q + reach
            q = max(q, (q + reach) // 2)  # nothing primitive starts inside it
        q += 1


def crossing(w: list[int], back: list[int], s: int, m: int, e: int) -> list[tuple[int, int, int]]:
    """Runs of ``w[s:e]`` that hold both words at the boundary ``m``: (start, end, period),
    maximal inside ``s .. e``. ``back`` is ``w`` reversed."""
    n, found = len(w), {}
    most = (e - s) // EXPONENT
    for q, right in _squares(w, m, e, min(most, (e - m) // 2)):
        left = _common(back, n - m, n - m - q, m - s)
        if left and left + right >= max(SHORTEST, EXPONENT * q):
            found[q] = (m - left, m + right, q)
    for q, left in _squares(back, n - m, n - s, min(most, (m - s) // 2)):
        if q not in found:
            right = _common(w, m, m - q, e - m)
            if right and left + right >= max(SHORTEST, EXPONENT * q):
                found[q] = (m - left, m + right, q)
    return list(found.values())


# ---- a document --------------------------------------------------------------

def find(words: list) -> list[tuple[int, int, int]]:
    """All runs of a list of words: (start, length, period), by start, then period."""
    n = len(words)
    if n < SHORTEST:
        return []
    number: dict = {}
    w = [number.setdefault(x, len(number)) for x in words]
    if len(number) == n:
        return []
    back = w[::-1]
    grammar = Grammar(w, len(number))
    base, size, rules = grammar.n_terminals, grammar.size, grammar.rules

    own: list[list[tuple[int, int, int]]] = []  # runs across each rule's boundary, from its first word
    holds = [False] * base  # whether a symbol's derivation has any
    for k, (a, b, at) in enumerate(rules):
        here = []
        if size[base + k] >= SHORTEST:
            here = [(x - at, y - at, q) for x, y, q in crossing(w, back, at, at + size[a], at + size[base + k])]
        own.append(here)
        holds.append(bool(here) or holds[a] or holds[b])

    found: set[tuple[int, int, int]] = set()
    for at, symbol in grammar.start:
        stack = [(at, symbol)] if holds[symbol] else []
        while stack:
            i, s = stack.pop()
            a, b, _ = rules[s - base]
            found.update((q, i + x, i + y) for x, y, q in own[s - base])
            if holds[a]:
                stack.append((i, a))
            if holds[b]:
                stack.append((i + size[a], b))

    cut = [at for at, _ in grammar.start] + [n]
    spans = [(0, len(cut) - 1)]
    while spans:  # the start rule, in halves
        a, b = spans.pop()
        if b - a < 2 or cut[b] - cut[a] < SHORTEST:
            continue
        half = (a + b) // 2
        found.update((q, x, y) for x, y, q in crossing(w, back, cut[a], cut[half], cut[b]))
        spans += [(a, half), (half, b)]
    return sorted((x, y - x, q) for q, x, y in _merged(found))


def _merged(found: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Intervals of one period that share a period or more are one run."""
    out: list[tuple[int, int, int]] = []
    for q, x, y in sorted(found):
        if out and out[-1][0] == q and x + q <= out[-1][2]:
            out[-1] = (q, out[-1][1], max(y, out[-1][2]))
        else:
            out.append((q, x, y))
    return out


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without what repeats a run's first period."""
    if not runs:
        return words
    keep = bytearray(b"\x01") * len(words)
    for start, length, q in runs:
        keep[start + q:start + length] = bytes(length - q)
    return [x for x, k in zip(words, keep) if k]


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every document: its runs by start, then
    period, and its words without their repetitions, joined by one space."""
    docs = take(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        for batch in batches:
            n, runs, texts = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = words_of(text.as_py())
                got = find(words)
                n.append(len(words))
                runs.append([{"start": a, "length": b, "period": q} for a, b, q in got])
                texts.append(b" ".join(collapse(words, got)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(runs, kind),
                 pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
    return docs.mapInArrow(run, f"doc_id {docs.schema["doc_id"].dataType.simpleString()}, {RUNS}")


def longest(runs: Column) -> Column:
    """The run with the greatest length; of equal ones the first, then the smallest period."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"),
                                                            (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"),
                                             (-best["period"]).alias("period")))
