"""Quality rules as a learned decision list.

Sequential covering over labelled statistics: each round grows one conjunction
of thresholds that rejects low-quality rows (best information gain first),
prunes its last conditions on rows it was not grown on, and removes what it
covers; learning stops when a rule no longer earns its place. The rules become
one ordered Spark conditional expression (``CASE WHEN ... THEN false ... ELSE
true``), so scoring is plain column arithmetic.

Edge cases: a NULL or empty text has no word and fails the base check; rates of
texts without words are 0; repeated rows are judged alike; without labels, or
with labels of one class only, the list is empty and keeps what passes the base
check; very long texts are counted whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.llm.frame import label_sample, labelled

#: Characters that count as symbols (fixed by the contract of the base check).
SYMBOLS = "#*$%&|<>"
#: ASCII white space: blank, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_digits", "n_stops", "n_distinct")
_TYPE = "struct<" + ",".join(f"{n}:bigint" for n in BASE + MORE) + ">"

#: Labelled rows that a list is fitted on at most, chosen by a hash of the id. The fit is a bounded one; every count and verdict covers all rows.
FIT_ROWS = 20_000


def text_stats(text: str) -> tuple[int, ...]:
    """The statistics ``BASE + MORE`` of one text (words: runs without ASCII white space)."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly the six ASCII white-space characters
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    repeat = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:]))
        if len(set(grams)) < len(grams):
            seen: dict[tuple, int] = {}
            for g in grams:
                seen[g] = seen.get(g, 0) + 1
            last = -1  # words up to here are counted
            for i, g in enumerate(grams):
                if seen[g] > 1:
                    repeat += i + 2 - max(last, i - 1)
                    last = i + 2
    return (n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat,
            len(lines), len(raw) - len(raw.translate(None, _UPPER)), len(raw) - len(raw.translate(None, _DIGIT)),
            sum(map(text.count, ".!?")), len(set(words)))


_UPPER, _DIGIT = bytes(range(65, 91)), bytes(range(48, 58))


def _stats_of(texts: pa.Array) -> pa.Array:
    found = []
    for i in range(0, len(texts), 256):
        found += [text_stats(t or "") for t in texts.slice(i, 256).to_pylist()]
    columns = np.array(found, dtype=np.int64).reshape(-1, len(BASE + MORE))
    return pa.StructArray.from_arrays([pa.array(columns[:, i]) for i in range(columns.shape[1])],
                                      names=list(BASE + MORE))


def stats(text: Column) -> Column:
    """The statistics of a text column as one struct."""
    @F.arrow_udf(_TYPE)
    def text_statistics(texts: pa.Array) -> pa.Array:
        return _stats_of(texts)
    return text_statistics(text)


def base_failed(s: Column) -> Column:
    """Too short, or more than half of the words inside repeated three-word windows."""
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    """What the rules may test: counts and rates of one text's statistics."""
    def rate(a, b):
        return F.when(s[b] > 0, s[a].cast("double") / s[b]).otherwise(F.lit(0.0))
    return {
        "n_words": s["n_words"].cast("double"),
        "chars_per_word": rate("word_chars", "n_words"),
        "symbols_per_word": rate("n_symbols", "n_words"),
        "dup_lines_per_line": rate("n_dup_lines", "n_lines"),
        "repeat_words_per_word": rate("n_repeat_words", "n_words"),
        "words_per_line": rate("n_words", "n_lines"),
        "upper_per_char": rate("n_upper", "word_chars"),
        "digits_per_char": rate("n_digits", "word_chars"),
        "stops_per_word": rate("n_stops", "n_words"),
        "distinct_per_word": rate("n_distinct", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] < self.threshold

    def column(self, x: dict[str, Column]) -> Column:
        limit = F.lit(self.threshold)
        return x[self.feature] >= limit if self.at_least else x[self.feature] < limit

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold!r}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, max_conditions: int) -> Rule:
    """Conditions added one by one, each the one with the best gain, until no good row is left."""
    rule: list[Condition] = []
    live = np.ones(len(bad), dtype=bool)
    while len(rule) < max_conditions:
        p, n = int(bad[live].sum()), int((~bad[live]).sum())
        if not p or not n:
            break
        before, best = math.log2(p / (p + n)), (1e-9, None)
        for name, values in x.items():
            v, b = values[live], bad[live]
            order = np.argsort(v, kind="stable")
            v, b = v[order], b[order].astype(np.int64)
            cut = np.flatnonzero(v[1:] > v[:-1]) + 1  # a threshold between two different values
            if not len(cut):
                continue
            below_p = np.cumsum(b)[cut - 1]
            below_n = cut - below_p
            for at_least, pp, nn in ((False, below_p, below_n), (True, p - below_p, n - below_n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - before), -1.0)
                i = int(np.argmax(gain))
                if gain[i] > best[0]:
                    best = (float(gain[i]), Condition(name, at_least, float((v[cut[i] - 1] + v[cut[i]]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        live &= best[1].holds(x)
    return tuple(rule)


def _prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The leading conditions with the best (p - n) / (p + n) on rows kept aside."""
    best, kept = -2.0, rule
    for k in range(len(rule), 0, -1):
        on = covers(rule[:k], x, len(bad))
        p, n = int(bad[on].sum()), int((~bad[on]).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth >= best:
            best, kept = worth, rule[:k]
    return kept


def learn(x: dict[str, np.ndarray], bad: np.ndarray, aside: np.ndarray, min_precision: float = 0.8,
          min_aside: int = 2, min_share: float = 0.02, max_rules: int = 12, max_conditions: int = 4) -> list[Rule]:
    """Ordered reject rules from feature vectors, labels (True: low quality) and the
    rows kept aside for pruning. A rule stays if at least ``min_precision`` of the
    rows it covers are bad, on the grown rows and on those kept aside, if it
    covers at least ``min_aside`` bad rows kept aside and ``min_share`` of all bad
    rows: what only wrong labels support does not reject clean texts."""
    rules: list[Rule] = []
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < max_rules:
        g, a = left & ~aside, left & aside
        rule = _grow({k: v[g] for k, v in x.items()}, bad[g], max_conditions)
        if not rule:
            break
        rule = _prune(rule, {k: v[a] for k, v in x.items()}, bad[a])
        on = covers(rule, x, len(bad)) & left
        precise = all(bad[on & part].mean() >= min_precision if (on & part).any() else False for part in (aside, ~aside))
        if not precise or bad[on & aside].sum() < min_aside or bad[on].sum() < min_share * bad.sum():
            break
        rules.append(rule)
        left &= ~on
    return rules


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, **options) -> list[Rule]:
    """Learn a list from labelled documents; at most ``fit_rows`` of them, one per
    distinct id and label, chosen by a hash of the id. A third of them prunes."""
    s = F.col("s")
    names = list(features(s))
    rows = (labelled(docs, label_sample(labels, "quality", fit_rows))
            .select("doc_id", "label", stats(F.col("text")).alias("s"))
            .filter(~base_failed(s))  # the list judges only what passes the base check
            .select((F.col("label") == 0).alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("aside"),
                    "doc_id", *(c.alias(n) for n, c in features(s).items()))
            .toPandas().sort_values(["doc_id", "bad", *names], kind="stable"))
    return learn({n: rows[n].to_numpy(dtype=float) for n in names}, rows["bad"].to_numpy(dtype=bool),
                 rows["aside"].to_numpy(dtype=bool), **options)


def expression(rules: list[Rule], s: Column) -> Column:
    """The number of the first rule that rejects (1, 2, ...), 0 if none does."""
    x, out = features(s), None
    for i, rule in enumerate(rules, 1):
        test = rule[0].column(x)
        for c in rule[1:]:
            test = test & c.column(x)
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text", into: str = "verdict") -> DataFrame:
    """``docs`` with a struct column ``into``: the base statistics, ``base_failed``,
    ``rule`` (0: none) and ``kept``. An input column of that name is replaced."""
    s = F.col("_quality_stats")
    counted = docs.withColumn("_quality_stats", stats(F.col(text)))
    rule = expression(rules, s)
    failed = base_failed(s)
    return counted.withColumn(into, F.struct(
        *(s[n].alias(n) for n in BASE), failed.alias("base_failed"), rule.alias("rule"),
        (~failed & (rule == 0)).alias("kept"))).drop("_quality_stats")
