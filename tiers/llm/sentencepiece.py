"""SentencePiece encoding by sampling without replacement, and decoding.

``encode`` draws the k segmentations of each text that have the highest
Gumbel-perturbed log probabilities: a sample without replacement from the
lattice's distribution. The search is a perturbed A-star: an agenda holds sets of
paths, each with the exact maximum of its paths' perturbed values; the best set
is popped, its best path is emitted, and the rest of the set is split by where a
path first leaves the emitted one. A set's maximum is a Gumbel number around its
log mass, cut off at its parent's maximum, so no path is ever enumerated and a
text costs k passes whatever its length.

All random numbers are hashes of (seed, row key, sample, place): the result does
not depend on partitioning, batches or retries.

Edge cases: NULL and empty texts have one segmentation, the empty one; texts
with fewer than k segmentations give them all (inclusion probability 1);
characters without a piece become their UTF-8 byte pieces, or the unknown piece;
rows with equal (or NULL) keys and equal texts get equal samples; very long texts
are segmented whole; U+2581 stands for a blank, as in the library.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.llm.frame import array_slices, mix, take
from tiers.llm.lattice import Index, Lattice, _within, pieces

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1B54A32D192ED03)

#: Text that one array pass works on (a longer text is alone).
PASS_BYTES = 1 << 20


def _uniform(key: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit keys."""
    return ((mix(key) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


def _times(step: np.uint64, n: int) -> np.uint64:
    return np.uint64(int(step) * n % (1 << 64))


def _seed(key: np.ndarray, *more: int) -> np.ndarray:
    for m in more:
        key = mix(key + _times(_GOLD, m + 1))
    return key


def _cut_gumbel(log_mass: float, most: float, u: float) -> float:
    """The maximum of a set with this log mass, given that it is below ``most``."""
    g = log_mass - math.log(-math.log(u))
    high, low = max(-most, -g), min(-most, -g)
    return -(high + math.log1p(math.exp(low - high)))


def _log_minus(a: float, b: float) -> float:
    """log(exp(a) - exp(b)) for a >= b."""
    return a + math.log(-math.expm1(b - a)) if b < a else -math.inf


#: A set of an agenda: its maximum, then (path, text's place in it, from, to, edges
#: taken): the paths that follow ``path`` up to a decision in [from, to) and leave it
#: there; edges taken are those of a single decision that other sets hold.
_Set = tuple[float, int, int, int, int, tuple[int, ...]]


def _sample(lattice: Lattice, words: np.ndarray, cuts: np.ndarray, keys: np.ndarray, k: int) -> list[dict]:
    """The k best paths of every text of a batch; words: the lattice's word numbers of
    all texts in turn, cuts: the texts' bounds among them, keys: a number per text."""
    rows = len(keys)
    row_of = np.repeat(np.arange(rows), np.diff(cuts))
    chain = {"words": words, "cuts": cuts, "row_of": row_of, "place": (np.arange(len(words)) - cuts[row_of]).astype(np.int32),
             "by_word": np.argsort(words, kind="stable")}  # neighbours in the edge table together
    agenda: list[list[_Set]] = [[] for _ in range(rows)]
    paths: list[dict] = []
    # where the next sample of a text goes on: decisions kept of an earlier path, then an edge
    begin = {"row": np.arange(rows), "source": np.full(rows, -1), "keep": np.zeros(rows, dtype=np.int64),
             "edge": np.full(rows, -1), "most": -np.log(-np.log(_uniform(_seed(keys, 0, 0))))}
    kappa = np.full(rows, -np.inf)  # the best perturbed value that is not emitted
    for i in range(k):
        path = _draw(lattice, chain, keys, paths, begin, i)
        paths.append(path)
        u = _uniform(_seed(keys[path["row"]], 2, i)[:, None] + np.arange(6, dtype=np.uint64) * _STEP).tolist()
        logs = path["log_prob"].tolist()
        n = np.diff(path["cuts"])
        at_fork = [math.fsum(path["log_q"][a:a + f]) for a, f in zip(path["cuts"].tolist(), path["fork"].tolist())]
        found = []
        for j, (r, most, fork, n_all) in enumerate(zip(path["row"].tolist(), path["most"].tolist(),
                                                       path["fork"].tolist(), n.tolist())):
            mass = _log_minus(at_fork[j], logs[j])  # what leaves the path behind its fork
            if mass > -math.inf:
                agenda[r].append((_cut_gumbel(mass, most, u[j][0]), i, j, fork, n_all, ()))
            if not agenda[r]:
                continue
            if i == k - 1:
                kappa[r] = max(agenda[r])[0]
            else:
                found.append((r, *_pop(lattice, agenda[r], paths, u[j])))
        row, source, keep, edge, most = zip(*found) if found else ((),) * 5
        begin = {"row": np.array(row, dtype=np.int64), "source": np.array(source, dtype=np.int64),
                 "keep": np.array(keep, dtype=np.int64), "edge": np.array(edge, dtype=np.int64),
                 "most": np.array(most, dtype=float)}
    for path in paths:
        d = path["log_prob"] - kappa[path["row"]]
        with np.errstate(over="ignore", divide="ignore"):
            path["log_inclusion"] = np.where(d < -30, d, np.log(-np.expm1(-np.exp(np.minimum(d, 700.0)))))
    return paths


def _draw(lattice: Lattice, chain: dict, keys: np.ndarray, paths: list[dict], begin: dict, number: int) -> dict:
    """One path per row of ``begin``: the kept decisions of an earlier path, the edge
    that leaves it, and from there on a fresh draw, all words of all rows side by side."""
    rows, keep, cuts, row_of, place = begin["row"], begin["keep"], chain["cuts"], chain["row_of"], chain["place"]
    slot = np.full(len(cuts) - 1, -1)
    slot[rows] = np.arange(len(rows))
    state = lattice.enter[chain["words"]]
    kept = []
    fork = keep + (1 if number else 0)
    if number:
        resume = np.zeros(len(rows), dtype=np.int64)
        for s, path in enumerate(paths):  # what is kept, gathered from the paths it comes from
            of = np.flatnonzero(begin["source"] == s)
            at = path["cuts"][path["slot"][rows[of]]]
            taken = np.repeat(at, keep[of]) + _within(keep[of])
            kept.append((of, path["edge"][taken], path["word"][taken]))
            resume[of] = path["word"][at + keep[of]]
        state[(slot[row_of] < 0) | (place < np.append(resume, 0)[slot[row_of]])] = -1
        state[cuts[rows] + resume] = lattice.next[begin["edge"]]
    order = chain["by_word"][state[chain["by_word"]] >= 0]
    base = _seed(keys, 1, number)[row_of] + place.astype(np.uint64) * _GOLD
    picked, n_steps = [], np.zeros(len(state), dtype=np.int64)
    while len(order):
        edge = lattice.pick(state[order], _uniform(base[order] + _times(_STEP, len(picked) + 1)))
        picked.append((order, edge))
        n_steps[order] += 1
        state[order] = to = lattice.next[edge]
        order = order[to >= 0]
    # every row's decisions: kept ones, the fork, then those of its words in order
    before = np.concatenate([[0], np.cumsum(n_steps)])
    bounds = np.concatenate([[0], np.cumsum(fork + (before[cuts[rows + 1]] - before[cuts[rows]]))])
    edges, word = np.empty(bounds[-1], dtype=np.int64), np.empty(bounds[-1], dtype=np.int32)
    for of, edge, old_word in kept:
        to = np.repeat(bounds[of], keep[of]) + _within(keep[of])
        edges[to], word[to] = edge, old_word
    if number:
        edges[bounds[:-1] + keep], word[bounds[:-1] + keep] = begin["edge"], resume
    first = np.zeros(len(cuts) - 1, dtype=np.int64)
    first[rows] = bounds[:-1] + fork - before[cuts[rows]]
    offset = first[row_of] + before[:-1]
    for step, (order, edge) in enumerate(picked):
        to = offset[order] + step
        edges[to], word[to] = edge, place[order]
    log_q = lattice.log_q[edges]
    some = np.flatnonzero(np.diff(bounds))
    log_prob = np.zeros(len(rows))  # summed row by row: the same in any batch
    log_prob[some] = np.add.reduceat(log_q, bounds[:-1][some]) if len(some) else 0.0
    return {"row": rows, "slot": slot, "cuts": bounds, "edge": edges, "word": word, "most": begin["most"],
            "log_q": log_q, "log_prob": log_prob, "fork": fork}


def _pop(lattice: Lattice, sets: list[_Set], paths: list[dict], u: list[float]) -> tuple[int, int, int, float]:
    """Pop the set with the largest maximum, put back what its best path leaves, and tell
    where that path leaves the set's own: (path, kept decisions, edge, maximum)."""
    best = max(range(len(sets)), key=lambda i: sets[i][0])
    value, number, slot, a, b, taken = sets.pop(best)
    path = paths[number]
    c, d = int(path["cuts"][slot]), a
    sums = np.concatenate([[0.0], np.cumsum(path["log_q"][c:int(path["cuts"][slot + 1])])])
    if not taken and b - a > 1:  # which decision: by the mass that leaves the path there
        left = -np.expm1(sums[a:b + 1] - sums[a])  # mass that has left by each decision
        d = a + min(int(np.searchsorted(left[1:], u[1] * left[-1], side="right")), b - a - 1)
        for x, y, v in ((a, d, u[2]), (d + 1, b, u[3])):
            mass = _log_minus(float(sums[x]), float(sums[y])) if y > x else -math.inf
            if mass > -math.inf:
                sets.append((_cut_gumbel(mass, value, v), number, slot, x, y, ()))
    edge = int(path["edge"][c + d])
    taken = taken or (edge,)
    others = [e for e in lattice.siblings(edge).tolist() if e not in taken]
    share = np.exp(lattice.log_q[others])
    i = min(int(np.searchsorted(np.cumsum(share), u[4] * share.sum(), side="right")), len(others) - 1)
    rest = float(share.sum() - share[i])
    if len(others) > 1 and rest > 0:
        mass = float(sums[d]) + math.log(rest)
        sets.append((_cut_gumbel(mass, value, u[5]), number, slot, d, d + 1, (*taken, others[i])))
    return number, d, others[i], value


def segment(texts: pa.Array, keys: np.ndarray, model: str, k: int, alpha: float) -> dict[str, np.ndarray | pa.Array]:
    """Samples of a batch of texts as columns: row, sample, log_prob, perturbed, log_inclusion, ids."""
    p = pieces(model, alpha)
    words, codes, cuts = Index(), [], [0]
    for text in p.model.normalize(texts.to_pylist()):
        codes += map(words.__getitem__, p.words.findall(text))
        cuts.append(len(codes))
    lattice = Lattice(p, list(words))
    paths = _sample(lattice, np.array(codes, dtype=np.int64), np.array(cuts, dtype=np.int64), keys, k)
    out = {n: [] for n in ("row", "sample", "log_prob", "perturbed", "log_inclusion")}
    ids, bounds, total = [], [np.zeros(1, dtype=np.int64)], 0
    for i, path in enumerate(paths):
        found, at = lattice.ids(path["edge"], path["cuts"])
        ids.append(found)
        bounds.append(at[1:] + total)
        total += len(found)
        for name, x in (("row", path["row"]), ("sample", np.full(len(path["row"]), i + 1)),
                        ("log_prob", path["log_prob"]), ("perturbed", path["log_prob"] * 0 + path["most"]),
                        ("log_inclusion", path["log_inclusion"])):
            out[name].append(x)
    done = {n: np.concatenate(x) for n, x in out.items()}
    done["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate(bounds).astype(np.int32)), pa.array(np.concatenate(ids)))
    return done


def encode(docs: DataFrame, model: str, k: int = 2, alpha: float = 1.0, seed: int = 0,
           check: bool = False) -> DataFrame:
    """``doc_id, sample, n_tokens, log_prob, perturbed, log_inclusion, ids`` of every row of
    ``docs`` (doc_id, text): up to k distinct segmentations, best perturbed value first.

    ``log_prob`` is a segmentation's log probability, ``log_inclusion`` the log of its
    chance to be among the samples given the first value that is not; 1 / inclusion
    weights samples without bias. ``check`` adds ``round_trip``: whether the ids decode
    to the text. One scan, no shuffle.
    """
    rows = take(docs, "doc_id", "text")
    keyed = rows.select("doc_id", F.xxhash64(F.lit(seed).cast("bigint"), F.col("doc_id").cast("string"), "text").alias("key"),
                        F.coalesce("text", F.lit("")).alias("text"))
    schema = (f"doc_id {dict(rows.dtypes)['doc_id']}, sample int, n_tokens bigint, log_prob double, "
              "perturbed double, log_inclusion double, ids array<int>" + (", round_trip boolean" if check else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in array_slices(batch.column(2), PASS_BYTES):
                part = batch.slice(done, len(texts))
                done += len(texts)
                keys = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                s = segment(texts, keys, model, k, alpha)
                ids = s["ids"]
                columns = [part.column(0).take(pa.array(s["row"])), pa.array(s["sample"], pa.int32()),
                           pa.array(np.diff(ids.offsets.to_numpy()), pa.int64()), pa.array(s["log_prob"]),
                           pa.array(s["perturbed"]), pa.array(s["log_inclusion"]), ids]
                names = ["doc_id", "sample", "n_tokens", "log_prob", "perturbed", "log_inclusion", "ids"]
                if check:
                    given = texts.cast(pa.binary()).take(pa.array(s["row"])).to_pylist()
                    same = np.array([a == b for a, b in zip(decoded(ids, model), given)], dtype=bool)
                    columns.append(pa.array(same))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return keyed.mapInArrow(run, schema)


def decoded(ids: pa.Array, model: str) -> list[bytes]:
    """The UTF-8 texts of a batch of id lists (a NULL list: the empty text), all pieces at once."""
    p = pieces(model, 1.0)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    n = p.raw_size[flat]
    to = np.cumsum(n)
    data = p.raw_bytes[np.repeat(p.raw_begin[flat] - (to - n), n) + np.arange(int(n.sum()))].tobytes()
    rows = np.cumsum(np.concatenate([[0], ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)]))
    cuts = np.concatenate([[0], to])[rows].tolist()
    # without the blank that encoding puts in front
    return [data[a + (data[a:a + 1] == b" " and b > a):b] for a, b in zip(cuts, cuts[1:])]


def decode(ids: Column, model: str) -> Column:
    """The text of a column of piece ids; control pieces and NULL give nothing."""
    @F.arrow_udf("string")
    def text_of(ids: pa.Array) -> pa.Array:
        return pa.array([t.decode("utf-8", "replace") for t in decoded(ids, model)], pa.string())
    return text_of(ids)
