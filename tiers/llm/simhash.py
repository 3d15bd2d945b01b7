"""SimHash near-duplicates over a Gray-order hierarchical index.

A text's fingerprint has bit i set when more than half of its shingle hashes
have it set. Two fingerprints link when they differ in at most ``MAX_BITS`` bits;
documents connected by links form a group.

The index is a tree over the distinct fingerprints in the order of their Gray
rank, which keeps similar bit patterns together. Its upper nodes are prefixes
(a prefix of the fingerprint is a range of Gray ranks): fingerprints visit the
nodes whose prefix differs from theirs in few enough bits, as a shuffle. Inside
a node runs of neighbours share masked bit patterns, which form the node's own
upper levels; the search adds up differences from the top and drops a whole run
once they exceed the limit.

Edge cases: texts without words have fingerprint zero and link like any other;
a NULL text is empty; NULL ids are fingerprinted and linked, and take the
smallest id of their group (NULL if it has none); copies share a fingerprint and
meet the index once, however many they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiers.llm.components import components
from tiers.llm.frame import take, text_key, written

MAX_BITS = 2
SHINGLE = 3
SEED = 42

#: Fingerprints aimed at in one node, and rows (members and visitors) beyond
#: which a node is split further. Both shape the work, not the result.
NODE_MEMBERS = 1024
NODE_ROWS = 1 << 18
#: Bits by which a too large node is split.
STEP = 4
#: Fan-out of the levels inside a node, and (query, node) pairs compared at once.
FAN, AT_ONCE = 16, 1 << 16

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def shingles(text: str, size: int = SHINGLE) -> list[bytes]:
    """The word shingles of a text, A-Z lower-cased, repeats included."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def fingerprint_of(text: str, size: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned integer."""
    found = shingles(text, size)
    if not found:
        return 0
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(SEED)), dtype="<u8", count=len(found))
    places = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256, dtype=np.uint16)
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    ones = (2 * counts.ravel() > len(found)).astype(np.uint8)
    return int.from_bytes(np.packbits(ones, bitorder="little").tobytes(), "little")


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint of a text column, as the long with the same 64 bits."""
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        out = np.empty(len(texts), dtype=np.uint64)
        for i in range(0, len(texts), 256):
            for j, t in enumerate(texts.slice(i, 256).to_pylist(), i):
                out[j] = fingerprint_of(t or "", size)
        return pa.array(out.view(np.int64))
    return simhash(text)


# ---- inside a node ---------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of a code word in the Gray sequence."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def build(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels from the top: for each run of ``FAN`` nodes below it the shared bits
    and the mask of shared bits that no level above has (the last level: members)."""
    ones, zeros, levels = members, ~members, []
    while len(ones) > 1 or not levels:
        levels.append((ones, ones | zeros))
        starts = np.arange(0, len(ones), FAN)
        ones, zeros = np.bitwise_and.reduceat(ones, starts), np.bitwise_and.reduceat(zeros, starts)
    levels.append((ones, ones | zeros))
    levels.reverse()
    out = [levels[0]]
    for (_, above), (bits, mask) in zip(levels, levels[1:]):
        out.append((bits, mask & ~np.repeat(above, FAN)[:len(mask)]))
    return out


def search(levels: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray,
           max_bits: int = MAX_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, member) of places that differ in at most ``max_bits`` bits."""
    # depth first over parts of at most AT_ONCE pairs, so that memory stays bounded where little is pruned
    open_ = [(0, np.arange(a, min(a + AT_ONCE, len(queries)))) for a in range(0, len(queries), AT_ONCE)]
    open_ = [(0, q, np.zeros(len(q), dtype=np.int64), np.zeros(len(q), dtype=np.uint8)) for _, q in open_]
    while open_:
        depth, q, node, off = open_.pop()
        bits, extra = levels[depth]
        off = off + np.bitwise_count((queries[q] ^ bits[node]) & extra[node])
        near = off <= max_bits
        q, node, off = q[near], node[near], off[near]
        if depth == len(levels) - 1:
            yield q, node
            continue
        first = node * FAN  # children of the nodes that are left
        n = np.minimum(first + FAN, len(levels[depth + 1][0])) - first
        q, off = np.repeat(q, n), np.repeat(off, n)
        node = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(q))
        open_ += [(depth + 1, q[a:a + AT_ONCE], node[a:a + AT_ONCE], off[a:a + AT_ONCE]) for a in range(0, len(q), AT_ONCE)]


def connect(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join places in ``root``, which leads every place to the smallest one it is connected to."""
    while True:
        x, y = root[a], root[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        if (low == high).all():
            return
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root[:] = root[root]


def _links(max_bits: int, group: pd.DataFrame) -> pd.DataFrame:
    """Links of one node: its members' and its visitors', as edges that connect the same."""
    fp = group["fp"].to_numpy().view(np.uint64)
    own = group["own"].to_numpy()
    members, visitors = fp[own], fp[~own]
    members = members[np.argsort(gray_rank(members), kind="stable")]
    all_of = np.concatenate([members, visitors])
    root = np.arange(len(all_of))
    if len(members):
        for q, m in search(build(members), all_of, max_bits):
            new = (q < m) | (q >= len(members))  # of two members only one way round
            if new.any():
                connect(root, q[new], m[new])
    at = np.flatnonzero(root != np.arange(len(root)))
    return pd.DataFrame({"u": all_of[at].view(np.int64), "v": all_of[root[at]].view(np.int64)})


# ---- the upper nodes, as shuffles -----------------------------------------

def _masks(bits: int, most: int) -> list[tuple[int, int]]:
    """Masks over so many bits with at most ``most`` bits set, with that number."""
    out = [(0, 0)]
    for d in range(most):
        out += [(m | 1 << i, d + 1) for m, k in out if k == d for i in range(m.bit_length(), bits)]
    return out


def _routes(rows: DataFrame, depth: int, step: int, max_bits: int) -> DataFrame:
    """Each row at every node of ``depth`` whose last ``step`` prefix bits it can still
    reach. Of two nodes' members only those of the smaller prefix visit the other."""
    child = F.shiftrightunsigned("fp", 64 - depth).bitwiseAND(F.lit((1 << step) - 1)) if depth < 64 else \
        F.col("fp").bitwiseAND(F.lit((1 << step) - 1))
    masks = F.lit([m for m, _ in _masks(step, max_bits)]).cast("array<bigint>")
    reach = F.filter(masks, lambda m: (F.bit_count(m) + F.col("d") <= max_bits)
                     & (~F.col("own") | (child.bitwiseXOR(m) >= child)))
    moved = rows.select("node", "fp", "d", "own", child.alias("c"), F.explode(reach).alias("m"))
    return moved.select(
        F.shiftleft("node", step).bitwiseOR(F.col("c").bitwiseXOR(F.col("m"))).alias("node"), "fp",
        (F.col("d") + F.bit_count("m")).cast("int").alias("d"), (F.col("own") & (F.col("m") == 0)).alias("own"))


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, node_members: int = NODE_MEMBERS,
          node_rows: int = NODE_ROWS) -> DataFrame:
    """Edges ``u, v`` that connect the distinct fingerprints (column fp) exactly as all
    links of at most ``max_bits`` bits do.

    The prefix length follows the number of fingerprints. A node with more than
    ``node_rows`` members and visitors descends by ``STEP`` bits until it has fewer
    (at 64 bits it has one member); children without members are left out.
    """
    n = fingerprints.count()
    depth = max(1, (n // node_members).bit_length())
    rows = _routes(fingerprints.select(F.lit(0).cast("bigint").alias("node"), "fp", F.lit(0).alias("d"),
                                       F.lit(True).alias("own")), depth, depth, max_bits)
    found = None

    def node_links(group: pd.DataFrame) -> pd.DataFrame:
        return _links(max_bits, group)

    while True:
        rows = written(rows, "visits")
        sizes = written(rows.groupBy("node").agg(F.count("*").alias("n"), F.max("own").alias("used"))
                        .filter("used").select("node", "n"), "nodes")
        small = sizes.filter(F.col("n") <= node_rows) if depth < 64 else sizes
        edges = (rows.join(small, "node", "left_semi").groupBy("node")
                 .applyInPandas(node_links, "u bigint, v bigint"))
        found = edges if found is None else found.union(edges)
        if depth >= 64 or sizes.filter(F.col("n") > node_rows).isEmpty():
            return found
        step = min(STEP, 64 - depth)
        depth += step
        rows = _routes(rows.join(sizes.filter(F.col("n") > node_rows), "node", "left_semi"), depth, step, max_bits)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS, **index) -> DataFrame:
    """``doc_id, text_key, fp, group, component_id`` for every row of ``docs`` (doc_id, text).

    ``group`` is the smallest fingerprint of the row's group, ``component_id`` the
    group's smallest id, ``text_key`` a digest of the text.

    Texts are read once and never shuffled. Copies fold into one fingerprint
    (combined map-side) before the index; the way back is a join on the
    fingerprint of two written tables, so a fingerprint that holds a third of the
    rows is split between tasks at run time.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    prints = written(take(docs, "doc_id", "text").select("doc_id", text_key(text).alias("text_key"),
                                                         fingerprint(text, size).alias("fp")), "prints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    group = written(components(links(distinct.select("fp"), max_bits, **index)), "groups")
    lows = written(group.join(distinct.withColumnRenamed("fp", "u"), "u").groupBy("root")
                   .agg(F.min("low").alias("group_low")), "lows")
    named = group.join(lows, "root").select(F.col("u").alias("fp"), "root", F.lit(True).alias("linked"), "group_low")
    ids = written(distinct.join(named, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("group"),
        F.when(F.col("linked"), F.col("group_low")).otherwise(F.col("low")).alias("component_id")), "ids")
    return prints.join(ids, "fp").select("doc_id", "text_key", "fp", "group", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest
    id, of rows without ids the one with the smallest text digest; of rows equal in
    id and text the smallest row. Columns: those of ``docs``, which must not clash.
    """
    near = near_duplicates(docs, **options)
    first = (near.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
                                       .alias("first"), F.count("*").alias("n")).select("first.*", "group"))
    repeated = near.groupBy("group", "doc_id", "text_key").count().filter("count > 1")
    first = written(first.alias("f").join(repeated.alias("r"), (F.col("f.group") == F.col("r.group"))
                                          & F.col("f.doc_id").eqNullSafe(F.col("r.doc_id"))
                                          & (F.col("f.text_key") == F.col("r.text_key")), "left")
                    .select("f.doc_id", "f.text_key", F.col("r.count").isNotNull().alias("repeated")), "first")

    def rows_of(chosen: DataFrame) -> DataFrame:
        keyed = docs.withColumn("_text_key", text_key(F.col("text")))
        return keyed.alias("d").join(
            chosen.hint("shuffle_hash").alias("c"),
            F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d._text_key") == F.col("c.text_key")), "left_semi")

    once = rows_of(first.filter("not repeated")).drop("_text_key")
    if first.filter("repeated").isEmpty():
        return once
    again = (rows_of(first.filter("repeated")).groupBy("doc_id", "_text_key")
             .agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*"))
    return once.union(again)
