"""Lattices of a batch of texts, and paths sampled through them, as array passes.

Helper of ``sentencepiece.py``. A text's lattice is the chain of its words'
lattices, since no piece reaches over a word's end; each distinct word of a
batch is built once.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

BLANK = "▁"
#: What an unknown character costs below the least likely piece, per character.
UNKNOWN = 10.0


class Pieces:
    """A model's pieces as a character trie with log probabilities.

    Unigram models bring log probabilities. The scores of a BPE model are merge
    ranks instead; they become probabilities by Zipf's law, p ~ 1 / (rank + 2.7).
    ``alpha`` scales the log probabilities (0: all segmentations alike).
    """

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_id, pieces, scores = np.full(256, -1, dtype=np.int32), {}, []
        self.unknown = m.unk_id()
        raw: list[bytes] = []
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            raw.append(b"")
            if m.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                raw[-1] = bytes([int(piece[3:5], 16)])
            elif m.is_unknown(i):
                raw[-1] = " ⁇ ".encode()
            elif not (m.is_control(i) or m.is_unused(i)):
                pieces[piece] = i
                scores.append(m.get_score(i))
                raw[-1] = piece.replace(BLANK, " ").encode()
        # what each id decodes to, as one run of bytes
        self.raw_bytes = np.frombuffer(b"".join(raw), dtype=np.uint8)
        self.raw_size = np.array([len(x) for x in raw], dtype=np.int64)
        self.raw_begin = np.cumsum(self.raw_size) - self.raw_size
        s = np.array(scores)
        if len(s) and (s == np.round(s)).all() and s.max() <= 0:  # merge ranks
            s = -np.log(-s + 2.7)
            s -= np.log(np.exp(s).sum())
        self.score = np.zeros(len(raw))
        self.score[list(pieces.values())] = s * alpha
        self.unknown_score = float(s.min() - UNKNOWN) * alpha if len(s) else -UNKNOWN
        inside = any(BLANK in p.lstrip(BLANK) or ("\n" in p and p != "\n") for p in pieces)
        self.words = re.compile(".+", re.S) if inside else re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")
        # trie: (node, character class) -> node, and the piece that ends at a node;
        # class 0 holds the characters that no piece has
        alphabet = sorted({c for piece in pieces for c in piece})
        self.classes = np.zeros(0x110000, dtype=np.int32)
        self.classes[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.width = len(alphabet) + 1
        step, ends = {}, [-1]
        for piece, i in pieces.items():
            node = 0
            for c in self.classes[[ord(c) for c in piece]].tolist():
                key = node * self.width + c
                if key not in step:
                    step[key] = len(ends)
                    ends.append(-1)
                node = step[key]
            ends[node] = i
        self.ends = np.array(ends, dtype=np.int32)
        # the steps as a hash table with linear probing, at most a quarter full
        self.bits = max(4, (4 * len(step)).bit_length())
        self.key = np.full(1 << self.bits, -1, dtype=np.int64)
        self.to = np.full(1 << self.bits, -1, dtype=np.int32)
        keys = np.array(list(step), dtype=np.int64)
        to = np.array(list(step.values()), dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.key[slot] == -1
            self.key[slot[free]] = keys[free]  # of several for one slot the last stays
            placed = self.key[slot] == keys
            self.to[slot[placed]] = to[placed]
            keys, to, slot = keys[~placed], to[~placed], (slot[~placed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def walk(self, node: np.ndarray, char_class: np.ndarray) -> np.ndarray:
        """The trie node after one more character, -1 where there is none."""
        key = node.astype(np.int64) * self.width + char_class
        slot = self._slot(key)
        there = self.key[slot]
        out = np.where(there == key, self.to[slot], -1)
        open_ = np.flatnonzero((there != key) & (there != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            there = self.key[slot[open_]]
            hit = there == key[open_]
            out[open_[hit]] = self.to[slot[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out


@lru_cache(maxsize=2)
def pieces(path: str, alpha: float) -> Pieces:
    return Pieces(path, alpha)


class Index(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class Lattice:
    """The lattices of distinct words. Word w has nodes ``first[w] .. last[w]`` (one
    per character and one behind them); edges are grouped by their start node.

    ``log_q[e]`` is an edge's share of the log probability that passes its start
    node: the product of shares along a path is the path's probability.
    """

    def __init__(self, p: Pieces, words: list[str]):
        self.pieces = p
        size = np.array([len(w) for w in words], dtype=np.int64)
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        classes = p.classes[chars]
        self.last = np.cumsum(size + 1) - 1
        self.first = self.last - size
        word = np.repeat(np.arange(len(words), dtype=np.int32), size)
        node = np.arange(len(chars), dtype=np.int32) + word  # the node before each character
        left = self.last.astype(np.int32)[word] - node  # characters from here to the word's end
        # characters nearest to their word's end first: the order of the edges
        by_left = np.argsort(left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left, kind="stable")
        by_left = by_left.astype(np.int32)
        found = []  # by piece length: (characters, pieces)
        at, state, depth = np.arange(len(chars), dtype=np.int32), np.zeros(len(chars), dtype=np.int32), 0
        while len(at):
            state = p.walk(state, classes[at + depth])
            on = state >= 0
            at, state, depth = at[on], state[on], depth + 1
            piece = p.ends[state]
            full = piece >= 0
            found.append((at[full], piece[full]))
            if depth == 1:  # no piece for the character: its bytes, or unknown
                single = np.zeros(len(chars), dtype=bool)
                single[at[full]] = True
                alone = np.flatnonzero(~single)
                found.append((alone, -1 - chars[alone].astype(np.int32)))
            more = left[at] > depth
            at, state = at[more], state[more]
        n_edges = np.zeros(len(chars), dtype=np.int32)
        for at, _ in found:
            n_edges[at] += 1
        n = n_edges[by_left]
        edge_of = np.concatenate([[0], np.cumsum(n)])
        slot = np.empty(len(chars), dtype=np.int32)  # a character's next free edge
        slot[by_left] = edge_of[:-1]
        end, piece = np.empty(edge_of[-1], dtype=np.int32), np.empty(edge_of[-1], dtype=np.int32)
        for depth, (at, pieces_) in enumerate(found):
            to = slot[at]
            end[to], piece[to] = node[at] + max(1, depth), pieces_
            slot[at] += 1
        head = edge_of[:-1]
        score = p.score[np.maximum(piece, 0)]
        score[piece < 0] = p.unknown_score
        beta = np.zeros(int(self.last[-1]) + 1 if len(words) else 0)  # log mass from a node to its word's end
        mass = np.empty(len(piece))
        best = np.empty(len(head), dtype=np.int64)
        bounds = np.append(np.flatnonzero(np.diff(left[by_left], prepend=0)), len(by_left))
        for a, b in zip(bounds, bounds[1:]):
            e = slice(edge_of[a], edge_of[b])
            m = score[e] + beta[end[e]]
            cuts = edge_of[a:b] - edge_of[a]
            top = np.maximum.reduceat(m, cuts)
            wide = np.repeat(top, n[a:b])
            hit = np.flatnonzero(m == wide)  # every node's first best edge
            best[a:b] = edge_of[a] + hit[np.searchsorted(hit, cuts)]
            m -= wide
            total = np.log(np.add.reduceat(np.exp(m), cuts))
            beta[node[by_left[a:b]]] = top + total
            mass[e] = m - np.repeat(total, n[a:b])
        self.log_q, self.piece = mass, piece
        rank = np.full(len(beta), -1, dtype=np.int32)
        rank[node[by_left]] = np.arange(len(head))
        # states of a walk are ranks of nodes, -1 behind a word's last character
        self.next, self.enter = rank[end], rank[self.first]
        self.head, self.best, self.best_share = edge_of, best, np.exp(mass[best])

    def pick(self, state: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each state, drawn by its share with a number below 1: the state's
        likeliest edge takes the numbers from 0, the others follow in order."""
        out = self.best[state]
        share = self.best_share[state]
        at = np.flatnonzero(u >= share)
        left, edge, last, skip = (u - share)[at], self.head[state[at]], self.head[state[at] + 1] - 1, out[at]
        last -= last == skip  # the last of the others; a state with one edge keeps it
        edge += edge == skip
        while len(at):
            left = left - np.where(edge == skip, 0.0, np.exp(self.log_q[np.minimum(edge, len(self.log_q) - 1)]))
            done = (left < 0) & (edge != skip) | (edge >= last)
            out[at[done]] = np.where(edge >= last, np.maximum(last, self.head[state[at]]), edge)[done]
            go = ~done
            at, left, edge, last, skip = at[go], left[go], edge[go] + 1, last[go], skip[go]
        return out

    def siblings(self, edge: int) -> np.ndarray:
        """All edges of the state that an edge leaves."""
        r = int(np.searchsorted(self.head, edge, side="right")) - 1
        return np.arange(self.head[r], self.head[r + 1])

    def ids(self, edge: np.ndarray, row_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of a sequence of edges, and the cuts between rows among them."""
        p, piece = self.pieces, self.piece[edge]
        odd = np.flatnonzero(piece < 0)
        if not len(odd):
            return piece.astype(np.int32), row_cuts
        known: dict[int, list[int]] = {}
        parts = []
        for c in (-1 - piece[odd]).tolist():
            if c not in known:
                found = [int(p.byte_id[b]) for b in chr(c).encode("utf-8", "surrogatepass")]
                known[c] = found if min(found) >= 0 else [p.unknown]
            parts.append(known[c])
        n = np.ones(len(piece), dtype=np.int64)
        n[odd] = [len(x) for x in parts]
        to = np.concatenate([[0], np.cumsum(n)])
        out = np.empty(to[-1], dtype=np.int32)
        plain = piece >= 0
        out[to[:-1][plain]] = piece[plain]
        out[np.repeat(to[odd], n[odd]) + _within(n[odd])] = np.concatenate([np.array(x, dtype=np.int32) for x in parts])
        return out, to[row_cuts]


def _within(n: np.ndarray) -> np.ndarray:
    """0, 1, .. n-1 for each n."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
