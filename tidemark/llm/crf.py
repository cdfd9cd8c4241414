"""A linear-chain conditional random field over words: hashed byte n-gram and affix features, learned transitions.

Words are handled as arrays: the features of all different words of a slice are made at once, and forward-backward runs
over all documents of a slice together. A document is cut into runs of ``RUN`` words; the product of the step matrices
of a run carries the forward and backward messages over it, so long documents cost no more steps than short ones.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm import common as C

RUN = 32
#: Features are hashed into so many rows of weights.
ROWS = 1 << 17


def _letters() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


LETTERS = _letters()


class Tokens:
    """Words of a slice (ASCII letters and all non-ASCII characters, lower case in ASCII and Latin-1)."""

    def __init__(self, flat: np.ndarray, bounds: np.ndarray):
        low = LETTERS[flat]
        upper = np.flatnonzero((low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97) & (low[:-1] == 0xC3)) + 1
        low[upper] += 0x20
        inside = low != 0
        before, after = np.zeros(len(flat), bool), np.zeros(len(flat), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        firsts, lasts = bounds[:-1][bounds[:-1] < len(flat)], bounds[1:] - 1
        before[firsts] = False
        after[lasts[lasts >= 0]] = False
        self.low = low
        self.begin, self.end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(bounds, self.begin, side="right") - 1
        self.prefix = C.prefix_hash(low)
        hashes = C.stretch_hash(self.prefix, self.begin, self.end)
        self.kinds, self.first, self.kind = np.unique(hashes, return_index=True, return_inverse=True)

    def text(self, i: int) -> bytes:
        return self.low[self.begin[i] : self.end[i]].tobytes()

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(kind, feature row) of every feature of every different word: the word, its affixes, its inner n-grams."""
        begin, end = self.begin[self.first], self.end[self.first]
        n = np.arange(len(begin))
        kinds, rows = [n], [self._row(self.kinds, 0)]
        size = end - begin
        for k in (1, 2, 3, 4, 5, 6):
            some = np.flatnonzero(size >= k)
            kinds += [some, some]
            rows += [self._row(C.stretch_hash(self.prefix, begin[some], begin[some] + k), 1), self._row(C.stretch_hash(self.prefix, end[some] - k, end[some]), 2)]
        for k in (2, 3):
            count = np.maximum(size - k + 1, 0)
            which = np.repeat(n, count)
            at = begin[which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            kinds.append(which)
            rows.append(self._row(C.stretch_hash(self.prefix, at, at + k), 3))
        return np.concatenate(kinds), np.concatenate(rows)

    @staticmethod
    def _row(hashes: np.ndarray, group: int) -> np.ndarray:
        return (C.mixed(hashes + np.uint64(group * 0x9E3779B97F4A7C15 & C.MASK)) >> np.uint64(64 - ROWS.bit_length() + 1)).astype(np.int64)


def _normed(a: np.ndarray, axes) -> np.ndarray:
    return a / np.maximum(a.sum(axis=axes, keepdims=True), 1e-300)


class Messages:
    """Forward and backward messages over documents given by their word counts."""

    def __init__(self, potentials: np.ndarray, transition: np.ndarray, counts: np.ndarray):
        n, labels = potentials.shape
        counts = counts[counts > 0]
        runs = -(-counts // RUN)
        first_run = np.cumsum(runs) - runs
        doc = np.repeat(np.arange(len(counts)), runs)
        k = np.arange(len(doc)) - first_run[doc]
        first_word = np.cumsum(counts) - counts
        at = (first_word[doc] + k * RUN)[:, None] + np.arange(RUN)
        real = at < (first_word + counts)[doc][:, None]
        at = np.where(real, at, 0)
        e = np.where(real[:, :, None], potentials[at], 1.0)  # runs x steps x labels
        opens = k == 0
        step = np.tile(np.eye(labels), (len(doc), 1, 1))
        for t in range(RUN):
            new = (step @ transition) * e[:, t][:, None, :]
            if t == 0:
                new[opens] = e[opens, 0][:, None, :]
            step = _normed(np.where(real[:, t][:, None, None], new, step), (1, 2))
        longest = np.argsort(-runs, kind="stable")
        into = np.full((len(doc), labels), 1.0 / labels)
        back = np.full((len(doc), labels), 1.0 / labels)
        alive = np.searchsorted(-runs[longest], -np.arange(1, runs.max(initial=0) + 1), side="right")  # documents with so many runs
        for j in range(1, len(alive)):
            r = first_run[longest[: alive[j]]] + j
            into[r] = _normed(np.einsum("ri,rij->rj", into[r - 1], step[r - 1]), 1)
        for j in range(len(alive) - 1, 0, -1):
            r = first_run[longest[: alive[j]]] + j
            back[r - 1] = _normed(np.einsum("rij,rj->ri", step[r], back[r]), 1)
        self.forward = np.empty((n, labels))
        self.backward = np.empty((n, labels))
        a, b = into, back
        for t in range(RUN):
            new = (a @ transition) * e[:, t]
            if t == 0:
                new[opens] = e[opens, 0]
            a = _normed(np.where(real[:, t][:, None], new, a), 1)
            self.forward[at[real[:, t], t]] = a[real[:, t]]
        for t in range(RUN - 1, -1, -1):
            self.backward[at[real[:, t], t]] = b[real[:, t]]
            b = _normed(np.where(real[:, t][:, None], (e[:, t] * b) @ transition.T, b), 1)
        self.marginals = _normed(self.forward * self.backward, 1)
        self.potentials, self.transition = potentials, transition
        self.starts = np.zeros(n, bool)
        self.starts[first_word] = True

    def pairs(self) -> np.ndarray:
        """Expected numbers of label pairs, over all neighbouring words."""
        later = np.flatnonzero(~self.starts)
        x = self.forward[later - 1][:, :, None] * self.transition * (self.potentials[later] * self.backward[later])[:, None, :]
        return _normed(x, (1, 2)).sum(axis=0)


class Field:
    """Weights of a fitted field. Small enough to send to every task: ``ROWS`` rows of one number a label."""

    def __init__(self, labels: int):
        self.weights = np.zeros((ROWS, labels), np.float32)
        self.transition = np.zeros((labels, labels))

    def emissions(self, kinds: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Scores of n different words."""
        got = self.weights[rows]
        return np.stack([np.bincount(kinds, got[:, j], n) for j in range(got.shape[1])], axis=1)

    @staticmethod
    def potentials(scores: np.ndarray) -> np.ndarray:
        return np.exp(scores - scores.max(axis=1, keepdims=True))

    def marginals(self, tokens: Tokens, rows: int) -> np.ndarray:
        """Of every word of a slice of documents."""
        if not len(tokens.begin):
            return np.zeros((0, self.transition.shape[0]))
        scores = self.emissions(*tokens.features(), len(tokens.kinds))
        counts = np.bincount(tokens.row, minlength=rows)
        return Messages(self.potentials(scores)[tokens.kind], np.exp(self.transition), counts).marginals

    def fit(self, kinds: np.ndarray, rows: np.ndarray, n: int, kind: np.ndarray, counts: np.ndarray, labels: np.ndarray, epochs: int, rate: float = 0.5, decay: float = 1e-4) -> None:
        """Adaptive gradient ascent on the likelihood of labelled sequences of different words ``kind``."""
        width = self.transition.shape[0]
        wanted = np.eye(width)[labels]
        starts = np.zeros(len(kind), bool)
        starts[(np.cumsum(counts) - counts)[counts > 0]] = True
        later = np.flatnonzero(~starts)
        seen = np.zeros((width, width))
        np.add.at(seen, (labels[later - 1], labels[later]), 1)
        squares, trans_squares = np.full(self.weights.shape, 1e-8), np.full((width, width), 1e-8)
        total = len(kind)
        for _ in range(epochs):
            scores = self.emissions(kinds, rows, n)
            m = Messages(self.potentials(scores)[kind], np.exp(self.transition), counts)
            gap = wanted - m.marginals
            of_kind = np.stack([np.bincount(kind, gap[:, j], n) for j in range(width)], axis=1)
            grad = np.stack([np.bincount(rows, of_kind[kinds, j], ROWS) for j in range(width)], axis=1) / total - decay * self.weights / 100
            squares += grad**2
            self.weights += (rate * grad / np.sqrt(squares)).astype(np.float32)
            t = (seen - m.pairs()) / max(1, len(later))
            trans_squares += t**2
            self.transition += rate * t / np.sqrt(trans_squares)
