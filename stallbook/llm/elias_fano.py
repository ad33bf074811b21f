"""Elias-Fano coded monotone sequences and an n-gram trie made of them, in one memory-mapped file."""

from __future__ import annotations

import os
import tempfile

import numpy as np

STEPS = ((32, 0xFFFFFFFF), (16, 0xFFFF), (8, 0xFF), (4, 0xF), (2, 0x3), (1, 0x1))
GRID = 65_535
LOWEST = -14.0


class Store:
    """Arrays put one after the other into a file that is mapped, not loaded; the file has no name once mapped."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.size = 0

    def put(self, array: np.ndarray) -> tuple[int, int, np.dtype]:
        array = np.ascontiguousarray(array)
        at = self.size
        self.parts.append(array)
        self.size += -(-array.nbytes // 8) * 8
        return at, len(array), array.dtype

    def map(self) -> np.ndarray:
        handle, path = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(handle, "wb") as f:
            for array in self.parts:
                f.write(array.tobytes())
                f.write(b"\0" * (-array.nbytes % 8))
            f.write(b"\0" * 16)  # whole words can be read at the end
        data = np.memmap(path, np.uint8, "r")
        os.unlink(path)
        self.parts = []
        return data


def view(data: np.ndarray, where: tuple[int, int, np.dtype]) -> np.ndarray:
    at, n, kind = where
    return data[at : at + n * kind.itemsize].view(kind)


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit (from 0) in each word."""
    at = np.zeros(len(words), np.uint64)
    k = k.astype(np.int64)
    for step, mask in STEPS:
        ones = np.bitwise_count((words >> at) & np.uint64(mask)).astype(np.int64)
        on = ones <= k
        k = np.where(on, k - ones, k)
        at += np.where(on, np.uint64(step), np.uint64(0))
    return at.astype(np.int64)


class Monotone:
    """A non-decreasing sequence: low bits packed side by side, high bits in unary with a count per word."""

    def __init__(self, store: Store, values: np.ndarray):
        values = np.asarray(values, np.int64)
        self.n = len(values)
        top = int(values[-1]) if self.n else 0
        self.low_bits = max(0, (top // max(1, self.n)).bit_length() - 1)
        high = values >> self.low_bits
        bits = np.zeros(self.n + (top >> self.low_bits) + 2 + 64, np.uint8)
        bits[high + np.arange(self.n)] = 1
        words = np.packbits(bits[: len(bits) // 64 * 64], bitorder="little").view(np.uint64)
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))
        self.highest = int(top >> self.low_bits)
        low = values & ((1 << self.low_bits) - 1)
        packed = np.packbits(((low[:, None] >> np.arange(self.low_bits)) & 1).astype(np.uint8).ravel(), bitorder="little") if self.low_bits else np.zeros(0, np.uint8)
        self.places = store.put(words), store.put(ones), store.put(np.concatenate([packed, np.zeros(16, np.uint8)]))

    def open(self, data: np.ndarray) -> None:
        self.words, self.ones, self.low = (view(data, p) for p in self.places)
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = i * self.low_bits
        byte, shift = at >> 3, (at & 7).astype(np.uint64)
        word = np.zeros(len(i), np.uint64)
        for b in range(8):
            word |= self.low[byte + b].astype(np.uint64) << np.uint64(8 * b)
        out = word >> shift
        if self.low_bits > 56:
            out |= np.where(shift > 0, self.low[byte + 8].astype(np.uint64) << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (out & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, side="right") - 1
        high = word * 64 + _select(self.words[word], i - self.ones[word]) - i
        return (high << self.low_bits) | self._low(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many values have high bits below ``high``: the place of the zero that ends the run before it."""
        out = np.full(len(high), self.n, np.int64)
        out[high <= 0] = 0
        some = np.flatnonzero((high > 0) & (high <= self.highest + 1))
        k = high[some] - 1
        word = np.searchsorted(self.zeros, k, side="right") - 1
        out[some] = word * 64 + _select(~self.words[word], k - self.zeros[word]) - k
        return out

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value not below ``x``; ``n`` if there is none."""
        x = np.asarray(x, np.int64)
        high = x >> self.low_bits
        first, last = self._before(high), self._before(high + 1)
        low = x & ((1 << self.low_bits) - 1)
        while len(open_ := np.flatnonzero(first < last)):
            middle = (first[open_] + last[open_]) >> 1
            below = self._low(middle) < low[open_]
            first[open_] = np.where(below, middle + 1, first[open_])
            last[open_] = np.where(below, last[open_], middle)
        return first


class Lists:
    """Ascending lists of small numbers, one per parent: pointers and, above a base per list, the entries."""

    def __init__(self, store: Store, parent: np.ndarray, value: np.ndarray, parents: int, span: int):
        """``parent`` ascends; ``value`` ascends within a parent and is below ``span``."""
        self.span = max(1, span)
        self.pointers = Monotone(store, np.searchsorted(parent, np.arange(parents + 1)))
        self.entries = Monotone(store, parent * self.span + value)

    def open(self, data: np.ndarray) -> None:
        self.pointers.open(data)
        self.entries.open(data)

    def find(self, parent: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Index of ``value`` in the list of ``parent``; -1 where it, or the parent (-1), is missing."""
        out = np.full(len(parent), -1, np.int64)
        known = np.flatnonzero((parent >= 0) & (value >= 0))
        wanted = parent[known] * self.span + value[known]
        at = self.entries.successor(wanted)
        there = np.flatnonzero(at < self.entries.n)
        there = there[self.entries[at[there]] == wanted[there]]
        out[known[there]] = at[there]
        return out


def quantised(log10: np.ndarray) -> np.ndarray:
    """Log probabilities on a grid of 16 bits, rounded down so that sums stay below 1."""
    return np.floor((np.clip(log10, LOWEST, 0) - LOWEST) / -LOWEST * GRID).astype(np.uint16)


def restored(code: np.ndarray) -> np.ndarray:
    return code.astype(np.float64) / GRID * -LOWEST + LOWEST


class Trie:
    """Contexts v, below them the words before them (u) and after them (w), and below (v, u) the words w.

    The third level names a word by its place among the words after v, so its numbers are small.
    Built from distinct ``(v, u, w)`` in ascending order with counts; ``log_q`` has the log
    probability of each w as an unigram. Kneser-Ney: the trigram level uses counts, the level
    below the number of different words before, each with one absolute discount. Where ``q`` is 0
    the unigram is not known here: ``parts`` gives what to add its share to.
    """

    def __init__(self, v: np.ndarray, u: np.ndarray, w: np.ndarray, count: np.ndarray, q: np.ndarray, discount: float):
        store = Store()
        contexts, vi = np.unique(v, return_inverse=True)
        vocabulary, ui_wi = np.unique(np.concatenate([u, w]), return_inverse=True)
        ui, wi = ui_wi[: len(u)], ui_wi[len(u) :]
        size = max(1, len(vocabulary))
        # words after v: number of different u, and the probability that continues to the unigram
        after, after_of, kinds = np.unique(vi * size + wi, return_inverse=True, return_counts=True)
        after_v = after // size
        q_after = np.zeros(len(after))
        q_after[after_of] = q
        total_v = np.bincount(vi, minlength=len(contexts)).astype(float)
        distinct_v = np.bincount(after_v, minlength=len(contexts))
        rest_v = discount * distinct_v / np.maximum(total_v, 1)
        p2 = (kinds - discount) / np.maximum(total_v[after_v], 1) + rest_v[after_v] * q_after
        # words before v, and the trigrams below them
        before, before_of, distinct_u = np.unique(vi * size + ui, return_inverse=True, return_counts=True)
        total_u = np.bincount(before_of, weights=count, minlength=len(before))
        rest_u = discount * distinct_u / np.maximum(total_u, 1)
        p3 = (count - discount) / np.maximum(total_u[before_of], 1) + rest_u[before_of] * p2[after_of]
        first_after = np.searchsorted(after_v, np.arange(len(contexts)))
        place = after_of - first_after[vi]
        self.contexts, self.vocabulary = Monotone(store, contexts), Monotone(store, vocabulary)
        self.after = Lists(store, after_v, after % size, len(contexts), size)
        self.before = Lists(store, before // size, before % size, len(contexts), size)
        span = int(distinct_v.max(initial=0)) + 1
        self.below = Lists(store, before_of, place, len(before), span)
        coded = [quantised(np.log10(np.maximum(p, 1e-30))) for p in (p2, rest_v, rest_u, p3)]
        codes = [store.put(c) for c in coded]
        open_ = np.flatnonzero(q == 0)
        self.open_rest = restored(coded[1][vi[open_]]) + restored(coded[2][before_of[open_]])
        data = store.map()
        for part in (self.contexts, self.vocabulary, self.after, self.before, self.below):
            part.open(data)
        self.p2, self.rest_v, self.rest_u, self.p3 = (view(data, c) for c in codes)
        self.bytes = len(data)

    def own_log10(self) -> np.ndarray:
        """log10 P(w | u, v) of the trigrams it was built from, in their order."""
        return restored(self.p3)

    @staticmethod
    def _exact(sequence: Monotone, x: np.ndarray) -> np.ndarray:
        at = sequence.successor(x)
        out = np.full(len(x), -1, np.int64)
        there = np.flatnonzero(at < sequence.n)
        there = there[sequence[at[there]] == x[there]]
        out[there] = at[there]
        return out

    def parts(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of what w was seen with after (u, v), -inf if nothing, and log10 of the share that goes to the unigram."""
        seen_log, rest = np.full(len(v), -np.inf), np.zeros(len(v))
        if not self.contexts.n:
            return seen_log, rest
        names, back = np.unique(np.concatenate([u, w]), return_inverse=True)
        local = self._exact(self.vocabulary, names)[back]
        lu, lw = local[: len(u)], local[len(u) :]
        names, back = np.unique(v, return_inverse=True)
        lv = self._exact(self.contexts, names)[back]
        known = lv >= 0
        after = self.after.find(lv, lw)
        rest[known] += restored(self.rest_v[lv[known]])
        seen = after >= 0
        seen_log[seen] = restored(self.p2[after[seen]])
        before = self.before.find(lv, lu)
        both = np.flatnonzero(before >= 0)
        less = restored(self.rest_u[before[both]])
        rest[both] += less
        seen_log[both] += less
        there = both[after[both] >= 0]
        place = after[there] - self.after.pointers[lv[there]]
        below = self.below.find(before[there], place)
        seen_log[there[below >= 0]] = restored(self.p3[below[below >= 0]])
        return seen_log, rest

    def log10(self, v: np.ndarray, u: np.ndarray, w: np.ndarray, log_q: np.ndarray) -> np.ndarray:
        """log10 P(w | u, v) of each row, whose w have their unigrams here."""
        seen_log, rest = self.parts(v, u, w)
        return np.where(np.isneginf(seen_log), rest + log_q, seen_log)
