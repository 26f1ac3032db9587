"""A compressed full-text index over words: suffix order, Burrows-Wheeler transform, wavelet tree."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Counts of a value in any prefix of an array of small integers, bit by bit (a wavelet matrix).

    Each level keeps one bit per element, packed, and a running count per 64 bits.
    """

    def __init__(self, values: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.levels = []
        current = values.astype(np.int64)
        for level in range(self.bits - 1, -1, -1):
            ones = ((current >> level) & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(values) // 64 + 1, dtype=np.uint64)
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
            self.levels.append((level, words, before, len(values) - int(ones.sum())))
            current = np.concatenate([current[~ones], current[ones]])
        self.first = self._down(np.arange(size), np.zeros(size, dtype=np.int64))

    def _down(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, words, before, zeros in self.levels:
            word = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[word] + np.bitwise_count(words[word] & below)
            at = np.where((values >> level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, values: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each value occurs before each position."""
        return self._down(values, at) - self.first[values]


class FmIndex:
    """Index of several word sequences for backward search up to `depth` words.

    Suffixes are ordered by their first `depth` words; that order is enough for searching patterns
    of that length. `order` numbers every word of the sequences; a match knows its least number.
    """

    def __init__(self, sequences: list[np.ndarray], order: list[np.ndarray], depth: int):
        self.depth = depth
        lengths = np.array([len(x) for x in sequences])
        total = int(lengths.sum() + len(sequences))
        ends = np.cumsum(lengths + 1) - 1
        inside = np.ones(total, dtype=bool)
        inside[ends] = False
        words = np.concatenate(sequences)
        self.words, codes = np.unique(words, return_inverse=True)
        # 0 parts the sequences and ends the text; words count from 1.
        text = np.zeros(total, dtype=np.int64)
        text[inside] = codes + 1
        numbers = np.full(total, np.iinfo(np.int64).max)
        numbers[inside] = np.concatenate(order)
        self.size = total
        suffixes, shared = self._suffix_order(text, depth)
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.words) + 1))])
        self.tree = WaveletTree(text[suffixes - 1], len(self.words) + 1)
        self.bounds = [np.concatenate([np.flatnonzero(shared < d), [total]]) for d in range(depth + 1)]
        groups = self.bounds[depth][:-1]
        self.least = np.minimum.reduceat(numbers[suffixes], groups)

    @staticmethod
    def _suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes by their first `depth` words, and how many words each shares with the one before
        (-1 for the first)."""
        rank, covered = text, 1
        while covered < depth:
            shift = min(covered, depth - covered)
            after = np.zeros(len(text), dtype=np.int64)
            after[:-shift] = rank[shift:] + 1 if shift < len(text) else 0
            rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1]
            covered += shift
        suffixes = np.argsort(rank, kind="stable")
        padded = np.concatenate([text, np.full(depth, -1)])
        shared = np.zeros(len(text), dtype=np.int64)
        same = np.ones(len(text) - 1, dtype=bool)
        for d in range(depth):
            same &= padded[suffixes[1:] + d] == padded[suffixes[:-1] + d]
            shared[1:] += same
        shared[0] = -1
        return suffixes, shared

    def _widened(self, at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of all suffixes that share `depth` words with the suffix at `at`."""
        low, high = np.zeros_like(at), np.full_like(at, self.size)
        for d in np.unique(depth):
            if d:
                own = depth == d
                place = np.searchsorted(self.bounds[d], at[own], side="right")
                low[own], high[own] = self.bounds[d][place - 1], self.bounds[d][place]
        return low, high

    def statistics(self, sequences: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each word of each sequence, how many words match from there on (`depth` at most), and
        the least number of such a match of full depth (else a very large one).

        All sequences are searched side by side, from their last word to their first.
        """
        lengths = np.array([len(x) for x in sequences], dtype=np.int64)
        starts = np.cumsum(lengths) - lengths
        words = np.concatenate(sequences)
        place = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        codes = np.where(self.words[place] == words, place + 1, 0)
        matched = np.zeros(len(words), dtype=np.int64)
        least = np.full(len(words), np.iinfo(np.int64).max)
        low = np.zeros(len(sequences), dtype=np.int64)
        high = np.full(len(sequences), self.size, dtype=np.int64)
        depth = np.zeros(len(sequences), dtype=np.int64)
        for step in range(int(lengths.max(initial=0))):
            alive = np.flatnonzero(lengths > step)
            at = starts[alive] + lengths[alive] - 1 - step
            pending = np.arange(len(alive))
            while len(pending):
                own = alive[pending]
                code = codes[at[pending]]
                new_low = self.counts[code] + self.tree.rank(code, low[own])
                new_high = self.counts[code] + self.tree.rank(code, high[own])
                found = (code > 0) & (new_low < new_high)
                won = own[found]
                depth[won] += 1
                low[won], high[won] = new_low[found], new_high[found]
                deep = won[depth[won] > self.depth]
                depth[deep] = self.depth
                full = won[depth[won] == self.depth]
                low[full], high[full] = self._widened(low[full], depth[full])
                # Without a match, the pattern loses its last word.
                lost = own[~found]
                hopeless = (code[~found] == 0) | (depth[lost] == 0)
                depth[lost] = np.where(hopeless, 0, depth[lost] - 1)
                low[lost], high[lost] = self._widened(low[lost], depth[lost])
                pending = pending[~found][~hopeless]
            matched[at] = depth[alive]
            full = depth[alive] == self.depth
            group = np.searchsorted(self.bounds[self.depth], low[alive][full], side="right") - 1
            least[at[full]] = self.least[group]
        cuts = starts[1:]
        return np.split(matched, cuts), np.split(least, cuts)
