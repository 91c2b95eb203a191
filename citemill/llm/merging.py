"""Ranked merges of neighbouring symbols, for many words at once or for one long word."""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np

NEVER = 1 << 60
Look = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Pairs:
    """For every two symbols that make one: that one and its rank, as sorted arrays."""

    def __init__(self, made: dict[tuple[int, int], int], rank: dict[int, int] | None = None):
        keys = sorted(left << 32 | right for left, right in made)
        self.keys = np.array(keys, np.int64)
        self.made = np.array([made[k >> 32, k & 0xFFFFFFFF] for k in keys], np.int32)
        self.rank = self.made.astype(np.int64) if rank is None else np.array([rank[n] for n in self.made.tolist()], np.int64)
        self.one: dict[int, tuple[int, int]] | None = None

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of each two; ``NEVER`` where they make none. Negative symbols make none."""
        if not len(self.keys):
            return np.full(len(left), NEVER), np.full(len(left), -1, np.int32)
        keys = left.astype(np.int64) << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = (self.keys[at] == keys) & (left >= 0) & (right >= 0)
        return np.where(found, self.rank[at], NEVER), np.where(found, self.made[at], -1)

    def rounds(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All words merged: in each round every word merges its pair of lowest rank, the leftmost of equals.

        ``words`` has the number of each symbol's word, in rising order; so has what is returned.
        The time for a word grows with its square.
        """
        done_symbols, done_words = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        symbols = symbols.astype(np.int32)
        if len(symbols):
            low, made = self.look_up(symbols[:-1], symbols[1:])
            low = np.append(np.where(words[:-1] == words[1:], low, NEVER), NEVER)
            made = np.append(made, -1)
        while len(symbols):
            begins = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
            best = np.minimum.reduceat(low, begins)
            size = np.diff(np.append(begins, len(symbols)))
            going = np.repeat(best < NEVER, size)
            if not going.all():
                done_symbols.append(symbols[~going])
                done_words.append(words[~going])
                symbols, words, low, made = symbols[going], words[going], low[going], made[going]
                size, best = size[best < NEVER], best[best < NEVER]
                if not len(symbols):
                    break
                begins = np.cumsum(size) - size
            hit = np.flatnonzero(low == np.repeat(best, size))
            at = hit[np.searchsorted(hit, begins)]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))
            symbols, words, low, made = symbols[keep], words[keep], low[keep], made[keep]
            redo = np.concatenate((at, at[at > 0] - 1))
            redo = redo[redo + 1 < len(symbols)]
            same = words[redo] == words[redo + 1]
            low[redo], made[redo] = self.look_up(symbols[redo], symbols[redo + 1])
            low[redo[~same]] = NEVER
            low[-1] = NEVER
        symbols, words = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return symbols[order], words[order]

    def queue(self, symbols: list[int]) -> list[int]:
        """One word merged, by a queue over a linked list: time in proportion, but for a logarithm."""
        if self.one is None:
            self.one = dict(zip(self.keys.tolist(), zip(self.rank.tolist(), self.made.tolist())))
        one, n = self.one, len(symbols)
        symbols, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
        waiting: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if symbols[i] >= 0 and symbols[j] >= 0 and (found := one.get(symbols[i] << 32 | symbols[j])):
                heapq.heappush(waiting, (found[0], i, symbols[i], symbols[j], found[1]))

        gone = [False] * n
        for i in range(n - 1):
            offer(i, i + 1)
        while waiting:
            _, i, left, right, made = heapq.heappop(waiting)
            j = after[i]
            if gone[i] or j >= n or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], gone[j] = made, True
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [s for s, g in zip(symbols, gone) if not g]
