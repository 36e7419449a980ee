"""Byte-pair merging by vectorised rounds over flat symbol arrays."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

NEVER = np.int32(2**31 - 1)


class Merges:
    """Pairs of symbols that become one, each as (left << 32 | right, rank, new symbol); the least rank first, the leftmost among equals.

    The symbols of all words stand in one array. A round finds each word's best rank and merges all its places, from the left and
    without overlap, up to the first one that makes a neighbour pair as good or better, which has to come before the places behind
    it. So one round does what as many single steps would have done, and words that are done leave the arrays.
    """

    def __init__(self, merges: Iterable[tuple[int, int, int]]):
        merges = sorted(merges)
        self.pair_keys = np.array([m[0] for m in merges] + [1 << 62], np.int64)
        self.pair_ranks = np.array([m[1] for m in merges] + [NEVER], np.int32)
        self.pair_ids = np.array([m[2] for m in merges] + [0], np.int32)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair of symbols, NEVER where they are no piece together, and that piece."""
        keys = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        found = self.pair_keys[at] == keys
        return np.where(found, self.pair_ranks[at], NEVER), self.pair_ids[at]

    def merged(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols left of all words, in order: symbol, word, place of its first symbol. ``word`` numbers the words in order."""
        start, done = np.arange(len(symbol), dtype=np.int64), []
        rank, piece = np.full(len(symbol), NEVER, np.int32), np.zeros(len(symbol), np.int32)
        if len(symbol) > 1:
            rank[:-1], piece[:-1] = self.ranks(symbol[:-1], symbol[1:])
            rank[:-1][word[1:] != word[:-1]] = NEVER
        while len(symbol):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.append(first, len(word)))
            best = np.minimum.reduceat(rank, first)
            if (best == NEVER).any():
                over = np.repeat(best == NEVER, size)
                done.append((symbol[over], word[over], start[over]))
                left = ~over
                symbol, word, start, rank, piece = symbol[left], word[left], start[left], rank[left], piece[left]
                size, best = size[best != NEVER], best[best != NEVER]
                if not len(symbol):
                    break
            symbol, word, start, rank, piece = self._round(symbol, word, start, rank, piece, np.repeat(best, size))
        if not done:
            return symbol, word, start
        symbol, word, start = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(start, kind="stable")
        return symbol[order], word[order], start[order]

    def _round(self, symbol, word, start, rank, piece, best):
        """One round of merges of the places whose rank is their word's best."""
        n = len(symbol)
        wanted = rank == best
        # Of places in a row, which overlap, every other one from the left.
        places = np.arange(n)
        row = np.maximum.accumulate(np.where(wanted & ~np.concatenate(([False], wanted[:-1])), places, 0))
        at = np.flatnonzero(wanted & ((places - row) % 2 == 0))
        made, own, top = piece[at], word[at], rank[at]
        taken = np.zeros(n + 2, bool)
        taken[at] = True
        # What the new symbol makes with its right neighbour, not yet merged, and its left one, merged already.
        after = np.minimum(at + 2, n - 1)
        right, right_piece = self.ranks(made, symbol[after])
        right = np.where((at + 2 < n) & (word[after] == own), right, NEVER)
        behind = np.where(taken[at - 2] & (at >= 2), at - 2, at - 1)
        same = (at >= 1) & (word[behind] == own)
        before = np.where(behind == at - 2, piece[behind], symbol[behind])
        left, left_piece = self.ranks(before, made)
        left = np.where(same, left, NEVER)
        stops = (left <= top) | (right <= top)
        if stops.any():
            seen = np.cumsum(stops) - stops
            head = np.concatenate(([True], own[1:] != own[:-1]))
            ok = seen == np.maximum.accumulate(np.where(head, seen, 0))
            at, made, right, right_piece, left, left_piece, behind, same = (x[ok] for x in (at, made, right, right_piece, left, left_piece, behind, same))
        symbol[at], rank[at], piece[at] = made, right, right_piece
        rank[behind[same]], piece[behind[same]] = left[same], left_piece[same]
        keep = np.ones(n, bool)
        keep[at + 1] = False
        return symbol[keep], word[keep], start[keep], rank[keep], piece[keep]
