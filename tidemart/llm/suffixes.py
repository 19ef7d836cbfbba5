"""Suffixes of many strings in order, what neighbours have in common, and longest previous factors."""

from __future__ import annotations

import numpy as np


def packed(data: np.ndarray, width: int) -> np.ndarray:
    """``width`` (at most 8) bytes from each place as one number of 8 bytes, in the order of the bytes."""
    out = np.zeros(len(data), np.uint64)
    for j in range(min(width, len(data))):
        out[:len(data) - j] |= data[j:].astype(np.uint64) << np.uint64(56 - 8 * j)
    return out


class Suffixes:
    """Suffixes of the strings of ``symbols`` cut by ``bounds``, those of ``depth`` or more, in order of their first ``depth``.

    Prefix doubling: places are ranked by their first ``width`` symbols (one entry of ``symbols`` packs as many), then by twice as
    many, and so on; a place that is alone with its prefix keeps its rank, so only groups of equal prefixes are sorted further.

    ``order``: the places in suffix order, equal ones by place.  ``common``: symbols that each has in common with the one before
    it in the order, ``depth`` at most.
    """

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray, depth: int, width: int = 1) -> None:
        sizes = np.diff(bounds)
        left = (np.repeat(bounds[1:], sizes) - np.arange(len(symbols))).astype(np.int32)
        self.symbols, self.depth, self.width = symbols, depth, width
        self.ranks: list[tuple[int, np.ndarray]] = []
        rank = np.zeros(len(symbols), np.int32)
        at = np.flatnonzero(left >= width)
        at = at[np.argsort(symbols[at])]
        tied = self._number(rank, at, symbols[at], None)
        self.ranks.append((width, rank))
        known = width
        while known < depth:
            longer = min(2 * known, depth)
            at = tied[left[tied] >= longer]
            keys = (rank[at].astype(np.int64) << 32) | rank[at + (longer - known)]
            sort = np.argsort(keys)
            at, keys = at[sort], keys[sort]
            rank = rank.copy()
            tied = self._number(rank, at, keys, keys >> 32)
            known = longer
            self.ranks.append((known, rank))
        places = np.flatnonzero(left >= depth)
        self.order = places[np.argsort(rank[places], kind="stable")]
        self.common = np.zeros(len(self.order), np.int32)
        self.common[1:] = self._in_common(self.order[:-1], self.order[1:])
        self.ranks = []

    @staticmethod
    def _number(rank: np.ndarray, at: np.ndarray, keys: np.ndarray, group: np.ndarray | None) -> np.ndarray:
        """Ranks the places ``at``, sorted by ``keys``, by where their key begins in their ``group``; the places of keys that recur."""
        if not len(at):
            return at
        new = np.append(True, keys[1:] != keys[:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(at)))
        if group is None:
            rank[at] = np.repeat(first, count)
        else:
            of = group[first]
            begins = np.append(True, of[1:] != of[:-1])
            begin = first[begins][np.cumsum(begins) - 1]
            rank[at] = np.repeat(of + first - begin, count)
        return at[np.repeat(count > 1, count)]

    def _in_common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        whole = self.ranks[-1][1]
        equal = whole[a] == whole[b]
        common = np.where(equal, self.depth, 0).astype(np.int32)
        rest = np.flatnonzero(~equal)
        x, y, n = a[rest], b[rest], np.zeros(len(rest), np.int32)
        for known, rank in self.ranks[-2::-1]:
            # Places whose prefix would pass the depth cannot be equal there, and their ranks mean nothing.
            inside = n + known <= self.depth
            same = inside & (rank[np.where(inside, x + n, x)] == rank[np.where(inside, y + n, y)])
            n += known * same
        if self.width > 1:
            differ = self.symbols[x + n] ^ self.symbols[y + n]
            same = np.ones(len(n), bool)
            for j in range(self.width):
                same &= (differ >> np.uint64(56 - 8 * j)) & np.uint64(255) == 0
                n += same
        common[rest] = np.minimum(n, self.depth)
        return common


def _smaller_before(order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry the nearest one before it with a smaller place (-1: none), as a place, and the symbols in common with it.

    Each entry points to the one before it and follows the pointers of entries that are larger than itself, all at once; what it
    has in common with the entry reached is the least on the way.
    """
    place = np.append(-1, order)
    to = np.maximum(np.arange(-1, len(order)), 0)
    shared = np.append(0, common).astype(np.int32)
    open_ = np.flatnonzero(place[to] > place)
    while len(open_):
        via = to[open_]
        onward, least = to[via], np.minimum(shared[open_], shared[via])
        to[open_], shared[open_] = onward, least
        open_ = open_[place[onward] > place[open_]]
    return place[to[1:]], shared[1:]


def previous_factors(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous factor of each place of ``suffixes.order``, up to the depth, and the earlier place that has it (or -1).

    The longest match that starts earlier is with the nearest smaller place before or after in suffix order.
    """
    order, common = suffixes.order, suffixes.common
    before, n = _smaller_before(order, common)
    after, m = _smaller_before(order[::-1], np.append(0, common[:0:-1])[:len(order)])
    after, m = after[::-1], m[::-1]
    return np.maximum(n, m), np.where(n >= m, before, after)
