"""A bidirectional FM-index over word ids: n-grams with their counts by
extension of Burrows-Wheeler intervals.

The sequence holds ids from 1 and separators 0; no n-gram crosses a separator.
Its positions are sorted by the ``depth`` symbols that follow (and, for the
other direction, that precede), which is as much of the suffix order as
intervals of n-grams up to ``depth`` need: the rows below an interval are the
rows that start with something smaller, whatever the order inside it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np


def in_order(*keys: np.ndarray) -> np.ndarray:
    """The places of rows in the order of several keys, none negative, and
    then of the places: one sort of packed numbers where they fit in 63 bits."""
    bits = [max(1, int(k.max(initial=0)).bit_length()) for k in keys]
    place = max(1, len(keys[0]).bit_length())
    if sum(bits) + place > 63:
        return np.lexsort(keys[::-1])
    packed = keys[0].astype(np.int64)
    for k, b in zip(keys[1:], bits[1:], strict=True):
        packed = packed << b | k
    packed = packed << place | np.arange(len(packed))
    packed.sort()
    return packed & ((1 << place) - 1)


def _sorted_rows(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` symbols, around the end."""
    bits = max(1, int(seq.max()).bit_length())
    if bits * depth <= 63:
        packed = seq.astype(np.int64)
        for d in range(1, depth):
            packed = packed << bits | np.roll(seq, -d)
        return np.argsort(packed)
    keys = (seq, np.roll(seq, -1)) if depth > 1 else (seq,)
    for d in range(len(keys), depth):
        order = in_order(*keys)
        edge = np.zeros(len(seq), bool)
        for k in keys:
            line = k[order]
            edge[1:] |= line[1:] != line[:-1]
        rank = np.empty(len(seq), np.int64)
        rank[order] = np.cumsum(edge)
        keys = rank, np.roll(seq, -d)
    return in_order(*keys)


class Side:
    """The transform in one direction: the symbol before every sorted row, and
    the last-to-first mapping (C[symbol] + Occ(symbol, row))."""

    def __init__(self, seq: np.ndarray, depth: int):
        self.last = seq[_sorted_rows(seq, depth) - 1]
        self.first = np.empty(len(seq), np.int64)
        self.first[in_order(self.last)] = np.arange(len(seq))
        self.words = np.concatenate(([0], np.cumsum(self.last > 0)))

    def extended(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Occurrences with a word before them, in this direction."""
        return self.words[low + size] - self.words[low]


@dataclass(frozen=True)
class Grams:
    """N-grams of one length: their ids (a row for every place), how often
    they occur, and their intervals in both directions."""
    ids: np.ndarray
    size: np.ndarray
    low: tuple[np.ndarray, np.ndarray]  # going left, going right

    def where(self, keep: np.ndarray) -> Grams:
        return Grams(self.ids[:, keep], self.size[keep], (self.low[0][keep], self.low[1][keep]))


class FMIndex:
    def __init__(self, seq: np.ndarray, depth: int):
        """``seq`` starts and ends with a separator.  A direction is built
        when an extension first goes that way."""
        self.seq, self.depth, self.built = seq, depth, {}
        self.counts = np.bincount(seq)

    def side(self, right: bool) -> Side:
        if right not in self.built:
            self.built[right] = Side(self.seq[::-1] if right else self.seq, self.depth)
        return self.built[right]

    def words(self) -> Grams:
        low = np.cumsum(self.counts) - self.counts
        ids = np.flatnonzero(self.counts[1:]) + 1
        return Grams(ids[None], self.counts[ids], (low[ids], low[ids]))

    def extend(self, grams: Grams, right: bool) -> Grams:
        """All n-grams with one word more at the left or at the right end."""
        side, own, other = self.side(right), grams.low[right], grams.low[not right]
        size = grams.size
        start = np.cumsum(size) - size  # of each one's rows, laid one after another
        source = np.repeat(np.arange(len(size)), size)
        row = np.arange(len(source)) + (own - start)[source]
        order = in_order(source, side.last[row])
        row = row[order]  # the source of a place stays as it was
        symbol = side.last[row]
        head = np.ones(len(row), bool)
        head[1:] = (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])
        head = np.flatnonzero(head)
        count = np.diff(np.append(head, len(row)))
        keep = symbol[head] > 0
        head, count = head[keep], count[keep]
        source, symbol = source[head], symbol[head]
        new_own, new_other = side.first[row[head]], other[source] + head - start[source]
        ids = np.vstack((grams.ids[:, source], symbol[None]) if right else (symbol[None], grams.ids[:, source]))
        return Grams(ids, count, (new_other, new_own) if right else (new_own, new_other))

    def neighbours(self, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
        """How many occurrences have a word to the left, and to the right."""
        return tuple(self.side(right).extended(grams.low[right], grams.size) for right in (False, True))

    def ngrams(self, depth: int, keep: Callable[[np.ndarray], np.ndarray]) -> Iterator[Grams]:
        """The n-grams of 1 to ``depth`` words that ``keep`` (ids -> which of
        them) lets pass; a longer one is reached only over shorter ones that
        passed, by turns to the right and to the left."""
        grams = self.words()
        for n in range(1, depth + 1):
            if n > 1:
                grams = self.extend(grams, right=n % 2 == 0)
            grams = grams.where(keep(grams.ids))
            yield grams
