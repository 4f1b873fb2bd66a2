"""Suffixes of a shard in order of their first symbols, and what the two indexes share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def _heads(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ordered keys where its group of equal ones begins, and whether it is in one of several."""
    new = np.ones(len(ordered) + 1, bool)
    new[1:-1] = ordered[1:] != ordered[:-1]
    return np.maximum.accumulate(np.where(new[:-1], np.arange(len(ordered)), 0)), ~(new[:-1] & new[1:])


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key how many are smaller, and the places of keys that occur several times."""
    order = np.argsort(keys)
    heads, shared = _heads(keys[order])
    out = np.empty(len(keys), np.int64)
    out[order] = heads
    return out, order[shared]


def _paired(ranks: np.ndarray, ahead: int, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks by their own value and then by the one ``ahead`` symbols on. Only those that are shared change."""
    following = np.zeros(len(shared), np.int64)
    inside = np.flatnonzero(shared + ahead < len(ranks))
    following[inside] = ranks[shared[inside] + ahead] + 1
    keys = (ranks[shared] << 32) | following
    order = np.argsort(keys)
    heads, still = _heads(keys[order])
    places = shared[order]
    own = ranks[places]
    out = ranks.copy()
    out[places] = own + heads - _heads(own)[0]
    return out, places[still]


class Shard:
    """Segments, one after the other, each ended by symbol 0, with the order of their suffixes.

    Ends count as different symbols in the order of their places, so suffixes are compared within
    their segment, all differ, and moving one symbol to the left keeps their order. ``cut[d]`` marks,
    for d of ``width - 1`` and ``width``, the suffixes that do not share d symbols with the one before.
    """

    def __init__(self, symbols: np.ndarray, width: int):
        self.symbols, self.width = symbols, width
        ends = np.flatnonzero(symbols == 0)
        longest = int(np.diff(ends, prepend=-1).max())
        first = symbols.astype(np.int64) + len(ends)
        first[ends] = np.arange(len(ends))
        # The first ranking takes as many symbols at once as fit a number.
        bits, depth = int(first.max() + 1).bit_length(), 1
        keys = first + 1
        while 2 * depth * bits < 63 and 2 * depth < width:
            following = np.zeros(len(keys), np.int64)
            following[: len(keys) - depth] = keys[depth:]
            keys = (keys << (depth * bits)) | following
            depth *= 2
        first_ranks, shared = _ranked(keys)
        ranks = {depth: first_ranks}
        while depth < longest and len(shared):
            ranks[2 * depth], shared = _paired(ranks[depth], depth, shared)
            depth *= 2
        self.order = np.empty(len(first), np.int64)
        self.order[ranks[depth]] = np.arange(len(first))
        self.cut = {d: self._differ(ranks, d) for d in (width - 1, width)}
        # The symbol before each suffix; the one before the first is the end of the last segment.
        self.bwt = symbols[self.order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=int(symbols.max()) + 2))])

    def _differ(self, ranks: dict[int, np.ndarray], depth: int) -> np.ndarray:
        """Two ranks that overlap tell whether the first ``depth`` symbols are equal."""
        half = max(d for d in ranks if d <= depth)
        further = np.full(len(self.symbols), -1, np.int64)
        ahead = depth - half
        further[: len(further) - ahead] = ranks[half][ahead:]
        one, two = ranks[half][self.order], further[self.order]
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        return new


class Bits:
    """Packed bits with counts: in full for 512 bits and, within these, in 16 bits for each word of 64."""

    def __init__(self, bit: np.ndarray):
        padded = np.zeros(-(-(len(bit) + 1) // 512) * 512, np.uint8)
        padded[: len(bit)] = bit
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        before = np.cumsum(counts) - counts
        self.blocks = before[::8].astype(np.int32)
        self.inner = (before - np.repeat(before[::8], 8)).astype(np.uint16)

    def rank(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many bits are set before each position, and whether the one there is."""
        index, shift = position >> 6, (position & 63).astype(np.uint64)
        word = self.words[index]
        below = np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1)))
        ones = self.blocks[position >> 9] + self.inner[index].astype(np.int64) + below
        return ones, ((word >> shift) & np.uint64(1)).astype(bool)


class Streamer:
    """Streams segments through an index, all at once, one symbol per step from the right.

    The state of a segment is the interval of suffixes that begin with its last symbols read, at
    most ``width``, and the place of the interval's last suffix. A full match drops its last symbol,
    which widens the interval to the suffixes that share ``width - 1`` symbols, before it takes the
    next one. Only groups of several suffixes are stored for that, so what is kept grows with the
    repeats of a shard and not with its length.
    """

    def __init__(self, shard: Shard):
        self.width = shard.width
        self.n = len(shard.order)
        self.last_place = int(shard.order[-1])
        # Groups of several suffixes that share width - 1 symbols. All other suffixes are alone.
        heads = np.append(np.flatnonzero(shard.cut[shard.width - 1]), self.n)
        wide = np.flatnonzero(np.diff(heads) > 1)
        self.wide_low, self.wide_high = heads[wide].astype(np.int32), heads[wide + 1].astype(np.int32)
        self.wide_places = shard.order[heads[wide + 1] - 1].astype(np.int32)
        # The earliest place of each full match that stands at several places.
        heads = np.flatnonzero(shard.cut[shard.width])
        repeated = np.flatnonzero(np.diff(heads, append=self.n) > 1)
        self.full_low = heads[repeated].astype(np.int32)
        self.earliest = np.minimum.reduceat(shard.order, heads)[repeated].astype(np.int32)

    def extend(
        self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray, place: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The intervals with ``symbol`` put before the match, and the places of their last suffixes
        (the given ones if the index has no samples)."""
        raise NotImplementedError

    def matches(
        self, segments: np.ndarray, lengths: np.ndarray, starts: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each step the segments that end a full match, where it starts, and an earlier place.

        ``segments`` is a matrix with a row per segment, filled with 0 after its end; ``starts`` has
        their places in the shard. The place reported is before the segment's own if any is.
        """
        rows = np.arange(len(lengths))
        low, high = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.n, np.int64)
        depth, place = np.zeros(len(lengths), np.int64), np.full(len(lengths), self.last_place, np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = rows[lengths > step]
            at = lengths[live] - 1 - step
            lo, hi, d, p = low[live], high[live], depth[live], place[live]
            full = d == self.width
            if full.any():
                d[full] -= 1
                group = np.searchsorted(self.wide_low, lo[full], side="right") - 1
                several = group >= 0
                several[several] = lo[full][several] < self.wide_high[group[several]]
                wider, group = np.flatnonzero(full)[several], group[several]
                lo[wider], hi[wider], p[wider] = self.wide_low[group], self.wide_high[group], self.wide_places[group]
            lo, hi, p = self.extend(segments[live, at].astype(np.int64), lo, hi, p)
            # A symbol that does not occur before the match ends it; the next symbol starts anew.
            gone = lo >= hi
            lo[gone], hi[gone], d[gone], p[gone] = 0, self.n, -1, self.last_place
            low[live], high[live], depth[live], place[live] = lo, hi, d + 1, p
            done = np.flatnonzero(d + 1 == self.width)
            if len(done):
                found = self.located(lo[done], p[done], starts[live[done]] + at[done])
                yield live[done], at[done], found

    def located(self, low: np.ndarray, place: np.ndarray, own: np.ndarray) -> np.ndarray:
        """The earliest place of each full match; one that stands nowhere else is at its own."""
        out = own.copy()
        group = np.searchsorted(self.full_low, low, side="right") - 1
        known = np.flatnonzero(group >= 0)
        known = known[self.full_low[group[known]] == low[known]]
        out[known] = self.earliest[group[known]]
        return out
