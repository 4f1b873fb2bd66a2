"""Run-length index: the runs of the Burrows-Wheeler transform with samples at their ends."""

from __future__ import annotations

import numpy as np

from gleaner.llm.suffixes import Bits, Shard, Streamer


class RunIndex(Streamer):
    """Backward search over runs: what is kept is proportional to their number, but for one bit a symbol
    (and 20 bits of counts for 64 of them) that tells which run a position is in.

    The places of the runs' ends are stored. With them each match carries the place of its last
    suffix, and most repeats are known from that place alone.
    """

    def __init__(self, shard: Shard):
        super().__init__(shard)
        self.before = shard.before
        bwt = shard.bwt.astype(np.int64)
        new = np.ones(len(bwt), bool)
        new[1:] = bwt[1:] != bwt[:-1]
        self.starts = np.flatnonzero(new)
        self.marks = Bits(new)
        self.heads = bwt[self.starts]
        ends = np.append(self.starts[1:], len(bwt))
        self.end_places = shard.order[ends - 1]
        lengths = ends - self.starts
        # Runs by symbol and place: how often the symbol stands before each of its runs, and after it.
        self.by_symbol = np.argsort(self.heads, kind="stable")
        heads = self.heads[self.by_symbol]
        sums = np.cumsum(lengths[self.by_symbol])
        first = np.searchsorted(heads, heads)
        earlier = sums - lengths[self.by_symbol]
        self.upto = sums - earlier[first]
        self.runs = len(self.starts)
        self.keys = heads * self.runs + self.by_symbol
        self.own = np.empty(self.runs, np.int64)
        self.own[self.by_symbol] = self.upto - lengths[self.by_symbol]

    def _run(self, position: np.ndarray) -> np.ndarray:
        """Which run a position is in."""
        before, starts = self.marks.rank(position)
        return before + starts - 1

    def _last(self, symbol: np.ndarray, run: np.ndarray) -> np.ndarray:
        """The symbol's last run before a run of another one, by symbol; -1 or another symbol's if none."""
        return np.searchsorted(self.keys, symbol * self.runs + run) - 1

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often each symbol stands before its position, whether it stands there, and the run in which
        it stands last up to there (any if there is none)."""
        run = self._run(position)
        out = self.own[run] + position - self.starts[run]
        here = self.heads[run] == symbol
        outside = np.flatnonzero(~here)
        last = self._last(symbol[outside], run[outside])
        known = (last >= 0) & (self.keys[last] // self.runs == symbol[outside])
        out[outside] = np.where(known, self.upto[last], 0)
        run[outside] = self.by_symbol[last]
        return out, here, run

    def extend(self, symbol, low, high, place):
        base = self.before[symbol]
        upto, here, run = self.rank(symbol, high - 1)
        since = upto.copy()
        # Intervals of one suffix need one search.
        wide = np.flatnonzero(high - low > 1)
        since[wide] = self.rank(symbol[wide], low[wide])[0]
        # The last suffix moves by one symbol, or is the end of the last run of the symbol before it.
        return base + since, base + upto + here, np.where(here, place, self.end_places[run]) - 1

    def located(self, low, place, own):
        """The sampled place if it is earlier than the match's own, else the earliest."""
        late = np.flatnonzero(place >= own)
        out = place.copy()
        out[late] = super().located(low[late], place[late], own[late])
        return out
