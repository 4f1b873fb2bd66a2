"""FM-index: backward search over a wavelet tree of the Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

from gleaner.llm.suffixes import Bits, Shard, Streamer


class WaveletTree:
    """The symbols' bits level by level, zeros before ones."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.bits = max(1, int(most).bit_length())
        self.levels = []
        current = symbols.astype(np.int64)
        for level in range(self.bits - 1, -1, -1):
            bit = ((current >> level) & 1).astype(np.uint8)
            self.levels.append((Bits(bit), len(bit) - int(bit.sum())))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

        # Where each symbol's own positions begin after the last level.
        self.first = np.zeros(int(most) + 1, np.int64)
        self.first = self.rank(np.arange(len(self.first)), self.first)[0]

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol stands before its position, and whether it stands there."""
        at, here = position, np.ones(len(position), bool)
        for level, (bits, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            one = ((symbol >> level) & 1).astype(bool)
            ones, bit = bits.rank(at)
            here &= bit == one
            at = np.where(one, zeros + ones, at - ones)
        return at - self.first[symbol], here


class FMIndex(Streamer):
    """Backward search of the streamed segments over the wavelet tree."""

    def __init__(self, shard: Shard):
        super().__init__(shard)
        self.before = shard.before
        self.tree = WaveletTree(shard.bwt, len(shard.before))

    def extend(self, symbol, low, high, place):
        base = self.before[symbol]
        upto, here = self.tree.rank(symbol, high - 1)
        since = upto.copy()
        # Intervals of one suffix need one search.
        wide = np.flatnonzero(high - low > 1)
        since[wide] = self.tree.rank(symbol[wide], low[wide])[0]
        return base + since, base + upto + here, place
