"""An index of 64-bit hashes that finds whether one lies within a few bits of another."""

from __future__ import annotations

import numpy as np

#: Hashes of the smallest level, and pairs that are compared at a time.
LEVEL, PAIRS = 1024, 1 << 20
#: From so many bits on there would be too many tables: hashes are compared with all.
TOO_FAR = 15


class NearHashes:
    """Hashes, looked up by pairs of blocks of their bits.

    With distance + 2 blocks, two hashes that differ in at most `distance` bits agree in two whole blocks. For each pair
    of blocks the hashes are kept in the order of the bits in it, so a look-up compares with those only that agree
    there. Sorted levels of equal size are merged, so adding costs a logarithmic number of sorts. `compared` counts
    the comparisons.
    """

    def __init__(self, distance: int) -> None:
        self.distance, self.compared = distance, 0
        edges = np.linspace(0, 64, distance + 3).astype(int)
        blocks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
        few = distance < TOO_FAR
        self.masks = [np.uint64(blocks[i] | blocks[j]) for i in range(len(blocks)) for j in range(i)] if few else [np.uint64(0)]
        self.levels: list[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]] = []
        self.tail = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.tail) + sum(len(h) for h, _ in self.levels)

    def add(self, hashes: np.ndarray) -> None:
        self.tail = np.concatenate([self.tail, hashes.astype(np.uint64)])
        if len(self.tail) < LEVEL:
            return
        new, self.tail = self.tail, self.tail[:0]
        while self.levels and len(self.levels[-1][0]) <= len(new):
            new = np.concatenate([self.levels.pop()[0], new])
        tables = []
        for mask in self.masks:
            keys = new & mask
            order = np.argsort(keys, kind="stable")
            tables.append((keys[order], new[order]))
        self.levels.append((new, tables))

    def near(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hash is within the distance of one that was added."""
        out = np.zeros(len(hashes), bool)
        hashes = hashes.astype(np.uint64)
        for at in range(0, len(self.tail), LEVEL):
            part = self.tail[at : at + LEVEL]
            self.compared += len(part) * len(hashes)
            out |= (np.bitwise_count(hashes[:, None] ^ part) <= self.distance).any(1)
        for _, tables in self.levels:
            for mask, (keys, own) in zip(self.masks, tables):
                open_ = np.flatnonzero(~out)
                asked = hashes[open_] & mask
                low, high = np.searchsorted(keys, asked, "left"), np.searchsorted(keys, asked, "right")
                self._compare(out, open_, hashes, own, low, high)
        return out

    def _compare(self, out: np.ndarray, rows: np.ndarray, hashes: np.ndarray, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        some = np.flatnonzero(high > low)
        rows, low, sizes = rows[some], low[some], (high - low)[some]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(rows):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
            for first in range(0, int(sizes[at]) if to == at + 1 else 1, PAIRS):  # one look-up may have very many by itself
                n = np.minimum(sizes[at:to] - first, PAIRS)
                i = np.repeat(rows[at:to], n)
                j = np.repeat(low[at:to] + first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                self.compared += len(i)
                hit = np.bitwise_count(hashes[i] ^ own[j]) <= self.distance
                out[i[hit]] = True
            at = to
