"""Piecewise-linear rank index: which offset has the k-th boundary of a text.

Boundaries are read in blocks and never held as a list of numbers.  A
segment of the index is a line through its first boundary whose error is at
most EPSILON for every boundary it covers; segments are made as long as that
allows (the cone of admissible slopes is narrowed boundary by boundary, in
vector steps of doubling length, until it is empty).  What the line misses is
stored as one signed byte per boundary, so a rank is answered exactly by one
prediction and one correction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

EPSILON = 120   # largest residual; fits a signed byte with room for rounding
BLOCK = 1 << 20  # bytes of text looked at in one vector step
FIRST_STEP = 64  # boundaries of the first vector step of a segment

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def boundaries(data: bytes) -> Iterator[np.ndarray]:
    """Ends of the tokens ``blank* nonblank+`` and of a blank tail, in blocks.

    Blanks are single bytes in UTF-8, so bytes show the boundaries of code
    points' tokens.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    for start in range(0, len(raw), BLOCK):
        stop = min(start + BLOCK, len(raw))
        blank = _BLANK[raw[start:min(stop + 1, len(raw))]]
        after = blank[1:] if stop < len(raw) else np.append(blank[1:], True)
        yield np.flatnonzero(~blank[:stop - start] & after) + (start + 1)
    if len(raw) and _BLANK[raw[-1]]:
        yield np.array([len(raw)])


@dataclass
class RankIndex:
    """``offset(k)`` of the k-th of ``n`` boundaries; boundary 0 is offset 0."""
    ranks: list[int] = field(default_factory=lambda: [0])      # first boundary of each segment
    offsets: list[int] = field(default_factory=lambda: [0])
    slopes: list[float] = field(default_factory=lambda: [0.0])
    residuals: list[bytes] = field(default_factory=list)       # one signed byte per boundary, by segment
    n: int = 0

    def offset(self, k: int) -> int:
        if not 0 <= k <= self.n:
            raise IndexError(f"boundary {k} of {self.n}")
        s = int(np.searchsorted(self.ranks, k, side="right")) - 1
        predicted = self.offsets[s] + round((k - self.ranks[s]) * self.slopes[s])
        at = k - self.ranks[s]
        return predicted + (np.frombuffer(self.residuals[s], dtype=np.int8)[at - 1].item() if at else 0)


def _admissible(x: np.ndarray, y: np.ndarray, low: float, high: float) -> tuple[int, float, float]:
    """How many of the points one line can serve, given the slopes that served
    the points before, and the slopes that are left."""
    lows = np.maximum.accumulate(np.maximum((y - EPSILON) / x, low))
    highs = np.minimum.accumulate(np.minimum((y + EPSILON) / x, high))
    good = len(x) if lows[-1] <= highs[-1] else int(np.argmax(lows > highs))
    return (good, lows[good - 1], highs[good - 1]) if good else (0, low, high)


def fit(blocks: Iterator[np.ndarray]) -> RankIndex:
    """Index of the boundaries that ``blocks`` yields in ascending order."""
    index, held = RankIndex(), []   # held: offsets of the open segment, its first left out
    low, high = -np.inf, np.inf

    def close() -> None:
        slope = (low + high) / 2 if held else 0.0
        ys = np.concatenate(held) if held else np.zeros(0, dtype=np.int64)
        index.slopes[-1] = float(slope)
        line = index.offsets[-1] + np.rint(np.arange(1, len(ys) + 1) * index.slopes[-1]).astype(np.int64)
        index.residuals.append((ys - line).astype(np.int8).tobytes())
        held.clear()

    covered = 0                     # boundaries of the open segment besides its first
    for block in blocks:
        i, step = 0, FIRST_STEP
        while i < len(block):
            part = block[i:i + step].astype(np.int64)
            x = np.arange(covered + 1, covered + 1 + len(part))
            good, low, high = _admissible(x, part - index.offsets[-1], low, high)
            if good:
                held.append(part[:good])
                covered += good
                i += good
                step *= 2
            if good < len(part):    # the next boundary starts a segment
                close()
                index.ranks.append(index.ranks[-1] + covered + 1)
                index.offsets.append(int(block[i]))
                index.slopes.append(0.0)
                low, high, covered, step = -np.inf, np.inf, 0, FIRST_STEP
                i += 1
    close()
    index.n = index.ranks[-1] + covered
    return index
