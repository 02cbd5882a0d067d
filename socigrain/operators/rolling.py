"""Order statistics and moments of every window along one block of values."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np


class SortedWindow:
    """The values of a window in order, in short sorted runs of at most ``2 * run`` values.

    Adding and removing touch one run; a rank is found by walking the runs' lengths.  Equal values may
    lie in several runs.
    """

    def __init__(self, run: int = 512):
        self.run = run
        self.runs: list[list[float]] = []
        self.tops: list[float] = []

    def add(self, x: float) -> None:
        if not self.runs:
            self.runs, self.tops = [[x]], [x]
            return
        i = min(bisect_left(self.tops, x), len(self.runs) - 1)
        here = self.runs[i]
        insort(here, x)
        if len(here) > 2 * self.run:
            self.runs[i:i + 1] = [here[:self.run], here[self.run:]]
            self.tops[i:i + 1] = [here[self.run - 1], here[-1]]
        else:
            self.tops[i] = here[-1]

    def remove(self, x: float) -> None:
        """Take out one value equal to ``x``, which must be there."""
        i = bisect_left(self.tops, x)
        here = self.runs[i]
        del here[bisect_left(here, x)]
        if here:
            self.tops[i] = here[-1]
        else:
            del self.runs[i], self.tops[i]

    def at(self, ranks: Sequence[int]) -> list[float]:
        """The values at rising ranks, in one walk."""
        found, before, i = [], 0, 0
        for rank in ranks:
            while rank - before >= len(self.runs[i]):
                before += len(self.runs[i])
                i += 1
            found.append(self.runs[i][rank - before])
        return found


def rolling_quantiles(x: np.ndarray, window: int, probs: Sequence[float]) -> list[np.ndarray]:
    """Linearly interpolated quantiles of the last ``window`` values; NaN where one is missing or NaN."""
    places = [p * (window - 1) for p in probs]
    lows = [int(p) for p in places]
    highs = [min(low + 1, window - 1) for low in lows]
    ranks = sorted({*lows, *highs})
    slot = {rank: i for i, rank in enumerate(ranks)}
    picked = np.full((len(x), len(ranks)), np.nan)
    _slide(x, window, ranks, picked)
    out = []
    for place, low, high in zip(places, lows, highs):
        a, b = picked[:, slot[low]], picked[:, slot[high]]
        share = place - low
        out.append(a if not share else a * (1 - share) + b * share)
    return out


def _slide(x: np.ndarray, window: int, ranks: Sequence[int], picked: np.ndarray) -> None:
    """Fill in the values at ``ranks`` of every full window, adding and removing one value per frame."""
    values, bad = x.tolist(), np.isnan(x).tolist()
    ordered, holes = SortedWindow(), 0
    for i, v in enumerate(values):
        if bad[i]:
            holes += 1
        else:
            ordered.add(v)
        if i >= window:
            if bad[i - window]:
                holes -= 1
            else:
                ordered.remove(values[i - window])
        if i >= window - 1 and not holes:
            picked[i] = ordered.at(ranks)


def rolling_moments(x: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sample standard deviation of the last ``window`` values; NaN where one is missing or NaN.

    The block is cut in pieces of a window's length.  A window is the end of one piece and the start of
    the next, and the two are combined; nothing is subtracted from a running sum, so a large value leaves
    no error behind in the windows after it.
    """
    n = len(x)
    mean, std = np.full(n, np.nan), np.full(n, np.nan)
    if n < window:
        return mean, std
    pieces = -(-n // window)
    padded = np.full(pieces * window, np.nan)
    padded[:n] = x
    grid = padded.reshape(pieces, window)
    size = np.arange(1, window + 1)
    with np.errstate(invalid="ignore", over="ignore"):
        start_mean, start_dev = _cumulated(grid, size)
        end_mean, end_dev = (m[:, ::-1] for m in _cumulated(grid[:, ::-1], size))
        at = np.arange(window - 1, n)
        piece, place = np.divmod(at, window)
        b_n = place + 1
        a_n = window - b_n
        first = (at - window + 1) % window
        whole = a_n == 0
        before = np.maximum(piece - 1, 0)
        a_mean = np.where(whole, 0.0, end_mean[before, first])
        a_dev = np.where(whole, 0.0, end_dev[before, first])
        b_mean, b_dev = start_mean[piece, place], start_dev[piece, place]
        mean[window - 1:] = (a_mean * a_n + b_mean * b_n) / window
        apart = np.where(whole, 0.0, b_mean - a_mean)
        if window > 1:
            dev = a_dev + b_dev + apart * apart * (a_n * b_n / window)
            std[window - 1:] = np.sqrt(dev / (window - 1))
    return mean, std


def _cumulated(grid: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sum of squared deviations of each row's first 1, 2, .. values."""
    mean = np.cumsum(grid, axis=1) / size
    # each new value adds the product of its distances from the mean before and after it
    step = np.zeros_like(grid)
    step[:, 1:] = (grid[:, 1:] - mean[:, :-1]) * (grid[:, 1:] - mean[:, 1:])
    dev = np.cumsum(np.where(np.isnan(grid), np.nan, step), axis=1)
    return mean, dev
