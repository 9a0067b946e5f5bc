"""Spread and slope over the last values of a series, for one task's records."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from numpy.lib.stride_tricks import sliding_window_view

from corpusloom import fixed_values as fv


def _windows(series: np.ndarray, fresh: int, size: int):
    """The window that ends at each of the last ``fresh`` values, and its count.

    Windows that reach before the series are filled up with NaN on the left.
    """
    earlier = len(series) - fresh
    padded = np.concatenate((np.full(max(0, size - 1 - earlier), np.nan), series))
    counts = np.minimum(size, np.arange(earlier + 1, len(series) + 1))
    return sliding_window_view(padded, size)[len(padded) - size + 1 - fresh:], counts


def _middle(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Median of the ``counts`` numbers of each row; NaN sorts behind them."""
    ordered = np.sort(values, axis=1)
    low, high = (np.take_along_axis(ordered, at[:, None], 1)[:, 0] for at in ((counts - 1) // 2, counts // 2))
    return (low + high) / 2


TREE_FROM = 448   # window from which the tree is cheaper than sorting every window


class OrderStatistics:
    """The k-th smallest of any stretch of a series, for many stretches at once.

    The values' ranks are split bit by bit, from the highest on; a level knows
    how many ranks before each place have a zero there.  A query walks down
    the levels, so it costs the logarithm of the series' length.
    """

    def __init__(self, series: np.ndarray):
        order = np.argsort(series, kind="stable")
        ranks = np.empty(len(series), dtype=np.int64)
        ranks[order] = np.arange(len(series))
        self.ordered, self.levels = series[order], []
        for bit in range(max(len(series) - 1, 0).bit_length() - 1, -1, -1):
            ones = ranks >> bit & 1
            zeros = np.concatenate(([0], np.cumsum(1 - ones)))
            self.levels.append((bit, zeros, int(zeros[-1])))
            ranks = np.concatenate((ranks[ones == 0], ranks[ones == 1]))

    def smallest(self, start: np.ndarray, end: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th smallest, from 0, of each half-open stretch."""
        rank = np.zeros(len(start), dtype=np.int64)
        for bit, zeros, n_zeros in self.levels:
            low, high = zeros[start], zeros[end]
            up = k >= high - low
            k = np.where(up, k - (high - low), k)
            start, end = np.where(up, n_zeros + start - low, low), np.where(up, n_zeros + end - high, high)
            rank |= up.astype(np.int64) << bit
        return self.ordered[rank]


def _spread_by_order(series: np.ndarray, fresh: int, size: int) -> np.ndarray:
    """Median absolute deviation without looking at whole windows.

    Seen from the median, the values below it and those above it are two
    rising rows of distances.  The middle distance of both together takes some
    number from the lower row, which is found by bisection.  Around an
    infinite median the middle distance is undefined.
    """
    end = np.arange(len(series) - fresh + 1, len(series) + 1)
    start = np.maximum(end - size, 0)
    count, tree = end - start, OrderStatistics(series)

    def at(k: np.ndarray) -> np.ndarray:
        return tree.smallest(start, end, np.clip(k, 0, count - 1))
    middle = (at((count - 1) // 2) + at(count // 2)) / 2
    half, place = (count + 1) // 2, (count - 1) // 2

    def below(i: np.ndarray) -> np.ndarray:
        return middle - at(half - 1 - i)

    def above(i: np.ndarray) -> np.ndarray:
        return at(half + i) - middle
    low, high = np.maximum(0, place + 1 - (count - half)), np.minimum(place + 1, half)
    while (open_ := low < high).any():
        taken = (low + high) // 2
        enough = below(taken) >= above(place - taken)
        low, high = np.where(open_ & ~enough, taken + 1, low), np.where(open_ & enough, taken, high)
    rest = place + 1 - low
    first = np.maximum(np.where(low > 0, below(low - 1), -np.inf), np.where(rest > 0, above(rest - 1), -np.inf))
    second = np.minimum(np.where(low < half, below(low), np.inf), np.where(rest < count - half, above(rest), np.inf))
    return np.where(np.isfinite(middle), np.where(count % 2 == 1, first, (first + second) / 2), np.nan)


SLICE = 1 << 20   # values of windows that are looked at together


def _in_slices(work: Callable[[np.ndarray, np.ndarray], np.ndarray], series: np.ndarray, fresh: int, size: int) -> np.ndarray:
    """``work`` on the windows of some records at a time, so no more than ``SLICE`` values stand side by side."""
    windows, counts = _windows(series, fresh, size)
    some = max(1, SLICE // size)
    return np.concatenate([work(windows[at: at + some], counts[at: at + some]) for at in range(0, fresh, some)])


def sigma_of_last(series: np.ndarray, fresh: int, size: int) -> np.ndarray:
    """Scaled median absolute deviation; 0 below three values.

    Both ways give the same numbers.  Short windows are sorted, each anew;
    long ones are read off a tree over the series, which takes the logarithm
    of its length for a record and no room for the windows.
    """
    if not fresh:
        return np.empty(0)
    if size < TREE_FROM:
        return _in_slices(_sorted_sigma, series, fresh, size)
    end = np.arange(len(series) - fresh + 1, len(series) + 1)
    start = np.maximum(end - size, 0)
    undefined = np.concatenate(([0], np.cumsum(np.isnan(series))))
    # An undefined value has the last rank, so it changes only windows that hold it.
    with np.errstate(invalid="ignore"):
        spread = fv.MAD_SCALE * _spread_by_order(series, fresh, size)
    return np.where(end - start < 3, 0.0, np.where(undefined[end] > undefined[start], np.nan, spread))


def _sorted_sigma(windows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    spread = fv.MAD_SCALE * _middle(np.abs(windows - _middle(windows, counts)[:, None]), counts)
    broken = np.isnan(windows).sum(axis=1) > windows.shape[1] - counts
    return np.where(counts < 3, 0.0, np.where(broken, np.nan, spread))


SUMS_FROM = 448   # window from which the slope comes from running sums


def slope_of_last(series: np.ndarray, fresh: int, size: int) -> np.ndarray:
    """Least-squares slope against the index; 0 below eight values.

    The values of a short window are multiplied by their places, each window
    anew; a long one is the difference of two running sums.
    """
    if not fresh:
        return np.empty(0)
    if size >= SUMS_FROM:
        return _slope_by_sums(series, fresh, size)
    return _in_slices(_fitted_slope, series, fresh, size)


def _fitted_slope(windows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    size = windows.shape[1]
    place = np.arange(size) - (size - counts)[:, None]
    centred = np.where(place >= 0, place - (counts[:, None] - 1) / 2, 0.0)
    products = np.where(place >= 0, windows, 0.0) * centred
    squares = np.maximum(counts * (counts ** 2.0 - 1) / 12, 1.0)
    return np.where(counts < 8, 0.0, products.sum(axis=1) / squares)


def _slope_by_sums(series: np.ndarray, fresh: int, size: int) -> np.ndarray:
    """The slope in a number of steps that does not grow with the window.

    Borders stand every ``size`` records, so a window holds one.  Sums of the
    values, and of the values times their place, run from each border both
    ways; a window is one sum to the left and one to the right, and no digits
    are lost to what lies outside it.
    """
    end = np.arange(len(series) - fresh + 1, len(series) + 1)
    start = np.maximum(end - size, 0)
    count, sound = end - start, np.isfinite(series)
    rows = -(-len(series) // size)
    values = np.zeros((rows, size))
    values.flat[:len(series)] = np.where(sound, series, 0.0)
    heads, place = values[:, :1], np.arange(size)
    after = values - heads
    before = values[:-1] - heads[1:]      # of a border: the records of the row above it
    row = (end - 1) // size
    border = row * size

    def both(after: np.ndarray, before: np.ndarray) -> np.ndarray:
        right, left = np.cumsum(after, axis=1), np.cumsum(before[:, ::-1], axis=1)[:, ::-1]
        inside = start < border
        made = right[row, end - 1 - border]
        made[inside] += left[row[inside] - 1, start[inside] % size]
        return made
    total, moment = both(after, before), both(after * place, before * (place - size))
    middle = (start + end - 1) / 2 - border
    squares = np.maximum(count * (count ** 2.0 - 1) / 12, 1.0)
    slope = (moment - middle * total) / squares
    return np.where(count < 8, 0.0, slope if sound.all() else _with_wild(slope, series, start, end))


def _with_wild(slope: np.ndarray, series: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Slopes of windows with infinite or undefined values, as their products would add up."""
    lost, up, down = (np.concatenate(([0], np.cumsum(hit))) for hit in (np.isnan(series), series == np.inf, series == -np.inf))
    low, high = (start + end) // 2, (start + end + 1) // 2     # a place in the middle, of weight 0, lies between them
    rising = up[end] - up[high] + down[low] - down[start]
    falling = down[end] - down[high] + up[low] - up[start]
    undefined = lost[end] - lost[start] + up[high] - up[low] + down[high] - down[low]
    slope = np.where(rising > 0, np.inf, np.where(falling > 0, -np.inf, slope))
    return np.where((undefined > 0) | ((rising > 0) & (falling > 0)), np.nan, slope)
