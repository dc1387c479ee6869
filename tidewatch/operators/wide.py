"""Statistics of wide row windows in time that does not grow with the window.

A sliding frame is worked through anew for every row, so a window of a million rows costs a million steps a row. Here
windows are put together from windows whose width doubles: extremes from two of them, one at each end, moments from one for
each binary digit of the width. Moments are joined and never subtracted, so large values outside a window leave no trace
in it. Counts are differences of running counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidewatch.operators.ordered import Frame

#: Windows of more rows are done this way.
WIDE = 128


def wide_count(frame: Frame, flag: Column, windows: Sequence[int]) -> dict[int, Column]:
    """Sums of whole numbers over the last ``w`` rows, 0 where there are none."""
    so_far = frame.at(0, F.sum(flag.cast("long")).over(_so_far(frame)))
    return {w: F.coalesce(so_far, F.lit(0)) - F.coalesce(frame.at(1, F.lag(so_far, w).over(frame.order)), F.lit(0)) for w in windows}


def wide_extremes(frame: Frame, col: Column, windows: Sequence[int]) -> dict[int, tuple[Column, Column]]:
    """Minimum and maximum over the last ``w`` rows, missing where there are no values."""
    low = high = col
    width, level, out = 1, 0, {}
    for w in sorted(set(windows)):
        while 2 * width <= w:
            below, above = F.lag(low, width).over(frame.order), F.lag(high, width).over(frame.order)
            low, high = frame.at(level, F.least(low, below)), frame.at(level, F.greatest(high, above))
            width, level = 2 * width, level + 1
        rest = w - width
        below, above = F.lag(low, rest).over(frame.order), F.lag(high, rest).over(frame.order)
        out[w] = (frame.at(level, F.least(low, below)), frame.at(level, F.greatest(high, above))) if rest else (low, high)
    return out


class _Moments:
    """Number, mean and sum of squared distances of some rows, as shared columns of a level."""

    def __init__(self, level: int, n: Column, mean: Column, second: Column):
        self.level, self.n, self.mean, self.second = level, n, mean, second

    def joined(self, frame: Frame, other: _Moments, back: int) -> _Moments:
        """With the rows that ``other`` counts ``back`` rows earlier. Nothing is subtracted that nearly cancels."""
        level = max(self.level, other.level) + 1
        lagged = [frame.at(level, F.lag(c, back).over(frame.order)) for c in (other.n, other.mean, other.second)]
        n_b, mean_b, second_b = F.coalesce(lagged[0], F.lit(0)), lagged[1], F.coalesce(lagged[2], F.lit(0.0))
        n, apart = self.n + n_b, mean_b - self.mean
        both = (self.n > 0) & (n_b > 0)
        mean = F.when(both, self.mean + apart * F.try_divide(n_b, n)).otherwise(F.coalesce(self.mean, mean_b))
        second = F.coalesce(self.second, F.lit(0.0)) + second_b
        second = F.when(both, second + apart * apart * F.try_divide(self.n * n_b, n)).otherwise(second)
        level += 1
        return _Moments(level, frame.at(level, n), frame.at(level, mean), frame.at(level, second))


def wide_moments(
    frame: Frame, col: Column, windows: Sequence[int], extremes: dict[int, tuple[Column, Column]]
) -> dict[int, tuple[Column, Column, Column]]:
    """(number of values, mean, sample standard deviation) over the last ``w`` rows.

    The mean of a window with infinities of one sign is that infinity; with both it is missing, as is every deviation then.
    """
    x = col.cast("double")
    inf = F.lit(float("inf"))
    finite = F.when(F.abs(x) < inf, x)
    up, down = wide_count(frame, (x == inf).cast("int"), windows), wide_count(frame, (x == -inf).cast("int"), windows)
    one = _Moments(0, *(frame.at(0, c) for c in (F.when(finite.isNotNull(), 1).otherwise(0), finite, F.lit(0.0))))
    powers = [one]
    out = {}
    for w in windows:
        while 2 << len(powers) - 1 <= w:
            powers.append(powers[-1].joined(frame, powers[-1], 1 << len(powers) - 1))
        bits = [k for k in reversed(range(w.bit_length())) if w >> k & 1]
        whole, covered = powers[bits[0]], 1 << bits[0]
        for k in bits[1:]:
            whole, covered = whole.joined(frame, powers[k], covered), covered + (1 << k)
        n, low, high = whole.n, *extremes[w]
        mean = F.when((up[w] > 0) & (down[w] > 0), None).when(up[w] > 0, inf).when(down[w] > 0, -inf)
        std = F.when((up[w] > 0) | (down[w] > 0) | (n < 2), None).when(low == high, 0.0)
        std = std.otherwise(F.sqrt(F.try_divide(whole.second, n - 1)))
        out[w] = (n + up[w] + down[w], mean.otherwise(whole.mean), std)
    return out


def _so_far(frame: Frame):  # noqa: ANN202
    return frame.order.rowsBetween(Window.unboundedPreceding, 0)
