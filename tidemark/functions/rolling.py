"""Window-frame expressions that are NULL until the frame is full."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.numeric import ratio


def _full(value: Column, counted: Column, w: WindowSpec, n: int) -> Column:
    frame = w.rowsBetween(1 - n, 0)
    return F.when(F.count(counted).over(frame) == n, value.over(frame))


def rolling_mean(c: Column, w: WindowSpec, n: int) -> Column:
    return _full(F.avg(c), c, w, n)


def rolling_std(c: Column, w: WindowSpec, n: int) -> Column:
    """Sample standard deviation (n - 1 in the denominator)."""
    return _full(F.stddev_samp(c), c, w, n)


def diff(c: Column, w: WindowSpec, k: int = 1) -> Column:
    return c - F.lag(c, k).over(w)


def pct_change(c: Column, w: WindowSpec, k: int = 1) -> Column:
    return ratio(c, F.lag(c, k).over(w)) - 1


def returns(c: Column, w: WindowSpec) -> Column:
    previous = F.lag(c, 1).over(w)
    return ratio(c - previous, previous)
