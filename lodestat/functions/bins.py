"""Bin numbers from sorted break points, as plain column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cut_index(value: Column, breaks: Sequence[float], right: bool = True) -> Column:
    """Bin number 0..len(breaks): bins are (lo, hi] if ``right`` else [lo, hi). Null stays null.

    A balanced comparison tree, so the cost per row is the logarithm of the number of bins.
    """
    points = sorted(float(b) for b in breaks)

    def below(b: float) -> Column:
        return value <= F.lit(b) if right else value < F.lit(b)

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(points[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return F.when(value.isNotNull(), tree(0, len(points)))
