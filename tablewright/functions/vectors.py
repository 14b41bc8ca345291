"""Distances between array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_l2(a: Column, b: Column) -> Column:
    """Sum of squared differences, in double precision and in element order."""
    squares = F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), 2))
    return F.aggregate(squares, F.lit(0.0), lambda total, part: total + part)


def confidence(distance: Column) -> Column:
    """1 for an exact hit, falling towards 0 with distance."""
    return F.lit(1.0) / (F.lit(1.0) + distance)
