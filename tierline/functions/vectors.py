"""Distances between dense vectors stored as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_l2(a: Column, b: Column) -> Column:
    """Squared Euclidean distance, added up from the first element to the last in doubles.

    Vectors of different lengths give NULL.
    """
    difference = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(difference, F.lit(0.0), lambda total, d: total + d * d)
