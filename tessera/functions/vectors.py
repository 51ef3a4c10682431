"""Distances of vectors, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(pairs: Column) -> Column:
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x)


def _dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def cosine_distance(a: Column, b: Column) -> Column:
    """One minus the cosine; null where a vector has no length."""
    return 1 - _dot(a, b) / F.nullif(F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)), F.lit(0.0))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


FUNCTIONS = {"vector_cosine_distance": cosine_distance, "vector_l2_distance": l2_distance}
