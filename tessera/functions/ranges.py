"""Ranges as structs: lower and upper bound (null: unbounded), which of them belong, and emptiness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make(lower: Column, upper: Column, lower_inc: bool = True, upper_inc: bool = False, discrete: bool = False) -> Column:
    """A range. Discrete ones (integers, dates) are brought to the form [lower, upper)."""
    low_in, up_in = F.lit(lower_inc), F.lit(upper_inc)
    if discrete:
        lower = lower if lower_inc else lower + 1
        upper = upper + 1 if upper_inc else upper
        low_in, up_in = F.lit(True), F.lit(False)
    empty = F.coalesce((lower > upper) | ((lower == upper) & ~(low_in & up_in)), F.lit(False))
    return F.struct(lower.alias("lower"), upper.alias("upper"), low_in.alias("lower_inc"), up_in.alias("upper_inc"), empty.alias("empty"))


def _ends_before(a: Column, b: Column) -> Column:
    """Every point of a is before every point of b."""
    touch = (a["upper"] == b["lower"]) & ~(a["upper_inc"] & b["lower_inc"])
    return F.coalesce((a["upper"] < b["lower"]) | touch, F.lit(False))


def overlaps(a: Column, b: Column) -> Column:
    return ~a["empty"] & ~b["empty"] & ~_ends_before(a, b) & ~_ends_before(b, a)


def contains_point(r: Column, x: Column) -> Column:
    low = F.coalesce((x > r["lower"]) | (r["lower_inc"] & (x == r["lower"])), F.lit(True))
    up = F.coalesce((x < r["upper"]) | (r["upper_inc"] & (x == r["upper"])), F.lit(True))
    return F.when(x.isNotNull(), ~r["empty"] & low & up)


def contains_range(a: Column, b: Column) -> Column:
    low = a["lower"].isNull() | F.coalesce((a["lower"] < b["lower"]) | ((a["lower"] == b["lower"]) & (a["lower_inc"] | ~b["lower_inc"])), F.lit(False))
    up = a["upper"].isNull() | F.coalesce((a["upper"] > b["upper"]) | ((a["upper"] == b["upper"]) & (a["upper_inc"] | ~b["upper_inc"])), F.lit(False))
    return b["empty"] | (~a["empty"] & low & up)


def adjacent(a: Column, b: Column) -> Column:
    meets = lambda x, y: F.coalesce((x["upper"] == y["lower"]) & (x["upper_inc"] != y["lower_inc"]), F.lit(False))
    return ~a["empty"] & ~b["empty"] & (meets(a, b) | meets(b, a))


def sort_key(r: Column) -> Column:
    """A struct in the order of ranges: empty ones, then by lower bound, unbounded first, then by upper
    bound, unbounded last; of equal bounds the one that begins earlier or ends later counts as such."""
    return F.when(r.isNotNull(), F.struct(
        (~r["empty"]).alias("a"), F.when(~r["empty"], r["lower"]).alias("b"), F.when(~r["empty"], ~r["lower_inc"]).alias("c"),
        F.when(~r["empty"], r["upper"].isNull()).alias("d"), F.when(~r["empty"], r["upper"]).alias("e"), F.when(~r["empty"], r["upper_inc"]).alias("f"),
    ))


FUNCTIONS = {
    "range_sort_key": sort_key,
    "range": make,
    "range_overlaps": overlaps,
    "range_contains": contains_point,
    "range_contains_range": contains_range,
    "range_adjacent": adjacent,
    "range_lower": lambda r: r["lower"],
    "range_upper": lambda r: r["upper"],
}
