"""Keyset pagination."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def after(order: list[tuple[Column, str]], values: tuple) -> Column:
    """Rows behind the given values, key by key, each with its direction and null placement."""
    out, equal = F.lit(False), F.lit(True)
    for (column, way), value in zip(order, values, strict=True):
        nulls_last = way in ("asc", "asc_nils_last", "desc_nils_last")
        if value is None:
            behind = F.lit(False) if nulls_last else column.isNotNull()
            same = column.isNull()
        else:
            behind = column > F.lit(value) if way.startswith("asc") else column < F.lit(value)
            behind = F.coalesce(behind, F.lit(nulls_last))
            same = F.coalesce(column == F.lit(value), F.lit(False))
        out, equal = out | (equal & behind), equal & same
    return out
