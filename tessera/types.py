"""Logical types and what they are in Spark."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.errors import PlanError

SPARK = {
    "integer": "bigint", "string": "string", "ci_string": "string collate UTF8_LCASE", "uuid": "string", "boolean": "boolean",
    "float": "double", "decimal": "decimal(38,18)", "atom": "string", "date": "date", "naive_datetime": "timestamp_ntz",
    "datetime": "timestamp", "duration": "interval", "binary": "binary", "vector": "array<float>", "ltree": "array<string>",
}


def spark_type(logical: str) -> str:
    """The Spark type of a logical one; array<...> and decimal(p,s) too."""
    if logical.startswith("array<"):
        return f"array<{spark_type(logical[6:-1])}>"
    if logical.startswith("decimal("):
        return logical
    if logical not in SPARK:
        raise PlanError(f"no type {logical}")
    return SPARK[logical]


def enum_to_storage(value: Column, codes: Mapping[str, int]) -> Column:
    """An enumeration's name as the integer that is stored; null for others."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in codes.items() for x in kv]), value)


def enum_from_storage(value: Column, codes: Mapping[str, int]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for k, v in codes.items() for x in (v, k)]), value)
