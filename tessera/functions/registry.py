"""Scalar functions of the expression language, all as built-in Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import collections_, ranges, temporal, text, trees, trigrams, vectors

FUNCTIONS: dict[str, Callable[..., Column]] = {}


def register(name: str, function: Callable[..., Column]) -> None:
    """A custom expression: name becomes callable in queries."""
    FUNCTIONS[name] = function


def _either(a: Column, b: Column) -> Column:
    """The first unless it is null."""
    return F.when(a.isNull(), b).otherwise(a)


def _uuid_v7() -> Column:
    """Milliseconds of the statement's time, then random bits: later statements' ids sort behind."""
    time = F.lpad(F.lower(F.hex(F.unix_millis(F.current_timestamp()))), 12, "0")
    random = F.uuid()
    return F.concat(F.substring(time, 1, 8), F.lit("-"), F.substring(time, 9, 4), F.lit("-7"), F.substring(random, 16, 3), F.lit("-"), F.substring(random, 20, 17))


FUNCTIONS.update(
    {
        "uuid_v7": _uuid_v7,
        "idiv": lambda a, b: F.call_function("div", a, b),
        "eq": lambda a, b: a == b,
        "ne": lambda a, b: a != b,
        "lt": lambda a, b: a < b,
        "le": lambda a, b: a <= b,
        "gt": lambda a, b: a > b,
        "ge": lambda a, b: a >= b,
        "and": lambda a, b: a & b,
        "or": lambda a, b: a | b,
        "not": lambda a: ~a,
        "is_nil": lambda a: a.isNull(),
        "add": lambda a, b: a + b,
        "sub": lambda a, b: a - b,
        "mul": lambda a, b: a * b,
        "div": lambda a, b: a / b,
        "rem": lambda a, b: a % b,
        "neg": lambda a: -a,
        "round": lambda a, places=0: F.round(a, places),
        "type": lambda a, to: a.cast(to),
        "coalesce": lambda *a: F.coalesce(*a),
        "or_else": _either,
        "and_then": lambda a, b: F.when(a.isNotNull(), b),
        "truthy_or": lambda a, b: F.coalesce(F.nullif(a, F.lit(False)), b),
        "error": lambda message: F.raise_error(message),
        "required": lambda a, name="value": F.coalesce(a, F.raise_error(F.lit(f"{name} is required"))),
        "now": lambda: F.current_timestamp(),
        "today": lambda: F.current_date(),
        "uuid": lambda: F.uuid(),
    }
)


for module in (text, collections_, temporal, ranges, trigrams, vectors, trees):
    FUNCTIONS.update(module.FUNCTIONS)
