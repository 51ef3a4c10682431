"""Strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def position(value: Column, part: Column) -> Column:
    """Zero-based place of the first match; null where there is none."""
    return F.nullif(F.instr(value, part), F.lit(0)) - 1


def split(value: Column, separator: str = " ", trim: bool = False) -> Column:
    """Parts between separators. trim drops empty ones at the two ends, not inside."""
    import re

    parts = F.split(value, re.escape(separator), -1)
    if not trim:
        return parts
    full = F.transform(F.filter(F.transform(parts, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda s: s["x"] != ""), lambda s: s["i"])
    return F.when(F.size(full) == 0, F.array().cast("array<string>")).otherwise(
        F.slice(parts, F.array_min(full) + 1, F.array_max(full) - F.array_min(full) + 1)
    )


def tokens(value: Column) -> Column:
    """Distinct lower-cased words."""
    return F.array_distinct(F.filter(F.split(F.lower(value), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def text_match(value: Column, query: str = "") -> Column:
    """Whether the words of a text meet a query of words with &, |, ! and parentheses. No ranking."""
    import re

    have = tokens(value)
    parts = re.findall(r"[&|!()]|[^\s&|!()]+", query.lower())

    def either(at: int) -> tuple[Column, int]:
        left, at = both(at)
        while at < len(parts) and parts[at] == "|":
            right, at = both(at + 1)
            left = left | right
        return left, at

    def both(at: int) -> tuple[Column, int]:
        left, at = one(at)
        while at < len(parts) and parts[at] == "&":
            right, at = one(at + 1)
            left = left & right
        return left, at

    def one(at: int) -> tuple[Column, int]:
        if at >= len(parts) or parts[at] in "&|)":
            raise ValueError(f"{query!r} is no text query")
        if parts[at] == "!":
            inner, at = one(at + 1)
            return ~inner, at
        if parts[at] == "(":
            inner, at = either(at + 1)
            if at >= len(parts) or parts[at] != ")":
                raise ValueError(f"{query!r} lacks a parenthesis")
            return inner, at + 1
        return F.array_contains(have, parts[at]), at + 1

    found, end = either(0)
    if end != len(parts):
        raise ValueError(f"{query!r} is no text query")
    return found


FUNCTIONS = {
    "text_tokens": tokens,
    "text_match": text_match,
    "contains": lambda a, b: a.contains(b),
    "starts_with": lambda a, b: F.startswith(a, b),
    "ends_with": lambda a, b: F.endswith(a, b),
    "like": lambda a, b: F.like(a, b),
    "ilike": lambda a, b: F.ilike(a, b),
    "string_position": position,
    "string_length": lambda a: F.length(a),
    "string_trim": lambda a: F.trim(a),
    "trim_whitespace": lambda a: F.btrim(a, F.lit(" \t\n\x0b\x0c\r")),
    "string_downcase": lambda a: F.lower(a),
    "string_upcase": lambda a: F.upper(a),
    "string_join": lambda *a, sep="": F.concat_ws(sep, *a),
    "string_split": split,
    "concat": lambda *a: F.concat(*a),
    "ci": lambda a: F.collate(a, "UTF8_LCASE"),
}
