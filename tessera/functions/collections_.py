"""Lists and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def get_path(value: Column, key) -> Column:
    """A field of a struct or map, or a list's element."""
    return F.get(value, F.lit(key)) if isinstance(key, int) else value[key]


def intersects(a: Column, b: Column, of: str | None = None) -> Column:
    """Whether two lists share an element. of: the type that both are brought to, where theirs differ."""
    return F.arrays_overlap(a.cast(f"array<{of}>"), b.cast(f"array<{of}>")) if of else F.arrays_overlap(a, b)


FUNCTIONS = {
    "at": lambda a, i: F.get(a, i),
    "length": lambda a: F.size(a),
    "count_nils": lambda a: F.size(F.filter(a, lambda x: x.isNull())),
    "intersects": intersects,
    "has": lambda a, x: F.array_contains(a, x),
    "list": lambda *a: F.array(*a),
    "get_path": get_path,
    "json_path": lambda a, path="$", to="string": F.get_json_object(a, path).cast(to),
    "json_list_has": lambda a, x, path="$", of="string": F.array_contains(F.from_json(F.get_json_object(a, path), f"array<{of}>"), x),
}
