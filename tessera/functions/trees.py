"""Label paths as arrays of segments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_ancestor(a: Column, b: Column) -> Column:
    """a is b or one of its ancestors."""
    return (F.size(a) <= F.size(b)) & (F.slice(b, F.lit(1), F.size(a)) == a)


def shared_root(a: Column, b: Column) -> Column:
    """The longest common beginning."""
    least = F.least(F.size(a), F.size(b))
    differ = F.filter(F.sequence(F.lit(0), least), lambda i: (i == least) | (F.get(a, i) != F.get(b, i)))
    return F.slice(a, F.lit(1), F.array_min(differ))


def escape(segment: Column) -> Column:
    """Letters, digits and no others: other characters become _xx of their bytes in hex."""
    chars = F.filter(F.split(segment, ""), lambda c: c != "")
    return F.array_join(F.transform(chars, lambda c: F.when(c.rlike("^[A-Za-z0-9]$"), c).otherwise(F.concat(F.lit("_"), F.hex(c.cast("binary")), F.lit("_")))), "")


def unescape(segment: Column) -> Column:
    parts = F.split(segment, "_", -1)
    return F.array_join(
        F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.unhex(p).cast("string")).otherwise(p)), ""
    )


FUNCTIONS = {
    "path_is_ancestor": is_ancestor,
    "path_levels": lambda a: F.size(a),
    "path_shared_root": shared_root,
    "path_escape": escape,
    "path_unescape": unescape,
}
