"""Resources from what a table's schema says."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.schema import Attribute, Relationship, Resource

_TYPES = {
    T.LongType: "integer", T.IntegerType: "integer", T.ShortType: "integer", T.StringType: "string", T.BooleanType: "boolean",
    T.DoubleType: "float", T.FloatType: "float", T.DateType: "date", T.TimestampType: "datetime", T.TimestampNTZType: "naive_datetime",
    T.BinaryType: "binary", T.StructType: "map", T.MapType: "map", T.VariantType: "map",
}
#: What a column's name holds if its content is personal or secret.
SENSITIVE = (
    "password", "passwd", "pass", "pwd", "hash", "auth", "token", "secret", "api_key", "ssn", "social", "creditcard", "credit_card", "cc",
    "passport", "driverlicense", "driver_license", "driverlicence", "driver_licence", "national_id", "account", "routing", "iban", "swift",
    "tax_id", "phone", "email", "address", "medical", "health", "diagnosis", "treatment", "fingerprint", "retina_scan", "face_id", "dna",
    "encrypt", "encoded", "cipher", "private", "confidential", "restricted", "sensitive", "_salt", "_secret", "_key", "_token",
)
#: Those that count only as a whole word.
SENSITIVE_WORDS = ("otp", "pin", "salt")


def logical_type(kind: T.DataType) -> str:
    if isinstance(kind, T.ArrayType):
        return f"array<{logical_type(kind.elementType)}>"
    if isinstance(kind, T.DecimalType):
        return f"decimal({kind.precision},{kind.scale})"
    return _TYPES.get(type(kind), "term")


def sensitive(name: str) -> bool:
    """Whether a column's name suggests personal or secret content: any occurrence counts, so that nothing of
    the kind is selected by default; a false alarm only has to be named in a query."""
    words = re.split(r"[^a-z0-9]+", name.lower())
    return any(part in name.lower() for part in SENSITIVE) or any(w in SENSITIVE_WORDS for w in words)


def infer(name: str, table: str, df: DataFrame, primary_key: tuple[str, ...] = (), foreign_keys: dict[str, tuple[str, str]] | None = None) -> Resource:
    """A resource of a table. foreign_keys: attribute -> (resource, its attribute). Sensitive columns
    aren't selected by default."""
    attributes = tuple(
        Attribute(f.name, logical_type(f.dataType), primary_key=f.name in primary_key, allow_nil=f.nullable and f.name not in primary_key, select=not sensitive(f.name))
        for f in df.schema.fields
    )
    links = tuple(
        Relationship(re.sub(r"_(id|key)$", "", a), "belongs_to", to, a, key) for a, (to, key) in (foreign_keys or {}).items()
    )
    return Resource(name, attributes, table=table, relationships=links)


def with_reverse(resources: list[Resource]) -> list[Resource]:
    """Adds has_many for each belongs_to, and many_to_many through tables of two foreign keys."""
    from dataclasses import replace

    extra: dict[str, list[Relationship]] = {r.name: [] for r in resources}
    for r in resources:
        links = [x for x in r.relationships if x.kind == "belongs_to"]
        for x in links:
            if x.destination in extra:
                extra[x.destination].append(Relationship(f"{r.name}s", "has_many", r.name, x.destination_attribute, x.source_attribute))
        if len(links) == 2 and set(r.primary_key) == {x.source_attribute for x in links}:
            for x, y in (links, links[::-1]):
                extra[x.destination].append(
                    Relationship(f"{y.destination}s", "many_to_many", y.destination, x.destination_attribute, y.destination_attribute,
                                 through=(r.name, x.source_attribute, y.source_attribute))
                )
    out = []
    for r in resources:
        have = {x.name for x in r.relationships}
        out.append(replace(r, relationships=r.relationships + tuple(x for x in extra[r.name] if x.name not in have), _index={}))
    return out


def diff(old: T.StructType, new: T.StructType) -> list[tuple]:
    """The operations that turn one table's columns into another's: add, alter, remove."""
    before, after = {f.name: f for f in old.fields}, {f.name: f for f in new.fields}
    out: list[tuple] = [("add", n, f.dataType.simpleString()) for n, f in after.items() if n not in before]
    out += [("alter", n, before[n].dataType.simpleString(), f.dataType.simpleString()) for n, f in after.items() if n in before and before[n].dataType != f.dataType]
    return out + [("remove", n) for n in before if n not in after]
