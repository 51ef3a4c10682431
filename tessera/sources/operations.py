"""From one declaration of resources to the next: operations in an order that holds, and back.

Every operation says which facts it provides and which it requires, like ("table", t) or
("column", t, c), so that the order follows from a topological sort: a key is dropped before its column
goes and made after its column is there, whatever the order of declaration.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.errors import PlanError
from tessera.schema import Attribute, Domain, Resource

#: Operation kinds and their inverses; the others are their own.
_INVERSE = {
    "create_table": "drop_table", "add_column": "remove_column", "add_primary_key": "remove_primary_key", "add_unique": "remove_unique",
    "add_check": "remove_check", "add_reference": "remove_reference", "add_exclusion": "remove_exclusion",
}
_INVERSE |= {v: k for k, v in _INVERSE.items()}


@dataclass(frozen=True)
class Operation:
    """kind on a table's part of that name. before, after: what it was and what it becomes.

    provides: facts that hold once it is done. requires: facts that must hold before, where operations of
    the same run make them.
    """

    kind: str
    table: str
    name: str = ""
    before: Any = None
    after: Any = None
    provides: frozenset = field(default=frozenset(), compare=False)
    requires: frozenset = field(default=frozenset(), compare=False)

    def inverse(self) -> Operation:
        if self.kind == "rename_table":
            return Operation(self.kind, self.after, self.after, None, self.table)
        if self.kind in ("rename_column", "rename_unique"):
            return Operation(self.kind, self.table, self.after, None, self.name)
        return Operation(_INVERSE.get(self.kind, self.kind), self.table, self.name, self.after, self.before)


def _op(kind: str, table: str, name: str = "", before=None, after=None, provides=(), requires=()) -> Operation:
    return Operation(kind, table, name, before, after, frozenset(provides), frozenset(requires))


def _column(a: Attribute) -> tuple:
    return (a.type, a.allow_nil, a.default)


def _stored(a: Attribute) -> str:
    return a.source or a.name


def _parts(r: Resource) -> dict[str, dict[str, tuple[Any, tuple[str, ...]]]]:
    """kind -> name -> (what it says, the columns that it needs)."""
    source = {a.name: _stored(a) for a in r.attributes}
    key = tuple(source[k] for k in r.primary_key)
    return {
        "primary_key": {"": (key, key)} if key else {},
        "unique": {i.name: ((i.keys, i.nils_distinct, repr(i.where)), tuple(source[k] for k in i.keys if k in source)) for i in r.identities},
        "check": {c.name: ((c.field, repr(c.condition), c.message), (source.get(c.field, c.field),)) for c in r.checks},
        "exclusion": {x.name: ((x.keys, x.range), (*x.keys, x.range)) for x in r.exclusions},
        "reference": {x.attribute: ((x.destination, x.destination_attribute, x.on_delete), (source.get(x.attribute, x.attribute),)) for x in r.references},
    }


def _added(r: Resource, kind: str, name: str, said, columns, tables: Mapping[str, str]) -> Operation:
    needs = [("column", r.table, c) for c in columns] + [("table", r.table), ("gone", kind, r.table, name)]
    if kind == "reference":
        needs += [("table", tables[said[0]]), ("column", tables[said[0]], said[1]), ("primary_key", tables[said[0]], "")]
    return _op(f"add_{kind}", r.table, name, None, said, [(kind, r.table, name)], needs)


def _removed(table: str, kind: str, name: str, said, columns) -> Operation:
    free = [("free", table, c) for c in columns] + [("free", table)]
    return _op(f"remove_{kind}", table, name, said, None, [("gone", kind, table, name), *free])


def _create(r: Resource, tables: Mapping[str, str]) -> list[Operation]:
    out = [_op("create_table", r.table, after=r.tenant_by, provides=[("table", r.table)], requires=[("gone_table", r.table)])]
    out += [_op("add_column", r.table, _stored(a), None, _column(a), [("column", r.table, _stored(a))], [("table", r.table)]) for a in r.attributes]
    return out + [_added(r, kind, n, said, columns, tables) for kind, items in _parts(r).items() for n, (said, columns) in items.items()]


def operations(old: Domain, new: Domain, renamed_tables: Mapping[str, str] | None = None, renamed_columns: Mapping[tuple[str, str], str] | None = None) -> list[Operation]:
    """What turns the tables of one domain into those of another, in an order that can be carried out.

    renamed_tables: old table -> new one. renamed_columns: (new table, old column) -> new column; without
    them a rename is a removal and an addition.
    """
    renamed_tables, renamed_columns = renamed_tables or {}, renamed_columns or {}
    before = {renamed_tables.get(r.table, r.table): r for r in old.resources if r.table}
    after = {r.table: r for r in new.resources if r.table}
    tables = {r.name: r.table for r in new.resources}
    out = [_op("rename_table", a, a, after=b, provides=[("table", b)]) for a, b in renamed_tables.items() if b in after]
    for t in after.keys() - before.keys():
        out += _create(after[t], tables)
    for t in before.keys() - after.keys():
        gone = [_removed(t, kind, n, said, columns) for kind, items in _parts(before[t]).items() for n, (said, columns) in items.items()]
        out += gone
        pointing = [("gone", "reference", r.table, x.attribute) for r in old.resources for x in r.references if old[x.destination].table == t]
        out.append(_op("drop_table", t, before=before[t].tenant_by, provides=[("gone_table", t)], requires=[("free", t), *pointing, *[p for o in gone for p in o.provides]]))
    for t in sorted(after.keys() & before.keys()):
        a, b = before[t], after[t]
        if a.tenant_by != b.tenant_by:
            out.append(_op("move_table", t, before=a.tenant_by, after=b.tenant_by, provides=[("table", t)]))
        was = {renamed_columns.get((t, _stored(x)), _stored(x)): x for x in a.attributes}
        now = {_stored(x): x for x in b.attributes}
        renamed_to = {to for (where, _), to in renamed_columns.items() if where == t}
        for (where, name), to in renamed_columns.items():
            if where == t and to in now:
                out.append(_op("rename_column", t, name, after=to, provides=[("column", t, to)], requires=[("table", t)]))
        out += [_op("add_column", t, n, None, _column(x), [("column", t, n)], [("table", t)]) for n, x in now.items() if n not in was and n not in renamed_to]
        out += [_op("alter_column", t, n, _column(was[n]), _column(x), [("altered", t, n)]) for n, x in now.items() if n in was and _column(was[n]) != _column(x)]
        out += [_op("remove_column", t, n, _column(x), None, (), [("free", t, n)]) for n, x in was.items() if n not in now]
        mine, theirs = _parts(a), _parts(b)
        for kind in theirs:
            same = {said: n for n, (said, _) in mine[kind].items()}
            for n, (said, columns) in theirs[kind].items():
                if n in mine[kind] and mine[kind][n][0] == said:
                    continue
                if kind == "unique" and n not in mine[kind] and same.get(said) not in (None, *theirs[kind]):
                    out.append(_op("rename_unique", t, same[said], after=n))
                    continue
                out.append(_added(b, kind, n, said, columns, tables))
            for n, (said, columns) in mine[kind].items():
                kept = n in theirs[kind] and theirs[kind][n][0] == said
                moved = kind == "unique" and any(o.kind == "rename_unique" and o.table == t and o.name == n for o in out)
                if not kept and not moved:
                    out.append(_removed(t, kind, n, said, columns))
    return ordered(out)


def ordered(ops: list[Operation]) -> list[Operation]:
    """Each operation after all that provide a fact that it requires; otherwise as given."""
    makers: dict[tuple, list[int]] = {}
    for k, o in enumerate(ops):
        for fact in o.provides:
            makers.setdefault(fact, []).append(k)
    graph = {k: {m for fact in o.requires for m in makers.get(fact, ()) if m != k} for k, o in enumerate(ops)}
    return [ops[k] for k in TopologicalSorter(graph).static_order()]


def down(ops: list[Operation]) -> list[Operation]:
    """What undoes the operations."""
    return [o.inverse() for o in reversed(ops)]


def migrate(rows: DataFrame, table: str, ops: list[Operation]) -> DataFrame:
    """A table's rows after the operations on its columns. What a removed column held is lost."""
    from tessera.types import spark_type

    for o in ops:
        if o.kind == "rename_table" and o.name == table:
            table = o.after
        if o.table != table:
            continue
        if o.kind == "add_column":
            value = o.after[2]
            if isinstance(value, str | int | float | bool) or value is None:
                rows = rows.withColumn(o.name, F.lit(value).cast(spark_type(o.after[0])))
            else:
                raise PlanError(f"{table}.{o.name}: its default isn't a plain value")
        elif o.kind == "alter_column" and o.before[0] != o.after[0]:
            rows = rows.withColumn(o.name, F.col(o.name).cast(spark_type(o.after[0])))
        elif o.kind == "rename_column":
            rows = rows.withColumnRenamed(o.name, o.after)
        elif o.kind == "remove_column":
            rows = rows.drop(o.name)
    return rows
