"""Resources: declared tables with relationships, calculations and aggregates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from tessera.errors import PlanError
from tessera.expr import Agg, Expr


@dataclass(frozen=True)
class Attribute:
    """A column. source: its name in storage, if another. select: part of the default projection.
    default, update_default: a value, an expression of the row (so ``call("uuid")`` gives each row its
    own), or a function that is called once a mutation and gives either."""

    name: str
    type: str = "string"
    source: str | None = None
    primary_key: bool = False
    allow_nil: bool = True
    select: bool = True
    default: Any = None
    update_default: Any = None
    one_of: tuple | None = None


@dataclass(frozen=True)
class Relationship:
    """kind: belongs_to, has_one, has_many, many_to_many.

    through: a join resource with its two keys for many_to_many; join_relationship: the relationship
    to it whose filter, sort and limit hold first. path: relationships that are
    followed one after the other. no_attributes: only the filter relates the rows. manual: a
    function of both sides' column lookups that gives the join condition.
    """

    name: str
    kind: str
    destination: str
    source_attribute: str = "id"
    destination_attribute: str = "id"
    through: tuple[str, str, str] | None = None
    join_relationship: str | None = None
    path: tuple[str, ...] = ()
    filter: Expr | None = None
    sort: tuple = ()
    limit: int | None = None
    offset: int = 0
    from_many: bool = False
    no_attributes: bool = False
    manual: Callable | None = None

    @property
    def to_one(self) -> bool:
        return self.kind in ("belongs_to", "has_one") and not self.path


@dataclass(frozen=True)
class Calculation:
    """An expression, or a function of the argument values that gives one."""

    name: str
    expression: Expr | Callable[..., Expr]
    public: bool = True


@dataclass(frozen=True)
class Identity:
    """A unique key. where: only among such rows. nils_distinct: a null key equals no other."""

    name: str
    keys: tuple[str, ...]
    where: Expr | None = None
    nils_distinct: bool = True


@dataclass(frozen=True)
class Reference:
    """A foreign key and what happens to the rows when the row that they refer to goes."""

    attribute: str
    destination: str
    destination_attribute: str
    on_delete: str = "restrict"


@dataclass(frozen=True)
class Check:
    name: str
    field: str
    condition: Expr
    message: str = "is invalid"


@dataclass(frozen=True)
class Exclusion:
    """No two rows with equal keys have ranges that overlap. Rows without a key or range don't count."""

    name: str
    keys: tuple[str, ...]
    range: str
    message: str = "conflicts with an existing row"


@dataclass(frozen=True)
class Resource:
    """repo: where reads come from; mutate_repo: where mutations take the table from, if elsewhere.
    read_actions: named filters that aggregates can read through. read_policy and write_policy: what rows must meet to be seen, and to be created or changed."""

    name: str
    attributes: tuple[Attribute, ...]
    table: str | None = None
    repo: str = "default"
    relationships: tuple[Relationship, ...] = ()
    calculations: tuple[Calculation, ...] = ()
    aggregates: tuple[tuple[str, Agg], ...] = ()
    identities: tuple[Identity, ...] = ()
    references: tuple[Reference, ...] = ()
    checks: tuple[Check, ...] = ()
    exclusions: tuple[Exclusion, ...] = ()
    base_filter: Expr | None = None
    read_policy: Expr | None = None
    read_actions: tuple[tuple[str, Expr], ...] = ()
    write_policy: Expr | None = None
    mutate_repo: str | None = None
    tenant_attribute: str | None = None
    tenant_by: str | None = None
    polymorphic: bool = False
    _index: dict = field(default_factory=dict, compare=False, repr=False)

    def __post_init__(self):
        names = [a.name for a in self.attributes] + [c.name for c in self.calculations] + [n for n, _ in self.aggregates]
        twice = {n for n in names if names.count(n) > 1}
        if twice:
            raise PlanError(f"{self.name}: {sorted(twice)} are declared twice")
        if not self.polymorphic and not self.table:
            raise PlanError(f"{self.name}: a resource has a table unless it is polymorphic")
        for kind, items in (("rel", self.relationships), ("calc", self.calculations), ("attr", self.attributes), ("identity", self.identities)):
            self._index.update({(kind, x.name): x for x in items})
        self._index.update({("agg", n): a for n, a in self.aggregates})
        for n, a in self.aggregates:
            of = a.field
            attr = self._index.get(("attr", getattr(of, "name", None))) if not a.path else None
            if a.kind in ("first", "list") and attr is not None and attr.type.startswith("array"):
                raise PlanError(f"{self.name}.{n}: first and list aggregates can't be over arrays")

    def find(self, kind: str, name: str):
        return self._index.get((kind, name))

    @property
    def primary_key(self) -> tuple[str, ...]:
        return tuple(a.name for a in self.attributes if a.primary_key)

    def row_key(self) -> tuple[str, ...]:
        """The primary key, or the first identity over attributes."""
        key = self.primary_key
        if not key and self.identities:
            key = self.identities[0].keys
        if not key:
            raise PlanError(f"{self.name}: it has neither a primary key nor an identity")
        return key


@dataclass(frozen=True)
class Domain:
    resources: tuple[Resource, ...]

    def __getitem__(self, name: str) -> Resource:
        for r in self.resources:
            if r.name == name:
                return r
        raise PlanError(f"no resource {name}")
