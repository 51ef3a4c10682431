"""The expression language: immutable nodes that a query compiles to Columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any


class Expr:
    """Operators build nodes; nothing is evaluated here."""

    def __eq__(self, other):  # type: ignore[override]
        return Call("eq", (self, wrap(other)))

    def __ne__(self, other):  # type: ignore[override]
        return Call("ne", (self, wrap(other)))

    def __lt__(self, other):
        return Call("lt", (self, wrap(other)))

    def __le__(self, other):
        return Call("le", (self, wrap(other)))

    def __gt__(self, other):
        return Call("gt", (self, wrap(other)))

    def __ge__(self, other):
        return Call("ge", (self, wrap(other)))

    def __and__(self, other):
        return Call("and", (self, wrap(other)))

    def __or__(self, other):
        return Call("or", (self, wrap(other)))

    def __invert__(self):
        return Call("not", (self,))

    def __add__(self, other):
        return Call("add", (self, wrap(other)))

    def __radd__(self, other):
        return Call("add", (wrap(other), self))

    def __sub__(self, other):
        return Call("sub", (self, wrap(other)))

    def __rsub__(self, other):
        return Call("sub", (wrap(other), self))

    def __mul__(self, other):
        return Call("mul", (self, wrap(other)))

    def __rmul__(self, other):
        return Call("mul", (wrap(other), self))

    def __truediv__(self, other):
        return Call("div", (self, wrap(other)))

    def __mod__(self, other):
        return Call("rem", (self, wrap(other)))

    def __neg__(self):
        return Call("neg", (self,))

    def __getitem__(self, key):
        return Call("get_path", (self,), (("key", key),))

    def is_nil(self):
        return Call("is_nil", (self,))

    def in_(self, values):
        return In(self, values if isinstance(values, Expr) else tuple(values))

    __hash__ = object.__hash__


@dataclass(frozen=True, eq=False)
class Lit(Expr):
    value: Any


@dataclass(frozen=True, eq=False)
class Ref(Expr):
    """An attribute, calculation or aggregate, possibly over relationships."""

    path: tuple[str, ...]
    name: str
    args: tuple = ()


@dataclass(frozen=True, eq=False)
class Parent(Expr):
    """An expression of the row that an exists, aggregate or relationship filter belongs to."""

    inner: Expr


@dataclass(frozen=True, eq=False)
class Call(Expr):
    name: str
    args: tuple = ()
    options: tuple = ()


@dataclass(frozen=True, eq=False)
class In(Expr):
    value: Expr
    choices: Any


@dataclass(frozen=True, eq=False)
class Exists(Expr):
    """Whether a related row, or with ``resource`` any row of it, matches. at: the relative whose
    related rows they are; it is the one that references over the same path mean."""

    path: tuple[str, ...]
    where: Expr | None = None
    resource: str | None = None
    at: tuple[str, ...] = ()


@dataclass(frozen=True, eq=False)
class Agg(Expr):
    """An aggregate over related rows, or with ``resource`` over any rows of it; read_action: of those
    rows only the ones that this action of their resource shows; then: a function of a list, an empty one
    too, computed once for each group of related rows, not for each row that the group is joined to."""

    kind: str
    path: tuple[str, ...] = ()
    field: Expr | None = None
    where: Expr | None = None
    sort: tuple = ()
    uniq: bool = False
    include_nil: bool = False
    default: Any = None
    resource: str | None = None
    join_filters: tuple = ()
    custom: Callable | None = None
    read_action: str | None = None
    then: Callable | None = None


@dataclass(frozen=True, eq=False)
class Template(Expr):
    """A value that is known when the query is planned: of the actor, the context, an argument or the tenant."""

    kind: str
    key: str | None = None


@dataclass(frozen=True, eq=False)
class Fragment(Expr):
    """Raw SQL; ? stands for an argument, \\? for a question mark."""

    sql: str
    args: tuple = ()


@dataclass(frozen=True, eq=False)
class Lazy(Expr):
    """A function that is called once, at planning."""

    thunk: Callable


@dataclass(frozen=True, eq=False)
class Case(Expr):
    """The first branch whose condition holds."""

    branches: tuple = ()
    otherwise: Expr = field(default_factory=lambda: Lit(None))


@dataclass(frozen=True, eq=False)
class MapOf(Expr):
    """A map literal: a struct."""

    fields: tuple = ()


def wrap(value) -> Expr:
    return value if isinstance(value, Expr) else Lit(value)


def ref(name: str, **args) -> Ref:
    *path, last = name.split(".")
    return Ref(tuple(path), last, tuple(sorted(args.items())))


def parent(value) -> Parent:
    return Parent(ref(value) if isinstance(value, str) else value)


def exists(path: str, where: Expr | None = None, at: str = "") -> Exists:
    return Exists(tuple(path.split(".")), where, at=tuple(at.split(".")) if at else ())


def exists_any(resource: str, where: Expr | None = None) -> Exists:
    return Exists((), where, resource)


def call(name: str, /, *args, **options) -> Call:
    return Call(name, tuple(map(wrap, args)), tuple(options.items()))


def agg(kind: str, path: str = "", of=None, **options) -> Agg:
    """kind: count, sum, avg, min, max, first, list, exists or custom."""
    of = ref(of) if isinstance(of, str) else of
    return Agg(kind, tuple(path.split(".")) if path else (), of, **options)


def fragment(sql: str, *args) -> Fragment:
    return Fragment(sql, tuple(map(wrap, args)))


def cond(*branches, otherwise=None) -> Case:
    return Case(tuple((wrap(c), wrap(v)) for c, v in branches), wrap(otherwise))


def if_(condition, then, otherwise=None) -> Case:
    return cond((condition, then), otherwise=otherwise)


def map_of(**fields) -> MapOf:
    return MapOf(tuple((k, wrap(v)) for k, v in fields.items()))


def actor(key: str) -> Template:
    return Template("actor", key)


def context(key: str) -> Template:
    return Template("context", key)


def arg(key: str) -> Template:
    return Template("arg", key)


def tenant() -> Template:
    return Template("tenant")


def children(e: Expr) -> list[Expr]:
    """Nodes of the same row scope."""
    if isinstance(e, Call):
        return list(e.args)
    if isinstance(e, In):
        return [e.value] + ([e.choices] if isinstance(e.choices, Expr) else [])
    if isinstance(e, Fragment):
        return list(e.args)
    if isinstance(e, Case):
        return [x for b in e.branches for x in b] + [e.otherwise]
    if isinstance(e, MapOf):
        return [v for _, v in e.fields]
    return []


def rebuild(e: Expr, f: Callable[[Expr], Expr]) -> Expr:
    """The node with f applied to its children."""
    if isinstance(e, Call):
        return Call(e.name, tuple(map(f, e.args)), e.options)
    if isinstance(e, In):
        return In(f(e.value), f(e.choices) if isinstance(e.choices, Expr) else e.choices)
    if isinstance(e, Fragment):
        return Fragment(e.sql, tuple(map(f, e.args)))
    if isinstance(e, Case):
        return Case(tuple((f(c), f(v)) for c, v in e.branches), f(e.otherwise))
    if isinstance(e, MapOf):
        return MapOf(tuple((k, f(v)) for k, v in e.fields))
    return e


def conjuncts(e: Expr | None) -> list[Expr]:
    if e is None:
        return []
    if isinstance(e, Call) and e.name == "and":
        return conjuncts(e.args[0]) + conjuncts(e.args[1])
    return [e]


def all_of(parts: list[Expr]) -> Expr | None:
    out = None
    for p in parts:
        out = p if out is None else Call("and", (out, p))
    return out


#: Functions without a value where an argument has none.
STRICT = {
    "eq", "ne", "lt", "le", "gt", "ge", "add", "sub", "mul", "div", "idiv", "rem", "neg", "round", "like", "ilike", "contains",
    "starts_with", "ends_with", "string_length", "string_trim", "type",
}


def without(e: Expr, path: tuple[str, ...]) -> Expr:
    """The expression where no row is at the path."""
    if isinstance(e, Ref):
        return Lit(None) if e.path[: len(path)] == path else e
    if isinstance(e, Exists) and e.at[: len(path)] == path:
        return Lit(False)
    return rebuild(e, lambda x: without(x, path))


def needs_row(e: Expr, path: tuple[str, ...]) -> bool:
    """Whether the condition can't be true where no row is at the path."""
    if isinstance(e, Ref):
        return e.path[: len(path)] == path
    if isinstance(e, Exists):
        return bool(e.at) and e.at[: len(path)] == path
    if isinstance(e, In):
        return needs_row(e.value, path)
    if isinstance(e, Call) and e.name == "or":
        return all(needs_row(a, path) for a in e.args)
    if isinstance(e, Call) and e.name == "not":
        inner = e.args[0]
        return (isinstance(inner, In) or (isinstance(inner, Call) and inner.name in STRICT)) and needs_row(inner, path)
    if isinstance(e, Call) and (e.name == "and" or e.name in STRICT):
        return any(needs_row(a, path) for a in e.args)
    return False


def outer_level(e: Expr | None) -> int:
    """How many scopes out an expression reaches: 0 for its own row only."""
    if e is None:
        return 0
    if isinstance(e, Parent):
        return 1 + outer_level(e.inner)
    if isinstance(e, Exists | Agg):
        inner = [outer_level(e.where) - 1]
        if isinstance(e, Agg):
            inner.append(outer_level(e.field) - 1)
        return max(0, *inner)
    return max([0, *map(outer_level, children(e))])
