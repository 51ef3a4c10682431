"""From expressions to Columns.

A Scope is a DataFrame of one resource's rows plus what expressions needed so far: joined to-one
relationships, aggregates and existence flags as further columns. Correlated pieces become
equi-joins wherever a relationship has keys: an existence check is a left semi join, an aggregate
one grouped sub-plan for each path, joined on its key.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.errors import PlanError
from tessera.expr import (
    Agg, Call, Case, Exists, Expr, Fragment, In, Lazy, Lit, MapOf, Parent, Ref, Template,
    all_of, children, conjuncts, needs_row, outer_level, rebuild, ref, without,
)
from tessera.functions.registry import FUNCTIONS
from tessera.schema import Relationship, Resource
from tessera.sources.engine import Engine

_ASC = {"asc": Column.asc_nulls_last, "desc": Column.desc_nulls_first, "asc_nils_first": Column.asc_nulls_first,
        "asc_nils_last": Column.asc_nulls_last, "desc_nils_first": Column.desc_nulls_first, "desc_nils_last": Column.desc_nulls_last}


_MIRRORED = {"eq": "eq", "lt": "gt", "le": "ge", "gt": "lt", "ge": "le"}


def sort_keys(sort) -> list[tuple[Expr, str]]:
    """("name" or expression, direction) pairs; a bare name, or one after a minus, is short for them."""
    out = []
    for s in sort:
        if isinstance(s, tuple):
            key, way = s
        elif isinstance(s, str) and s.startswith("-"):
            key, way = s[1:], "desc"
        else:
            key, way = s, "asc"
        if way not in _ASC:
            raise PlanError(f"no sort direction {way}")
        out.append((ref(key) if isinstance(key, str) else key, way))
    return out


def every(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions) if conditions else F.lit(True)


@dataclass
class Bound:
    """A comparison of a related row's value with a limit of the source's row. name: the same for equal values."""

    op: str
    name: str
    value: Column
    limit: Column


@dataclass
class Related:
    """The rows of a path's end: scope, key pairs (source column, own column), and conditions that
    need the source's columns (1) or those of a scope so many further out, as a bound where they are one."""

    scope: Scope
    keys: list[tuple[str, str]]
    conditions: list[tuple[int, Column, Bound | None]]

    def on(self) -> Column:
        return every([F.col(a) == F.col(b) for a, b in self.keys] + [c for _, c, _ in self.conditions])


class Scope:
    def __init__(self, engine: Engine, resource: Resource | None, df: DataFrame, alias: str, parent: Scope | None = None):
        self.engine, self.resource, self.df, self.alias, self.parent = engine, resource, df, alias, parent
        self.joined: dict[tuple[str, ...], tuple[Resource, str]] = {}
        self.known: dict[int, tuple[Expr, str]] = {}
        self.extra: dict[str, str] = {}

    @classmethod
    def bare(cls, engine: Engine) -> Scope:
        return cls(engine, None, engine.spark.range(1), engine.alias())

    @classmethod
    def of(cls, engine: Engine, resource: Resource, parent: Scope | None = None, policies: bool = True) -> Scope:
        alias = engine.alias()
        scope = cls(engine, resource, engine.rows(resource, alias), alias, parent)
        for always in (resource.base_filter, resource.read_policy if policies else None):
            if always is not None:
                scope.keep(always)
        return scope

    # -- names -------------------------------------------------------------------------------

    def name(self, attribute: str) -> str:
        return self.extra.get(attribute) or f"{self.alias}_{attribute}"

    def new_column(self, column: Column) -> str:
        name = f"{self.engine.alias()}_x"
        self.df = self.df.withColumn(name, column)
        return name

    def row_key(self) -> list[str]:
        return [self.name(k) for k in self.resource.row_key()]

    # -- rows --------------------------------------------------------------------------------

    def keep(self, predicate: Expr) -> None:
        """Filters the rows; conjuncts that are existence checks become semi and anti joins."""
        for part in self.parts_of(predicate):
            negated = isinstance(part, Call) and part.name == "not" and isinstance(part.args[0], Exists)
            check = part.args[0] if negated else part
            if isinstance(check, Exists):
                related = self.matching(check)
                self.df = self.df.join(related.scope.df, related.on(), "left_anti" if negated else "left_semi")
            else:
                column = self.column(part)
                self.df = self.df.filter(column)

    def parts_of(self, predicate: Expr | None) -> list[Expr]:
        """The conjuncts; those on to-many relationships are existence checks of one related row.

        Conjuncts that share a to-many hop mean the same row behind it, so they become one check, in
        which those that go on from there are checks of their own. Only where a condition could hold
        without any related row does it say so.
        """
        out: list[Expr] = []
        groups: dict[tuple[str, ...], list[tuple[tuple[str, ...], Expr]]] = {}
        for part in conjuncts(self.expand(predicate)) if predicate is not None else []:
            first, whole = self.many_path(part)
            if first:
                groups.setdefault(first, []).append((whole, part))
            else:
                out.append(part)
        for first, members in groups.items():
            paths = {whole for whole, _ in members}
            path = paths.pop() if len(paths) == 1 else first
            e = all_of([m for _, m in members])
            found: Expr = Exists(path, _moved(e, path))
            if not needs_row(e, path):
                found = Call("or", (found, Call("and", (without(e, path), Call("not", (Exists(path),))))))
            out.append(found)
        return out

    def condition(self, predicate: Expr | None) -> Column:
        return every([self.column(part) for part in self.parts_of(predicate)])

    def many_path(self, e: Expr) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """Where an expression's longest path first leads to many rows, and where it does last."""
        reach = e.path if isinstance(e, Ref) else e.at if isinstance(e, Exists) else ()
        if reach:
            at, ends = self.resource, [()]
            for k, hop in enumerate(reach):
                if hop.startswith("$"):
                    return (), ()
                rel = self.relationship(at, hop)
                if not rel.to_one:
                    ends.append(reach[: k + 1])
                at = self.engine.domain[rel.destination]
            return ends[min(1, len(ends) - 1)], ends[-1]
        if isinstance(e, Exists | Agg | Parent):
            return (), ()
        return max((self.many_path(c) for c in children(e)), key=lambda found: len(found[1]), default=((), ()))

    def names_relationship(self, e: Ref) -> bool:
        at = self.resource
        for hop in e.path:
            rel = at.find("rel", hop) if at is not None else None
            if rel is None:
                return False
            at = self.engine.domain[rel.destination]
        return at is not None and at.find("rel", e.name) is not None

    def relationship(self, resource: Resource, name: str) -> Relationship:
        rel = resource.find("rel", name)
        if rel is None:
            raise PlanError(f"{resource.name} has no relationship {name}")
        if self.engine.domain[rel.destination].repo != resource.repo:
            raise PlanError(f"{resource.name}.{name}: its destination is in another repo")
        return rel

    # -- relationships -----------------------------------------------------------------------

    def related(self, rel: Relationship, limited: bool = True) -> Related:
        """The destination's rows with the keys that tie them to this scope's rows."""
        engine = self.engine
        if rel.path:
            first, *rest = rel.path
            out = self.related(self.relationship(self.resource, first))
            for hop in rest:
                out = _chain(out, out.scope.relationship(out.scope.resource, hop))
            child, keys, conditions = out.scope, out.keys, out.conditions
        else:
            child = Scope.of(engine, engine.domain[rel.destination], self)
            keys, conditions = [], []
            if rel.manual is not None:
                conditions.append((1, rel.manual(lambda a: F.col(self.name(a)), lambda a: F.col(child.name(a))), None))
            elif rel.through:
                join_name, source_key, destination_key = rel.through
                if rel.join_relationship:
                    # the join relationship's filter, sort and limit hold for each source row
                    between = self.related(self.relationship(self.resource, rel.join_relationship)).scope
                else:
                    between = Scope.of(engine, engine.domain[join_name], self)
                child.df = child.df.join(between.df, F.col(child.name(rel.destination_attribute)) == F.col(between.name(destination_key)))
                keys = [(self.name(rel.source_attribute), between.name(source_key))]
                child.joined[("$" + join_name,)] = (between.resource, between.alias)
            elif not rel.no_attributes:
                keys = [(self.name(rel.source_attribute), child.name(rel.destination_attribute))]
        child.parent = self
        for part in conjuncts(rel.filter):
            if outer_level(part):
                conditions.append((outer_level(part), child.column(part), self.bound(child, part)))
            else:
                child.keep(part)
        out = Related(child, keys, conditions)
        if limited and (rel.limit is not None or rel.offset or rel.from_many):
            out = _top(self, out, rel.sort, rel.offset, 1 if rel.from_many else rel.limit)
        return out

    def path(self, path: tuple[str, ...]) -> Related:
        out = self.related(self.relationship(self.resource, path[0]))
        for hop in path[1:]:
            out = _chain(out, out.scope.relationship(out.scope.resource, hop))
        out.scope.parent = self
        return out

    def matching(self, check: Exists) -> Related:
        """The rows that make a check true."""
        if check.resource:
            out = Related(Scope.of(self.engine, self.engine.domain[check.resource], self), [], [])
        else:
            out = self.path(check.path)
        child = out.scope
        for part in child.parts_of(check.where):
            if isinstance(part, Exists) and outer_level(part) > 0:
                # an inner check that reaches further out: one check over a join
                inner = child.matching(part)
                near = [c for level, c, _ in inner.conditions if level < 2]
                child.df = child.df.join(inner.scope.df, every([F.col(a) == F.col(b) for a, b in inner.keys] + near))
                out.conditions += [(level - 1, c, None) for level, c, _ in inner.conditions if level > 1]
            elif outer_level(part):
                if not self.linked(out, part):
                    out.conditions.append((outer_level(part), child.column(part), None))
            else:
                child.keep(part)
        return out

    def bound(self, child: Scope, part: Expr) -> Bound | None:
        if isinstance(part, Call) and part.name in _MIRRORED:
            for op, (theirs, mine) in ((part.name, part.args), (_MIRRORED[part.name], part.args[::-1])):
                if isinstance(mine, Parent) and not outer_level(mine.inner) and not outer_level(theirs):
                    return Bound(op, repr(theirs), child.column(theirs), self.column(mine.inner))
        return None

    def linked(self, related: Related, part: Expr) -> bool:
        """Makes an equality of a related row's value and one of this scope's row a pair of keys, so that
        related rows can be grouped before they are joined."""
        if not (isinstance(part, Call) and part.name == "eq"):
            return False
        for mine, theirs in (part.args, part.args[::-1]):
            if isinstance(mine, Parent) and not outer_level(mine.inner) and not outer_level(theirs):
                column = related.scope.new_column(related.scope.column(theirs))
                related.keys = [*related.keys, (self.new_column(self.column(mine.inner)), column)]
                return True
        return False

    def to_one(self, path: tuple[str, ...]) -> tuple[Resource, str]:
        """(resource, alias) of a to-one path, joined on first use."""
        if path not in self.joined:
            source = self
            if len(path) > 1:
                resource, alias = self.to_one(path[:-1])
                source = Scope(self.engine, resource, self.df, alias, self.parent)
            rel = self.relationship(source.resource, path[-1])
            if not rel.to_one:
                raise PlanError(f"{'.'.join(path)} leads to many rows; aggregate them or use exists")
            found = source.related(rel)
            self.df = self.df.join(found.scope.df, found.on(), "left")
            self.joined[path] = (found.scope.resource, found.scope.alias)
        return self.joined[path]

    # -- expressions -------------------------------------------------------------------------

    def expand(self, e: Expr) -> Expr:
        """Calculations by their expression, templates by their value."""
        if isinstance(e, Template):
            return Lit(self.engine.template(e.kind, e.key))
        if isinstance(e, Ref) and self.resource is not None:
            resource = self.resource
            for hop in e.path:
                resource = self.engine.domain[self.relationship(resource, hop).destination] if not hop.startswith("$") else self.joined[(hop,)][0]
            calc = resource.find("calc", e.name)
            if calc is not None and not (not e.path and e.name in self.extra):
                body = calc.expression(**dict(e.args)) if callable(calc.expression) else calc.expression
                return self.expand(_under(body, e.path))
            return e
        if isinstance(e, Call) and e.name == "is_nil" and isinstance(e.args[0], Ref) and self.names_relationship(e.args[0]):
            return Call("not", (self.expand(Exists((e.args[0].name,), at=e.args[0].path)),))
        if isinstance(e, Exists) and e.at and not self.many_path(e)[0]:
            return replace(e, path=e.at + e.path, at=())  # of the one relative
        if isinstance(e, Parent | Exists | Agg):
            return e
        return rebuild(e, self.expand)

    def column(self, e: Expr) -> Column:
        e = self.expand(e)
        if isinstance(e, Lit):
            return _literal(e.value)
        if isinstance(e, Lazy):
            return F.lit(e.thunk())
        if isinstance(e, Parent):
            if self.parent is None:
                raise PlanError("parent() outside of a related expression")
            return self.parent.column(e.inner)
        if isinstance(e, Ref):
            return self.reference(e)
        if isinstance(e, In):
            value = self.column(e.value)
            if isinstance(e.choices, Expr):
                return F.array_contains(self.column(e.choices), value)
            return value.isin(*[c for c in e.choices]) if e.choices else F.lit(False)
        if isinstance(e, Fragment):
            return self.fragment(e)
        if isinstance(e, Case):
            out = None
            for c, v in e.branches:
                out = F.when(self.column(c), self.column(v)) if out is None else out.when(self.column(c), self.column(v))
            return out.otherwise(self.column(e.otherwise))
        if isinstance(e, MapOf):
            return F.struct(*[self.column(v).alias(k) for k, v in e.fields])
        if isinstance(e, Exists):
            return self.flag(e)
        if isinstance(e, Agg):
            return self.aggregate([e])[0]
        if isinstance(e, Call) and e.name == "binding":
            return F.struct(*[F.col(self.name(a.name)).alias(a.name) for a in self.resource.attributes])
        if isinstance(e, Call):
            if e.name not in FUNCTIONS:
                raise PlanError(f"no function {e.name}")
            aggs = [a for a in e.args if isinstance(a, Agg)]
            if len(aggs) > 1:
                self.aggregate(aggs)
            return FUNCTIONS[e.name](*[self.column(a) for a in e.args], **dict(e.options))
        raise PlanError(f"{e!r} is no expression")

    def reference(self, e: Ref) -> Column:
        if not e.path and e.name in self.extra:
            return F.col(self.extra[e.name])
        resource, alias = (self.resource, self.alias)
        if e.path:
            resource, alias = self.joined[e.path] if e.path[0].startswith("$") else self.to_one(e.path)
        if resource.find("attr", e.name):
            return F.col(f"{alias}_{e.name}")
        found = resource.find("agg", e.name)
        if found is None:
            raise PlanError(f"{resource.name} has no field {e.name}")
        if e.path:
            return self.nested_aggregate(e, resource, alias, found)
        return self.column(found)

    def nested_aggregate(self, e: Ref, resource: Resource, alias: str, found: Agg) -> Column:
        """A to-one relative's aggregate: computed for this scope's rows from the relative's key."""
        at = Scope(self.engine, resource, self.df, alias, self.parent)
        at.known = self.known
        column = at.aggregate([found])[0]
        self.df = at.df
        return column

    def fragment(self, e: Fragment) -> Column:
        parts = e.sql.replace("\\?", "\0").split("?")
        if len(parts) != len(e.args) + 1:
            raise PlanError(f"the fragment has {len(parts) - 1} places for {len(e.args)} arguments")
        names = []
        for a in e.args:
            names.append(self.new_column(self.column(a)))
        sql = parts[0] + "".join(f"`{n}`{p}" for n, p in zip(names, parts[1:], strict=True))
        return F.expr(sql.replace("\0", "?"))

    def flag(self, e: Exists) -> Column:
        """Existence as a boolean column, for use under or, in calculations and sorts."""
        if id(e) in self.known:
            return F.col(self.known[id(e)][1])
        related = self.matching(e)
        name = f"{self.engine.alias()}_f"
        if related.keys and not related.conditions:
            keys = [b for _, b in related.keys]
            found = related.scope.df.select(*keys).distinct().withColumn(name, F.lit(True))
            self.df = self.df.join(found, related.on(), "left").drop(*keys)
        else:
            own = self.row_key()
            marks = [f"{name}_{i}" for i in range(len(own))]
            found = self.df.join(related.scope.df, related.on(), "left_semi")
            found = found.select(*[F.col(k).alias(m) for k, m in zip(own, marks, strict=True)]).distinct().withColumn(name, F.lit(True))
            self.df = self.df.join(found, every([F.col(k).eqNullSafe(F.col(m)) for k, m in zip(own, marks, strict=True)]), "left").drop(*marks)
        self.df = self.df.withColumn(name, F.coalesce(name, F.lit(False)))
        self.known[id(e)] = (e, name)
        return F.col(name)

    # -- aggregates --------------------------------------------------------------------------

    def aggregate(self, wanted: list[Agg]) -> list[Column]:
        """A column for each; those over the same path share one sub-plan."""
        groups: dict[tuple, list[Agg]] = {}
        for a in wanted:
            if id(a) not in self.known:
                alone = (a.read_action, *(() if not _outer(a) else (id(a.where if _equal(a) else a),)))
                groups.setdefault((a.path, a.resource, tuple(id(f) for _, f in a.join_filters), *alone), []).append(a)
        for members in groups.values():
            self._aggregate(list({id(m): m for m in members}.values()))
        return [F.col(self.known[id(a)][1]) for a in wanted]

    def _aggregate(self, members: list[Agg]) -> None:
        first = members[0]
        if first.resource:
            related = Related(Scope.of(self.engine, self.engine.domain[first.resource], self), [], [])
        else:
            filters = dict(first.join_filters)
            related = self.related(self.relationship(self.resource, first.path[0]))
            if first.path[0] in filters:
                related.scope.keep(filters[first.path[0]])
            for k, hop in enumerate(first.path[1:], 1):
                related = _chain(related, related.scope.relationship(related.scope.resource, hop))
                key = ".".join(first.path[: k + 1])
                if key in filters:
                    related.scope.keep(filters[key])
            related.scope.parent = self
        child = related.scope
        if first.read_action:
            actions = dict(child.resource.read_actions)
            if first.read_action not in actions:
                raise PlanError(f"{child.resource.name} has no read action {first.read_action}")
            child.keep(actions[first.read_action])
        # a condition that all members share is applied once, before grouping
        shared = all(m.where is first.where for m in members)
        for part in child.parts_of(first.where) if shared else []:
            if not outer_level(part):
                child.keep(part)
            elif not self.linked(related, part):
                related.conditions.append((outer_level(part), child.column(part), self.bound(child, part)))
        equal = [b for _, _, b in related.conditions if b is not None and b.op == "eq"]
        related.keys = [*related.keys, *[(self.new_column(b.limit), child.new_column(b.value)) for b in equal]]
        related.conditions = [c for c in related.conditions if c[2] is None or c[2].op != "eq"]
        alone = not related.keys and not related.conditions
        reduced = [
            (m, child.column(m.field) if m.field is not None else None, F.lit(True) if shared or m.where is None else child.condition(m.where))
            for m in members
        ]
        ranged = None if alone else self.ranged(related, reduced)
        if alone:
            keys, group = [], []
        elif ranged is not None:
            keys, group = ranged[1], [b for _, b in ranged[1]]
        elif related.conditions or not related.keys:
            own = self.row_key()
            group = [f"{self.engine.alias()}_k" for _ in own]
            keys = list(zip(own, group, strict=True))
            child.df = self.df.join(child.df, related.on()).withColumns({m: F.col(k) for k, m in keys})
        else:
            keys, group = related.keys, [b for _, b in related.keys]
        names = [f"{self.engine.alias()}_a" for _ in members]
        if ranged is not None:
            grouped = ranged[0].withColumnsRenamed({f"{group[0]}_{i}": name for i, name in enumerate(names)})
        else:
            parts = [_reduce(child, *r, group).alias(name) for r, name in zip(reduced, names, strict=True)]
            grouped = child.df.groupBy(*group).agg(*parts)
        if alone:  # one row for all
            self.df = self.df.crossJoin(F.broadcast(grouped))
        else:
            exact = ranged is not None or (bool(related.keys) and not related.conditions)
            on = every([F.col(a) == F.col(b) if exact else F.col(a).eqNullSafe(F.col(b)) for a, b in keys])
            self.df = self.df.join(grouped, on, "left").drop(*group)
        for m, name in zip(members, names, strict=True):
            self.known[id(m)] = (m, name)
            empty = {"count": F.lit(0), "exists": F.lit(False)}.get(m.kind)
            if m.default is not None:
                empty = _literal(m.default)
            if m.kind == "list" and m.default is None:
                empty = F.array().cast(T.ArrayType(child.df.select(child.column(m.field)).schema[0].dataType))
                empty = m.then(empty) if m.then else empty
            if empty is not None:
                self.df = self.df.withColumn(name, F.coalesce(F.col(name), empty))

    def ranged(self, related: Related, reduced: list[tuple[Agg, Column | None, Column]]) -> tuple[DataFrame, list[tuple[str, str]]] | None:
        """(aggregates, pairs of keys) where conditions bound one value of the related rows, and running totals in
        that value's order tell the aggregates: so no pair of rows is made. Else None.

        Related rows are grouped by keys and value, limits by keys and limit, and both are sorted together within
        their keys. At equal values a limit comes before the related rows that it leaves out. With limits at both ends
        a count is the difference of two totals.
        """
        child, bounds = related.scope, [b for _, _, b in related.conditions]
        lower, upper = ([b for b in bounds if b is not None and b.op in ops] for ops in (("gt", "ge"), ("lt", "le")))
        if any(outer_level(m.field) for m, *_ in reduced):
            return None
        if not bounds or len(lower) > 1 or len(upper) > 1 or len(lower + upper) < len(bounds) or len({b.name for b in bounds}) > 1:
            return None
        if set(self.row_key()) <= {a for a, _ in related.keys}:
            return None  # a related row meets one row at most
        kind = _comparable([child.df.select(bounds[0].value).schema[0].dataType, *[self.df.select(b.limit).schema[0].dataType for b in bounds]])
        both = len(bounds) == 2
        totals = [_running(child, *r) for r in reduced]
        if kind is None or any(t is None or (both and r[0].kind not in ("count", "exists")) for t, r in zip(totals, reduced, strict=True)):
            return None
        name = self.engine.alias()
        fields = [f"{name}_k{i}" for i in range(len(related.keys))]
        limits = [f"{name}_l{i}" for i in range(len(bounds))]
        at, turn, sign = f"{name}_at", f"{name}_turn", f"{name}_sign"
        own = [*[a for a, _ in related.keys], *[self.new_column(b.limit.cast(kind)) for b in bounds]]
        group = [*fields, *limits]
        sums = {f"{name}_s{i}_{k}": (part, run) for i, (parts, _) in enumerate(totals) for k, (part, run) in enumerate(parts)}
        rows = child.df.select(*[F.col(b).alias(f) for (_, b), f in zip(related.keys, fields, strict=True)], bounds[0].value.cast(kind).alias(at), *child.df.columns)
        rows = rows.filter(every([F.col(c).isNotNull() for c in (*fields, at)])).groupBy(*fields, at).agg(*[part.alias(s) for s, (part, _) in sums.items()])
        rows = rows.withColumn(turn, F.lit(1))
        ends = self.df.select(*[F.col(a).alias(g) for a, g in zip(own, group, strict=True)])
        ends = ends.filter(every([F.col(g).isNotNull() for g in group])).distinct()
        # with limits at both ends the lower one counts what lies before the range
        places = [(0 if (b.op in ("lt", "gt")) != (both and b in lower) else 2, -1 if both and b in lower else 1) for b in bounds]
        ends = ends.withColumn(name, F.explode(F.array(*[
            F.struct(F.col(limit).alias(at), F.lit(t).alias(turn), F.lit(s).alias(sign)) for limit, (t, s) in zip(limits, places, strict=True)
        ]))).select(*group, f"{name}.*")
        order = F.col(at).desc() if lower and not both else F.col(at).asc()
        along = Window.partitionBy(*fields).orderBy(order, turn).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        met = rows.unionByName(ends, allowMissingColumns=True).select(*group, turn, sign, *[run(F.col(s)).over(along).alias(s) for s, (_, run) in sums.items()])
        met = met.filter(F.col(turn) != 1)
        if both:
            met = met.groupBy(*group).agg(*[F.greatest(F.sum(F.col(sign) * F.coalesce(s, F.lit(0))), F.lit(0)).alias(s) for s in sums])
        out = [end(*[F.col(f"{name}_s{i}_{k}") for k in range(len(parts))]).alias(f"{group[0]}_{i}") for i, (parts, end) in enumerate(totals)]
        return met.select(*group, *out), list(zip(own, group, strict=True))


def _comparable(kinds: list[T.DataType]) -> T.DataType | None:
    """The type in which values of these types are compared, where that is sure."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    if all(isinstance(k, whole) for k in kinds):
        return T.LongType()
    if T.DoubleType() in kinds and all(isinstance(k, (*whole, T.FloatType, T.DoubleType)) for k in kinds):
        return T.DoubleType()
    return None


def _running(child: Scope, m: Agg, value: Column | None, condition: Column):
    """([(aggregate of rows, aggregate of those in turn)], the result of these) of an aggregate that running totals
    tell, else None."""
    of = F.when(condition, F.lit(1) if value is None else value)
    count = (F.count(of), F.sum)
    if m.uniq:
        return None
    if m.kind == "count":
        return [count], lambda n: F.coalesce(n, F.lit(0))
    if m.kind == "exists":
        return [(F.count(F.when(condition, F.lit(1))), F.sum)], lambda n: F.coalesce(n > 0, F.lit(False))
    if m.kind in ("min", "max"):
        reduce_by = F.min if m.kind == "min" else F.max
        return [(reduce_by(of), reduce_by)], lambda x: x
    if m.kind in ("sum", "avg") and isinstance(child.df.select(value).schema[0].dataType, T.FloatType | T.DoubleType):
        return ([(F.sum(of), F.sum)], lambda x: x) if m.kind == "sum" else ([(F.sum(of), F.sum), count], F.try_divide)
    return None


def _reduce(child: Scope, m: Agg, value: Column | None, condition: Column, group: list[str]) -> Column:
    only = lambda c: F.when(condition, c)
    if m.kind == "count":
        if value is None:
            return F.count(only(F.lit(1)))
        return F.count_distinct(only(value)) if m.uniq else F.count(only(value))
    if m.kind == "exists":
        return F.coalesce(F.max(only(F.lit(True))), F.lit(False))
    if m.kind in ("sum", "avg", "min", "max"):
        of = only(value)
        if m.uniq and m.kind in ("sum", "avg"):
            return F.sum_distinct(of) if m.kind == "sum" else F.try_divide(F.sum_distinct(of), F.count_distinct(of))
        return {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[m.kind](of)
    if m.kind == "custom":
        return m.custom(only(value) if value is not None else only(F.lit(1)))
    if m.kind not in ("first", "list"):
        raise PlanError(f"no aggregate {m.kind}")
    # rows are ranked within their group, on the partitioning that the grouping needs anyway
    chosen = condition if m.include_nil else condition & value.isNotNull()
    order = [_ASC[way](child.column(k)) for k, way in sort_keys(m.sort)] or [F.lit(1)]
    place = child.new_column(F.row_number().over(Window.partitionBy(*group).orderBy(F.when(chosen, 0).otherwise(1), *order)))
    held = child.new_column(value)
    picked = child.new_column(chosen)
    if m.kind == "first":
        return F.max(F.when((F.col(place) == 1) & F.col(picked), F.col(held)))
    rows = F.array_sort(F.collect_list(F.when(F.col(picked), F.struct(F.col(place).alias("at"), F.col(held).alias("value")))))
    values = F.transform(rows, lambda s: s["value"])
    values = F.array_distinct(values) if m.uniq else values
    return m.then(values) if m.then else values


def _outer(a: Agg) -> bool:
    return outer_level(a.where) > 0 or outer_level(a.field) > 0


def _equal(a: Agg) -> bool:
    """Whether all that an aggregate takes from its parent are values that related rows equal."""
    pairs = [p.args for p in conjuncts(a.where) if outer_level(p) and isinstance(p, Call) and p.name == "eq"]
    linked = [any(isinstance(m, Parent) and not outer_level(m.inner) and not outer_level(t) for m, t in ((x, y), (y, x))) for x, y in pairs]
    return not outer_level(a.field) and all(linked) and len(linked) == sum(outer_level(p) > 0 for p in conjuncts(a.where))


def _literal(value) -> Column:
    if isinstance(value, list | tuple):
        return F.array(*[_literal(v) for v in value])
    if isinstance(value, Column):
        return value
    return F.lit(value)


def _chain(out: Related, rel: Relationship) -> Related:
    """One hop further: the hop's rows joined to those so far."""
    following = out.scope.related(rel)
    child = following.scope
    joined = out.scope.df.join(child.df, following.on())
    child.joined.update({k: v for k, v in out.scope.joined.items() if k[0].startswith("$")})
    child.df = joined
    child.parent = out.scope.parent
    return Related(child, out.keys, out.conditions)


def _top(source: Scope, out: Related, sort, offset: int, limit: int | None) -> Related:
    """The rows from offset to offset plus limit of each source row."""
    child = out.scope
    if out.conditions or not out.keys:
        # what relates the rows isn't keys alone: the source's own key is carried along
        own = source.row_key()
        marks = [f"{source.engine.alias()}_k" for _ in own]
        columns = child.df.columns
        child.df = source.df.join(child.df, out.on()).select(*columns, *[F.col(k).alias(m) for k, m in zip(own, marks, strict=True)])
        out = Related(child, list(zip(own, marks, strict=True)), [])
    order = [_ASC[way](child.column(k)) for k, way in sort_keys(sort)] or [F.col(child.name(k)).asc_nulls_last() for k in child.resource.row_key()]
    place = child.new_column(F.row_number().over(Window.partitionBy(*[b for _, b in out.keys]).orderBy(*order)))
    if limit is not None:
        child.df = child.df.filter(F.col(place) <= offset + limit)
    if offset:
        child.df = child.df.filter(F.col(place) > offset)
    return out


def _under(e: Expr, path: tuple[str, ...]) -> Expr:
    """The expression of a relative, seen from the path's start."""
    if not path:
        return e
    if isinstance(e, Ref):
        return Ref(path + e.path, e.name, e.args)
    if isinstance(e, Exists) and not e.resource:
        return replace(e, at=path + e.at)
    if isinstance(e, Agg) and not e.resource:
        return replace(e, path=path + e.path)
    return rebuild(e, lambda x: _under(x, path))


def _moved(e: Expr, path: tuple[str, ...]) -> Expr:
    """A condition on a path's end, seen from there; all else is the parent's."""
    if isinstance(e, Ref):
        return Ref(e.path[len(path) :], e.name, e.args) if e.path[: len(path)] == path else Parent(e)
    if isinstance(e, Exists) and e.at and e.at[: len(path)] == path:
        return replace(e, at=e.at[len(path) :])
    if isinstance(e, Exists | Agg | Parent):
        return Parent(e)
    return rebuild(e, lambda x: _moved(x, path))


__all__ = ["Related", "Scope", "all_of", "every", "sort_keys"]
