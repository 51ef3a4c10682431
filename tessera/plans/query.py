"""Immutable queries over resources, compiled to one lazy DataFrame."""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import PlanError, QueryTimeout
from tessera.expr import Agg, Expr, Ref, all_of, ref
from tessera.operators.paginate import after
from tessera.plans.scope import _ASC, Scope, every, sort_keys
from tessera.sources.engine import Engine


@dataclass(frozen=True)
class Query:
    engine: Engine
    resource: str
    filters: tuple[Expr, ...] = ()
    sorts: tuple = ()
    distinct_on: tuple = ()
    distinct_sorts: tuple = ()
    limit_to: int | None = None
    skip: int = 0
    fields: tuple[str, ...] | None = None
    calculations: tuple[tuple[str, Expr], ...] = ()
    aggregates: tuple[tuple[str, Agg], ...] = ()
    loads: tuple[tuple[str, Query], ...] = ()
    parts: tuple[tuple[str, Query], ...] = ()
    cursor: tuple | None = None

    # -- building ----------------------------------------------------------------------------

    def filter(self, *conditions: Expr) -> Query:
        return replace(self, filters=self.filters + conditions)

    def sort(self, *keys) -> Query:
        return replace(self, sorts=self.sorts + keys)

    def unsort(self) -> Query:
        return replace(self, sorts=())

    def distinct(self, *keys) -> Query:
        return replace(self, distinct_on=self.distinct_on + keys)

    def distinct_sort(self, *keys) -> Query:
        return replace(self, distinct_sorts=self.distinct_sorts + keys)

    def limit(self, n: int | None) -> Query:
        return replace(self, limit_to=n)

    def offset(self, n: int) -> Query:
        return replace(self, skip=n)

    def select(self, *names: str) -> Query:
        return replace(self, fields=tuple(dict.fromkeys(names)))

    def calculate(self, **expressions) -> Query:
        return replace(self, calculations=self.calculations + tuple(expressions.items()))

    def aggregate(self, **aggregates: Agg) -> Query:
        return replace(self, aggregates=self.aggregates + tuple(aggregates.items()))

    def load(self, relationship: str, query: Query | None = None, name: str | None = None) -> Query:
        """Related rows as an ordered list of structs in a column of that name."""
        rel = self.engine.domain[self.resource].find("rel", relationship)
        if rel is None:
            raise PlanError(f"{self.resource} has no relationship {relationship}")
        return replace(self, loads=self.loads + ((relationship, query or Query(self.engine, rel.destination)),))

    def after(self, *values: Any) -> Query:
        """Keyset pagination: only rows behind these values of the sort keys."""
        return replace(self, cursor=values)

    def lock(self, mode: str = "for update") -> Query:
        """Row locks have no meaning here: versions of a store keep writers apart. Known modes are
        accepted and change nothing."""
        if mode.lower().removesuffix(" nowait").removesuffix(" skip locked") not in ("for update", "for no key update", "for share", "for key share"):
            raise PlanError(f"no lock {mode}")
        return self

    def union(self, other: Query) -> Query:
        return self._combined("union", other)

    def union_all(self, other: Query) -> Query:
        return self._combined("union_all", other)

    def intersect(self, other: Query) -> Query:
        return self._combined("intersect", other)

    def except_(self, other: Query) -> Query:
        return self._combined("except", other)

    def _combined(self, how: str, other: Query) -> Query:
        if self.parts:
            return replace(self, parts=self.parts + ((how, other),))
        return Query(self.engine, self.resource, parts=(("base", self), (how, other)))

    # -- running -----------------------------------------------------------------------------

    def scope(self) -> Scope:
        """Rows, in no order: filters, distinct, and the page."""
        scope = self._combination() if self.parts else Scope.of(self.engine, self.engine.domain[self.resource])
        if self.filters:
            scope.keep(all_of(list(self.filters)))
        for name, e in self.calculations:
            if not (self.parts and name in scope.extra):
                scope.extra[name] = scope.new_column(scope.column(e))
        used = {s.name for s in (k for k, _ in sort_keys(self.sorts + self.distinct_sorts)) if isinstance(s, Ref) and not s.path}
        early = [(n, a) for n, a in self.aggregates if n in used]
        self._attach(scope, early)
        order = [(scope.column(k), way) for k, way in sort_keys(self.sorts)]
        if self.distinct_on:
            on = [scope.new_column(scope.column(ref(k) if isinstance(k, str) else k)) for k in self.distinct_on]
            rank = [(scope.column(k), way) for k, way in sort_keys(self.distinct_sorts)] or order
            rank = [_ASC[way](c) for c, way in rank] or [F.lit(1)]
            place = scope.new_column(F.row_number().over(Window.partitionBy(*on).orderBy(*rank)))
            scope.df = scope.df.filter(F.col(place) == 1)
        if self.cursor is not None:
            scope.df = scope.df.filter(after(order, self.cursor))
        if self.skip or self.limit_to is not None:
            scope.df = scope.df.orderBy(*[_ASC[way](c) for c, way in order]) if order else scope.df
            if self.skip:
                scope.df = scope.df.offset(self.skip)
            if self.limit_to is not None:
                scope.df = scope.df.limit(self.limit_to)
        # what only the result needs is joined to the page, not to all rows
        self._attach(scope, [(n, a) for n, a in self.aggregates if n not in used])
        scope.order = order
        return scope

    def _attach(self, scope: Scope, aggregates) -> None:
        columns = scope.aggregate([a for _, a in aggregates])
        for (name, _), column in zip(aggregates, columns, strict=True):
            scope.extra[name] = scope.new_column(column)

    def names(self) -> tuple[str, ...]:
        if self.fields is not None:
            return self.fields
        if self.parts and self.parts[0][1].fields is not None:
            return self.parts[0][1].names()
        return tuple(a.name for a in self.engine.domain[self.resource].attributes if a.select)

    def to_df(self) -> DataFrame:
        """The result; sorted if the query is."""
        from tessera.operators.load import load_lists

        scope = self.scope()
        load_lists(scope, self.loads)
        named = [*self.names(), *[n for n, _ in self.calculations + self.aggregates + self.loads]]
        if self.parts:
            named += [n for n in scope.extra if n not in named and n in dict(self.parts[0][1].calculations)]
        chosen = [(n, scope.column(ref(n))) for n in dict.fromkeys(named)]
        if scope.order:
            scope.df = scope.df.orderBy(*[_ASC[way](c) for c, way in scope.order])
        hidden = [n for n, _ in self.calculations if self._hidden(n)]
        out = [c.alias(n) for n, c in chosen if n not in hidden]
        if hidden:
            out.append(F.struct(*[c.alias(n) for n, c in chosen if n in hidden]).alias("calculations"))
        return scope.df.select(*out)

    def collect(self, timeout: float | None = None) -> list:
        """The result's rows. timeout: seconds after which its Spark jobs are cancelled."""
        if timeout is None:
            return self.to_df().collect()
        context, tag, late = self.engine.spark.sparkContext, f"query-{uuid.uuid4().hex}", threading.Event()

        def stop() -> None:
            late.set()
            context.cancelJobsWithTag(tag)

        timer = threading.Timer(timeout, stop)
        context.addJobTag(tag)
        timer.start()
        try:
            return self.to_df().collect()
        except Exception as e:
            if late.is_set():
                raise QueryTimeout(f"the query took more than {timeout} s") from e
            raise
        finally:
            timer.cancel()
            context.removeJobTag(tag)

    def _hidden(self, name: str) -> bool:
        calc = self.engine.domain[self.resource].find("calc", name)
        return calc is not None and not calc.public

    def summarise(self, **aggregates: Agg) -> DataFrame:
        """One row of aggregates over the whole query, its limit respected; one pass for all."""
        from tessera.plans.scope import _reduce

        scope, parts = self.scope(), []
        for name, a in aggregates.items():
            condition = scope.condition(a.where)
            value = scope.column(a.field) if a.field is not None else None
            column = _reduce(scope, a, value, condition, [])
            if a.default is not None:
                column = F.coalesce(column, F.lit(a.default))
            parts.append(column.alias(name))
        return scope.df.agg(*parts)

    def count(self) -> DataFrame:
        return self.summarise(count=Agg("count"))

    def _combination(self) -> Scope:
        """Each part applies to what the ones before it gave."""
        engine, resource = self.engine, self.engine.domain[self.resource]
        base = self.parts[0][1]
        extras = [n for n, _ in base.calculations]
        names = [*base.names(), *extras]
        done = None
        for how, part in self.parts:
            have = [*part.names(), *[n for n, _ in part.calculations]]
            if set(have) != set(names):
                raise PlanError(f"a combination's parts have the same fields: {names} and {have}")
            rows = part.to_df().select(*names)
            if done is None:
                done = rows
            elif how == "union_all":
                done = done.unionByName(rows)
            elif how == "union":
                done = done.unionByName(rows).distinct()
            elif how == "intersect":
                done = done.intersect(rows)
            else:
                done = done.subtract(rows)
        alias = engine.alias()
        scope = Scope(engine, resource, done.select(*[F.col(n).alias(f"{alias}_{n}") for n in names]), alias)
        scope.extra = {n: f"{alias}_{n}" for n in extras}
        missing = [a.name for a in resource.attributes if a.name not in names]
        if missing and all(k in names for k in resource.primary_key) and resource.primary_key:
            # fields that the parts don't carry come from the resource, by its key
            rest = Scope.of(engine, resource)
            on = every([F.col(f"{alias}_{k}") == F.col(rest.name(k)) for k in resource.primary_key])
            scope.df = scope.df.join(rest.df, on).select(*scope.df.columns, *[F.col(rest.name(m)).alias(f"{alias}_{m}") for m in missing])
        return scope
