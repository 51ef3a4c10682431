"""Relationship loading: related rows of each parent, with sort, limit and offset for each parent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import PlanError
from tessera.expr import all_of, ref
from tessera.operators.paginate import after
from tessera.plans.scope import _ASC, Scope, every, sort_keys


def _narrow(query) -> bool:
    return bool(query.filters or query.limit_to is not None or query.skip or query.distinct_on or query.parts)


def _rows(source: Scope, relationship: str, query, narrow: bool = False) -> tuple[Scope, list[str], str]:
    """Related rows joined to the parents' keys: scope, the parents' key columns, the order's column.

    narrow: the parents are some of many, so that only their rows are aggregated and ranked.
    """
    rel = source.relationship(source.resource, relationship)
    found = source.related(rel, limited=not rel.no_attributes)
    child = found.scope
    if narrow and found.keys and not found.conditions:
        asked = source.df.select(*[F.col(a).alias(f"_p{i}") for i, (a, _) in enumerate(found.keys)])
        child.df = child.df.join(asked, every([F.col(b) == F.col(f"_p{i}") for i, (_, b) in enumerate(found.keys)]), "left_semi")
    if query.filters:
        child.keep(all_of(list(query.filters)))
    for name, e in query.calculations:
        child.extra[name] = child.new_column(child.column(e))
    columns = child.aggregate([a for _, a in query.aggregates])
    for (name, _), column in zip(query.aggregates, columns, strict=True):
        child.extra[name] = child.new_column(column)
    key = source.resource.row_key()
    own = [source.name(k) for k in key]
    needed = sorted({*own, *[a for a, _ in found.keys]} | {c for c in source.df.columns if found.conditions})
    marks = [f"{source.engine.alias()}_s" for _ in key]
    place = f"{source.engine.alias()}_o"
    parents = source.df.select(*needed).distinct()
    sorts = sort_keys(query.sorts or rel.sort)
    order = [(child.column(k), way) for k, way in sorts] or [(F.col(child.name(k)), "asc") for k in child.resource.row_key()]
    df = parents.join(child.df, found.on()).withColumns({m: F.col(c) for m, c in zip(marks, own, strict=True)})
    if rel.kind == "many_to_many" or rel.path:
        df = df.dropDuplicates([*marks, *[child.name(k) for k in child.resource.row_key()]])
    if query.cursor is not None:
        df = df.filter(after(order, query.cursor))
    window = Window.partitionBy(*marks).orderBy(*[_ASC[way](c) for c, way in order])
    df = df.withColumn(place, F.row_number().over(window))
    skip, limit = query.skip, query.limit_to
    if rel.no_attributes:
        skip, limit = rel.offset + skip, 1 if rel.from_many else limit if limit is not None else rel.limit
    if limit is not None:
        df = df.filter(F.col(place) <= skip + limit)
    if skip:
        df = df.filter(F.col(place) > skip)
    child.df = df
    return child, marks, place


def load_related(query, relationship: str, of=None) -> DataFrame:
    """The related rows of a query's rows: the parent's key as __source_<key>, the fields, and __order__.

    ``of`` is the query on the destination: its sort, limit, offset and cursor hold for each parent.
    """
    from tessera.plans.query import Query

    source = query.scope()
    rel = source.relationship(source.resource, relationship)
    of = of or Query(query.engine, rel.destination)
    if of.parts or of.distinct_on:
        raise PlanError("a load's query has no combinations and no distinct")
    child, marks, order = _rows(source, relationship, of, _narrow(query))
    names = [*of.names(), *[n for n, _ in of.calculations + of.aggregates]]
    sources = [F.col(m).alias(f"__source_{k}") for m, k in zip(marks, source.resource.row_key(), strict=True)]
    return child.df.select(*sources, *[child.column(ref(n)).alias(n) for n in names], F.col(order).alias("__order__"))


def summarise_related(query, relationship: str, of=None, **aggregates) -> DataFrame:
    """Aggregates over each parent's related rows, the load's limit respected; parents without rows too."""
    from tessera.plans.query import Query
    from tessera.plans.scope import _reduce

    source = query.scope()
    rel = source.relationship(source.resource, relationship)
    child, marks, _ = _rows(source, relationship, of or Query(query.engine, rel.destination), _narrow(query))
    parts = []
    for name, a in aggregates.items():
        condition = child.condition(a.where)
        value = child.column(a.field) if a.field is not None else None
        parts.append(_reduce(child, a, value, condition, marks).alias(name))
    found = child.df.groupBy(*marks).agg(*parts)
    key = source.resource.row_key()
    on = every([F.col(source.name(k)).eqNullSafe(F.col(m)) for k, m in zip(key, marks, strict=True)])
    empty = {n: {"count": F.lit(0), "exists": F.lit(False)}.get(a.kind, F.lit(a.default)) for n, a in aggregates.items()}
    return source.df.join(found, on, "left").select(
        *[F.col(source.name(k)).alias(f"__source_{k}") for k in key], *[F.coalesce(F.col(n), e).alias(n) for n, e in empty.items()]
    )


def load_lists(scope: Scope, loads) -> None:
    """Adds each load as a list of structs; nothing related: an empty one."""
    for relationship, of in loads:
        child, marks, order = _rows(scope, relationship, of)
        if of.loads:
            load_lists(child, of.loads)
        names = [*of.names(), *[n for n, _ in of.calculations + of.aggregates + of.loads]]
        name = f"{scope.engine.alias()}_l"
        fields = [child.column(ref(n)).alias(n) for n in names]
        rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("at"), F.struct(*fields).alias("row"))))
        lists = child.df.groupBy(*marks).agg(F.transform(rows, lambda s: s["row"]).alias(name))
        on = every([F.col(scope.name(k)).eqNullSafe(F.col(m)) for k, m in zip(scope.resource.row_key(), marks, strict=True)])
        scope.df = scope.df.join(lists, on, "left").drop(*marks)
        scope.df = scope.df.withColumn(name, F.coalesce(name, F.array().cast(lists.schema[name].dataType)))
        scope.extra[relationship] = name
