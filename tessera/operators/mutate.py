"""Set-based mutations: each gives the table's new rows and the rows that changed.

Nothing is written here; VersionedStore publishes ``rows``. Every mutation is one pass over the
table: an append, or a join on the row key. Before it returns, the rows that it made are held
against the resource's constraints, by one job over those rows and what of the table shares their keys.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.errors import ConstraintError, PlanError, StaleRecord
from tessera.expr import Expr, Ref, all_of, children, ref
from tessera.plans.query import Query
from tessera.plans.scope import Scope, every
from tessera.schema import Exclusion, Identity, Resource
from tessera.sources.engine import Engine

ACTION = "_action"
ORDINAL = "_ordinal"


@dataclass(frozen=True)
class Change:
    """rows: the table afterwards. changed: what was inserted, updated, deleted or skipped, with
    _action; inserted and upserted ones also with _ordinal, the input's order."""

    rows: DataFrame
    changed: DataFrame


def _columns(resource: Resource) -> list[str]:
    return [a.name for a in resource.attributes]


def _table(engine: Engine, resource: Resource) -> DataFrame:
    alias = engine.alias()
    return engine.rows(resource, alias, mutating=True).toDF(*_columns(resource))


def _on_rows(engine: Engine, resource: Resource, df: DataFrame) -> Scope:
    """A scope over rows whose columns have the attributes' names."""
    scope = Scope(engine, resource, df, "")
    scope.name = lambda n: n  # type: ignore[method-assign]
    scope.extra = {c: c for c in df.columns}
    return scope


def _default(scope: Scope, value) -> Column:
    """A default of each row, or one value for all."""
    value = value() if callable(value) and not isinstance(value, Expr) else value
    return scope.column(value) if isinstance(value, Expr) else value if isinstance(value, Column) else F.lit(value)


def _prepared(engine: Engine, resource: Resource, given: DataFrame, atomics: Mapping[str, Expr]) -> DataFrame:
    """Input rows with all attributes: given, computed, by default, or null; and their order."""
    unknown = set(given.columns) - set(_columns(resource))
    if unknown:
        raise PlanError(f"{resource.name} has no attributes {sorted(unknown)}")
    types = dict(_table(engine, resource).dtypes)
    out = []
    scope = _on_rows(engine, resource, given.withColumn(ORDINAL, F.monotonically_increasing_id()))
    for a in resource.attributes:
        if a.name in atomics:
            value = scope.column(atomics[a.name])
        elif a.name in given.columns:
            value = F.col(a.name)
        else:
            value = _default(scope, a.default)
        if resource.tenant_attribute == a.name and engine.tenant is not None:
            value = F.lit(engine.tenant)
        out.append(value.cast(types[a.name]).alias(a.name))
    return scope.df.select(*out, ORDINAL)


def bulk_create(engine: Engine, name: str, given: DataFrame, atomics: Mapping[str, Expr] | None = None) -> Change:
    """Inserts. changed has the rows in the input's order by _ordinal."""
    resource = engine.domain[name]
    fresh = _prepared(engine, resource, given, atomics or {})
    table = _table(engine, resource)
    check(engine, resource, fresh.drop(ORDINAL), table)
    return Change(table.unionByName(fresh.drop(ORDINAL)), fresh.withColumn(ACTION, F.lit("insert")))


def create(engine: Engine, name: str, **values) -> Change:
    """One row; values may be expressions."""
    plain = {k: v for k, v in values.items() if not isinstance(v, Expr)}
    one = engine.spark.range(1).select(*[F.lit(v).alias(k) for k, v in plain.items()], *([] if plain else [F.lit(1).alias("_")]))
    return bulk_create(engine, name, one if plain else one.drop("_"), {k: v for k, v in values.items() if isinstance(v, Expr)})


def _identity(resource: Resource, identity: str | None) -> Identity:
    if identity is None:
        if not resource.primary_key:
            raise PlanError(f"{resource.name} has no primary key; name an identity")
        return Identity("primary_key", resource.primary_key)
    found = resource.find("identity", identity)
    if found is None:
        raise PlanError(f"{resource.name} has no identity {identity}")
    return found


def _keys(engine: Engine, resource: Resource, df: DataFrame, identity: Identity, prefix: str) -> DataFrame:
    """Adds the identity's keys, attributes or calculations, as <prefix>0.., and whether they count."""
    scope = _on_rows(engine, resource, df)
    values = [scope.column(Ref((), k)) for k in identity.keys]
    counts = scope.column(identity.where) if identity.where is not None else F.lit(True)
    if identity.nils_distinct:
        counts = counts & every([v.isNotNull() for v in values])
    marked = scope.df.withColumns({f"{prefix}{i}": v for i, v in enumerate(values)})
    return marked.withColumn(f"{prefix}ok", F.coalesce(counts, F.lit(False)))


def upsert(
    engine: Engine,
    name: str,
    given: DataFrame,
    identity: str | None = None,
    fields: tuple[str, ...] | None = None,
    condition=None,
    touch_update_defaults: bool = True,
    return_skipped: bool = False,
) -> Change:
    """Inserts rows whose identity is new and updates those it meets.

    fields: what an update sets; else all given attributes but the keys. condition: a function of
    (old, new) column lookups; an update that doesn't meet it is skipped. Two input rows of one
    identity are an error.
    """
    resource = engine.domain[name]
    key = _identity(resource, identity)
    names = _columns(resource)
    source = _keys(engine, resource, _prepared(engine, resource, given, {}), key, "_s")
    target = _keys(engine, resource, _table(engine, resource), key, "_t")
    parts = range(len(key.keys))
    twice = source.filter("_sok").groupBy(*[f"_s{i}" for i in parts]).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not twice.isEmpty():
        raise ConstraintError([{"field": key.keys[0], "message": "occurs twice in the input"}])
    source = source.select(*[F.col(n).alias(f"_new_{n}") for n in names], ORDINAL, *[f"_s{i}" for i in parts], "_sok")
    target = target.select(*[F.col(n).alias(f"_old_{n}") for n in names], *[f"_t{i}" for i in parts], "_tok").withColumn("_have", F.lit(True))
    on = every([F.col(f"_s{i}").eqNullSafe(F.col(f"_t{i}")) for i in parts] + [F.col("_sok") == F.col("_tok"), F.col("_tok")])
    both = target.join(source, on, "full_outer")
    matched = F.col("_have").isNotNull() & F.col(ORDINAL).isNotNull()
    met = matched
    if condition is not None:
        held = condition(lambda n: F.col(f"_old_{n}"), lambda n: F.col(f"_new_{n}"))
        met = matched & F.coalesce(held, F.lit(False))
    sets = set(fields if fields is not None else [c for c in given.columns if c not in key.keys])
    out = []
    for a in resource.attributes:
        new, old = F.col(f"_new_{a.name}"), F.col(f"_old_{a.name}")
        updated = new if a.name in sets else old
        if touch_update_defaults and a.update_default is not None and sets:
            default = _default(_on_rows(engine, resource, _table(engine, resource)), a.update_default)
            updated = F.coalesce(new, default) if a.name in sets else default
        out.append(F.when(met, updated).when(F.col("_have").isNull(), new).otherwise(old).alias(a.name))
    action = F.when(met, "update").when(F.col("_have").isNull(), "insert").when(matched, "skip")
    result = both.select(*out, ORDINAL, action.alias(ACTION))
    made = F.coalesce(F.col(ACTION), F.lit("")).isin("insert", "update")
    check(engine, resource, result.filter(made).select(*names), result.filter(~made).select(*names), settled=key.name)
    changed = result.filter(F.col(ACTION).isNotNull() if return_skipped else made)
    return Change(result.select(*names), changed)


def _changed_in(engine: Engine, query: Query) -> tuple[Resource, DataFrame, list[str]]:
    """The rows that a query chooses, as the key only."""
    resource = engine.domain[query.resource]
    key = list(resource.row_key())
    scope = query.scope()
    if resource.write_policy is not None:
        scope.keep(resource.write_policy)
    return resource, scope.df.select(*[F.col(scope.name(k)).alias(k) for k in key]).distinct(), key


def _needs_subset(query: Query) -> bool:
    def local(e: Expr) -> bool:
        return not (isinstance(e, Ref) and e.path) and type(e).__name__ not in ("Exists", "Agg") and all(map(local, children(e)))

    return bool(query.limit_to is not None or query.skip or query.distinct_on or query.parts or not all(map(local, query.filters)))


def update_query(query: Query, atomics: Mapping[str, Expr]) -> Change:
    """Sets attributes of the query's rows by expressions over the old row and its relatives.

    Plain filters become a condition; limits, relationships and distinct choose keys first, and the
    table is joined to them.
    """
    engine = query.engine
    resource = engine.domain[query.resource]
    names, key = _columns(resource), list(resource.row_key())
    if set(atomics) & set(resource.primary_key):
        raise PlanError("a primary key can't be updated")
    scope = Scope(engine, resource, engine.rows(resource, alias := engine.alias(), mutating=True), alias)
    always = [f for f in (resource.base_filter, resource.read_policy, resource.write_policy) if f is not None]
    if _needs_subset(query) or always:
        chosen = _changed_in(engine, query)[1].withColumn("_chosen", F.lit(True))
        marks = chosen.select(*[F.col(k).alias(f"_k_{k}") for k in key], "_chosen")
        scope.df = scope.df.join(marks, every([F.col(scope.name(k)) == F.col(f"_k_{k}") for k in key]), "left")
        hit = F.coalesce("_chosen", F.lit(False))
    else:
        hit = F.coalesce(scope.condition(all_of(list(query.filters))), F.lit(False))
    hit = F.col(scope.new_column(hit))
    out = []
    for a in resource.attributes:
        old = F.col(scope.name(a.name))
        if a.name in atomics:
            new = scope.column(atomics[a.name])
        elif a.update_default is not None:
            new = _default(scope, a.update_default)
        else:
            new = None
        out.append((old if new is None else F.when(hit, new).otherwise(old)).cast(scope.df.schema[scope.name(a.name)].dataType).alias(a.name))
    result = scope.df.select(*out, hit.alias("_hit"))
    sets = {*atomics, *[a.name for a in resource.attributes if a.update_default is not None]}
    check(engine, resource, result.filter("_hit").select(*names), result.filter("NOT _hit").select(*names), touched=sets)
    return Change(result.select(*names), result.filter("_hit").drop("_hit").withColumn(ACTION, F.lit("update")))


def update_many(engine: Engine, name: str, changes: DataFrame, present: Mapping[str, str] | None = None) -> Change:
    """A different change for each row. changes: the row key and new values; present: for an
    attribute the boolean column that says whether its value, null or not, is to be set (default:
    every given column is)."""
    resource = engine.domain[name]
    names, key = _columns(resource), list(resource.row_key())
    present = present or {}
    sets = [c for c in changes.columns if c in names and c not in key]
    if not changes.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        raise ConstraintError([{"field": key[0], "message": "occurs twice in the input"}])
    new = changes.select(*[F.col(k).alias(f"_k_{k}") for k in key], *[F.col(c).alias(f"_new_{c}") for c in sets],
                         *[F.col(present[c]).alias(f"_set_{c}") for c in sets if c in present], F.lit(True).alias("_hit"))
    table = _table(engine, resource)
    both = table.join(new, every([F.col(k) == F.col(f"_k_{k}") for k in key]), "left")
    hit = F.coalesce("_hit", F.lit(False))
    out = []
    for n in names:
        if n not in sets:
            out.append(F.col(n))
            continue
        given = hit & F.coalesce(F.col(f"_set_{n}"), F.lit(False)) if n in present else hit
        out.append(F.when(given, F.col(f"_new_{n}")).otherwise(F.col(n)).cast(table.schema[n].dataType).alias(n))
    result = both.select(*out, hit.alias("_hit"))
    check(engine, resource, result.filter("_hit").select(*names), result.filter("NOT _hit").select(*names), touched=set(sets))
    return Change(result.select(*names), result.filter("_hit").drop("_hit").withColumn(ACTION, F.lit("update")))


def destroy_query(query: Query) -> Change:
    """Deletes the query's rows."""
    engine = query.engine
    resource, chosen, key = _changed_in(engine, query)
    table = _table(engine, resource)
    gone = table.join(chosen, key, "left_semi").select(*table.columns)
    for owner in engine.domain.resources:
        for r in owner.references:
            if r.destination == resource.name and r.on_delete == "restrict":
                pointing = _table(engine, owner).join(gone, F.col(r.attribute) == gone[r.destination_attribute], "left_semi")
                if not pointing.isEmpty():
                    raise ConstraintError([{"field": r.attribute, "message": f"{owner.name} rows still refer to it"}])
    return Change(table.join(chosen, key, "left_anti").select(*table.columns), gone.withColumn(ACTION, F.lit("delete")))


def cascade(engine: Engine, name: str, gone: DataFrame) -> dict[str, DataFrame]:
    """What the deletion of rows does to the tables that refer to them: their new rows by resource."""
    out = {}
    for owner in engine.domain.resources:
        for r in owner.references:
            if r.destination != name or r.on_delete == "restrict":
                continue
            table = _table(engine, owner)
            keys = gone.select(F.col(r.destination_attribute).alias("_gone")).distinct()
            if r.on_delete == "delete":
                out[owner.name] = table.join(keys, F.col(r.attribute) == F.col("_gone"), "left_anti")
            else:
                hit = table.join(keys, F.col(r.attribute) == F.col("_gone"), "left")
                nulled = F.when(F.col("_gone").isNull(), F.col(r.attribute)).alias(r.attribute)
                out[owner.name] = hit.select(*[nulled if c == r.attribute else F.col(c) for c in table.columns])
    return out


def _one(change: Change) -> Change:
    if change.changed.isEmpty():
        raise StaleRecord("no row has this key")
    return change


def update(query: Query, atomics: Mapping[str, Expr]) -> Change:
    """A single row's update; an error if there is none."""
    return _one(update_query(query, atomics))


def destroy(query: Query) -> Change:
    return _one(destroy_query(query))


def optimistic(query: Query, attribute: str, seen) -> tuple[Query, dict[str, Expr]]:
    """A query and changes for update() or destroy() that fail as stale unless the attribute still has
    the value that was seen; the update adds one to it."""
    return query.filter(ref(attribute) == seen), {attribute: ref(attribute) + 1}


def _overlaps(engine: Engine, resource: Resource, x: Exclusion, fresh: DataFrame, others: DataFrame) -> DataFrame:
    """Rows whose range begins before an earlier one of their keys has ended."""
    keys = list(x.keys)
    near = others.join(fresh.select(*keys).distinct(), keys, "left_semi").select(*fresh.columns)
    r = F.col(x.range)
    rows = near.unionByName(fresh).filter(every([F.col(k).isNotNull() for k in keys] + [r.isNotNull(), ~r["empty"]]))
    before = Window.partitionBy(*keys).orderBy(r["lower"].asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    end = F.struct(r["upper"].isNull().alias("open"), r["upper"].alias("upper"), r["upper_inc"].alias("inc"))
    rows = rows.withColumn("_end", F.max(end).over(before)).filter("_end IS NOT NULL")
    touch = (F.col("_end.upper") == r["lower"]) & F.col("_end.inc") & r["lower_inc"]
    return rows.filter(F.col("_end.open") | r["lower"].isNull() | (F.col("_end.upper") > r["lower"]) | touch)


def check(
    engine: Engine, resource: Resource, fresh: DataFrame, others: DataFrame, touched: set[str] | None = None, settled: str | None = None
) -> None:
    """Raises ConstraintError for missing values, wrong choices, failed checks, forbidden rows, taken
    identities, overlapping ranges and references to rows that aren't there.

    fresh: the rows as made; others: the table without them. touched: the attributes that may have
    changed; constraints on others aren't looked at. settled: an identity that needs no look. One job:
    each constraint contributes at most a row. Only what of the table shares a key with fresh is grouped.
    """
    meets = lambda names: touched is None or bool(set(names) & touched)
    errors: list[dict] = []
    found: list[DataFrame] = []

    def rule(field: str, message: str, broken: DataFrame) -> None:
        errors.append({"field": field, "message": message})
        found.append(broken.select(F.lit(len(errors) - 1).alias("rule")).limit(1))

    for a in resource.attributes:
        if meets([a.name]):
            if not a.allow_nil:
                rule(a.name, "is required", fresh.filter(F.col(a.name).isNull()))
            if a.one_of:
                rule(a.name, f"is none of {list(a.one_of)}", fresh.filter(~F.col(a.name).isin(*a.one_of)))
    for c in resource.checks:
        scope = _on_rows(engine, resource, fresh)
        held = scope.condition(c.condition)
        rule(c.field, c.message, scope.df.filter(~held))
    if resource.write_policy is not None:
        scope = _on_rows(engine, resource, fresh)
        held = scope.condition(resource.write_policy)
        rule("", "is forbidden", scope.df.filter(~F.coalesce(held, F.lit(False))))
    keys = [Identity("primary_key", resource.primary_key)] if resource.primary_key else []
    for identity in [*keys, *resource.identities]:
        plain = all(resource.find("attr", k) for k in identity.keys) and identity.where is None
        if identity.name == settled or (plain and not meets(identity.keys)):
            continue
        names = [f"_k{i}" for i in range(len(identity.keys))]
        mine = _keys(engine, resource, fresh, identity, "_k").filter("_kok").select(*names)
        theirs = _keys(engine, resource, others, identity, "_k").filter("_kok").select(*names)
        again = mine.select(*[F.col(n).alias(f"_same{n}") for n in names])
        same = every([F.col(n).eqNullSafe(F.col(f"_same{n}")) for n in names])
        taken = theirs.join(again, same, "left_semi")
        twice = mine.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rule(identity.keys[0], "has already been taken", taken.unionByName(twice.select(*names)))
    for x in resource.exclusions:
        if meets([*x.keys, x.range]):
            rule(x.range, x.message, _overlaps(engine, resource, x, fresh, others))
    for r in resource.references:
        if meets([r.attribute]):
            given = fresh.filter(F.col(r.attribute).isNotNull()).select(F.col(r.attribute).alias("_given"))
            there = _table(engine, engine.domain[r.destination]).select(F.col(r.destination_attribute).alias("_there"))
            if r.destination == resource.name:
                there = there.unionByName(fresh.select(F.col(r.destination_attribute).alias("_there")))
            rule(r.attribute, "does not exist", given.join(there, F.col("_given") == F.col("_there"), "left_anti"))
    if found:
        broken = reduce(DataFrame.unionByName, found).collect()
        if broken:
            raise ConstraintError([errors[k] for k in sorted({row["rule"] for row in broken})])


def returning(engine: Engine, name: str, change: Change, *fields: str) -> DataFrame:
    """Attributes, calculations and aggregates of the changed rows, with _action."""
    scope = _on_rows(engine, engine.domain[name], change.changed)
    columns = [(f, scope.column(ref(f))) for f in fields]
    return scope.df.select(*[c.alias(f) for f, c in columns], ACTION)


def in_input_order(change: Change) -> DataFrame:
    """The changed rows numbered in the input's order, from 0.

    _ordinal holds the input's partition above its lowest 33 bits and the place in it below. The counts
    of the partitions, a row for each, give where each one's numbers begin; the rows aren't moved.
    """
    part = F.shiftrightunsigned(ORDINAL, 33)
    within = Window.partitionBy("_part").orderBy(ORDINAL)
    rows = change.changed.withColumn("_part", part)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    numbered = rows.withColumn("_at", F.row_number().over(within)).join(starts, "_part")
    return numbered.withColumn(ORDINAL, F.col("_start") + F.col("_at") - 1).select(*change.changed.columns)
