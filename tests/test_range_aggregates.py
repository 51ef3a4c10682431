"""Aggregates over related rows that limits of the parent bound: brute force, and no pair of rows in the plan."""

import itertools
import operator
import random

import pytest
from pyspark.sql import functions as F

from tessera.expr import agg, parent, ref
from tessera.plans.catalog_queries import QUERIES
from tessera.plans.feature_queries import QUERIES as FEATURES
from tessera.plans.query import Query
from tessera.schema import Attribute, Domain, Relationship, Resource
from tessera.sources.engine import Engine

OPS = {"lt": operator.lt, "le": operator.le, "gt": operator.gt, "ge": operator.ge}
NAN = float("nan")


def attributes(*names):
    return tuple(Attribute(n, "integer" if n in ("id", "g", "w") else "float", primary_key=n == "id") for n in names)


def place(x):
    """Nulls aside, the order in which values are compared: NaN is the largest."""
    return (1, 0.0) if x != x else (0, float(x))


def meets(op, a, b):
    return a is not None and b is not None and OPS[op](place(a), place(b))


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(8)
    number = lambda: r.choice([None, NAN, 0.0, -0.0, -1.5, float("inf"), float("-inf"), *[float(r.randrange(12))] * 8])
    parents = [(k, r.choice([None, 1, 2, 3, 4]), number(), number()) for k in range(120)]
    rows = [(k, r.choice([None, 1, 2, 3]), number(), r.choice([None, 1, 5, 9])) for k in range(150)]
    frames = {
        "p": spark.createDataFrame(parents, "id long, g int, lo double, hi double"),
        "c": spark.createDataFrame(rows, "id long, g int, x double, w long"),
    }
    return parents, rows, frames


def query(spark, frames, condition):
    bounded = Relationship("near", "has_many", "c", "id", "id", no_attributes=True, filter=condition)
    domain = Domain((Resource("p", attributes("id", "g", "lo", "hi"), table="p", relationships=(bounded,)), Resource("c", attributes("id", "g", "x", "w"), table="c")))
    return Query(Engine(spark, domain, {"default": lambda table, tenant: frames[table]}), "p")


@pytest.mark.parametrize("low, high, keyed", [*itertools.product(("gt", "ge"), ("lt", "le"), (True, False)), *[(o, None, k) for o in OPS for k in (True, False)]])
def test_against_all_pairs(spark, tables, low, high, keyed):
    parents, rows, frames = tables
    condition = OPS[low](ref("x"), parent("lo"))
    if high:
        condition = condition & OPS[high](ref("x"), parent("hi"))
    if keyed:
        condition = condition & (ref("g") == parent("g"))
    wanted = {"n": agg("count", "near"), "of": agg("count", "near", "w"), "some": agg("count", "near", where=ref("w") > 4), "e": agg("exists", "near")}
    if not high:
        wanted |= {"least": agg("min", "near", "w"), "most": agg("max", "near", "w", where=ref("w") < 9), "mean": agg("avg", "near", ref("w") * 1.0), "sum": agg("sum", "near", ref("w") * 1.0)}
    df = query(spark, frames, condition).aggregate(**wanted).select("id").to_df()
    got = {r.id: r.asDict() for r in df.collect()}
    assert len(got) == len(parents)
    for k, g, lo, hi in parents:
        near = [w for _, h, x, w in rows if meets(low, x, lo) and (not high or meets(high, x, hi)) and (not keyed or (g is not None and g == h))]
        known = [w for w in near if w is not None]
        want = {"id": k, "n": len(near), "of": len(known), "some": sum(w > 4 for w in known), "e": bool(near)}
        if not high:
            few = [w for w in known if w < 9]
            want |= {"least": min(known, default=None), "most": max(few, default=None)}
            want |= {"mean": sum(known) / len(known) if known else None, "sum": float(sum(known)) if known else None}
        assert got[k] == pytest.approx(want), (k, g, lo, hi)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and (" > " in line or " < " in line or ">= " in line or "<= " in line)]


def test_limits_of_several_values_still_join(spark, tables):
    parents, rows, frames = tables
    q = query(spark, frames, (ref("x") > parent("lo")) & (ref("w") < parent("hi")))
    got = {r.id: r.n for r in q.aggregate(n=agg("count", "near")).select("id").to_df().collect()}
    assert got == {k: sum(meets("gt", x, lo) and meets("lt", w, hi) for _, _, x, w in rows) for k, _, lo, hi in parents}


@pytest.mark.parametrize("name", ["join_theta", "agg_unrelated"])
def test_registered_queries_make_no_pairs(spark, tmp_path, name):
    """All in one nation: the pairs of 6,000 customers, or of them and 6,000 suppliers, are 36 million."""
    n = 6000
    customers = spark.range(n).selectExpr("id AS c_custkey", "'c' AS c_name", "1 AS c_nationkey", "id * 10.0D AS c_acctbal", "'B' AS c_mktsegment")
    suppliers = spark.range(n).selectExpr("id AS s_suppkey", "'s' AS s_name", "1 AS s_nationkey", "id * 10.0D AS s_acctbal")
    customers.write.parquet(f"{tmp_path}/customer.parquet")
    suppliers.write.parquet(f"{tmp_path}/supplier.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    got = {r.c_custkey: r for r in df.collect()}
    if name == "join_theta":
        assert {k: r.n for k, r in got.items()} == {k: min(9, n - 1 - k) for k in range(n)}
    else:
        assert all((r.n, r.richest, r.every) == (n, 10.0 * (n - 1) if k < n - 1 else None, n) for k, r in got.items()) and len(got) == n
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and (" > " in line or " < " in line)]


def test_unrelated_lists_are_made_once_for_each_group(spark, tmp_path):
    """One join for all kinds of aggregates of the same rows, and the list's text below it."""
    r = random.Random(5)
    customers = [(k, "c", r.randrange(5), 1.0, "B") for k in range(300)]
    suppliers = [(k, f"s{k}", r.randrange(4), float(r.randrange(90))) for k in range(200)]
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    df = FEATURES["agg_unrelated_kinds"](spark, str(tmp_path))
    got = {x.c_custkey: x for x in df.collect()}
    assert len(got) == len(customers) and any(c[2] == 4 for c in customers)
    for k, _, nation, *_ in customers:
        of, x = [s for s in suppliers if s[2] == nation], got[k]
        assert (x.n, x.e, x.f, x.xs) == (len(of), bool(of), of[0][1] if of else None, ",".join(str(s[0]) for s in reversed(of)))
        money = [s[3] for s in of]
        assert (x.s, x.lo, x.hi) == ((sum(money), min(money), max(money)) if of else (None, None, None))
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join " in line]
    assert len(joins) == 1 and [i for i, line in enumerate(plan) if "array_join" in line] and all(i > joins[0] for i, line in enumerate(plan) if "array_join" in line)


def test_a_function_of_a_list_sees_empty_ones(spark, tables):
    parents, rows, frames = tables
    q = query(spark, frames, ref("g") == parent("g"))
    got = {x.id: (x.n, x.few) for x in q.aggregate(n=agg("list", "near", "w", then=F.size), few=agg("list", "near", "w", where=ref("w") > 4, then=F.size)).select("id").to_df().collect()}
    near = {k: [w for _, h, _, w in rows if g is not None and h == g and w is not None] for k, g, *_ in parents}
    assert got == {k: (len(ws), sum(w > 4 for w in ws)) for k, ws in near.items()}
