"""Registered queries cover all rows: small tables with keys of any size, against brute force."""

import random
from collections import Counter

import pytest

from tessera.plans.catalog_queries import QUERIES

#: The other columns of the driver's tables.
UNUSED = {
    "orders": ("timestamp_ntz'2020-01-01' AS o_orderdate", "'1' AS o_orderpriority"),
    "lineitem": (
        *[f"0L AS l_{c}" for c in ("partkey", "suppkey")],
        *[f"0D AS l_{c}" for c in ("quantity", "extendedprice", "discount", "tax")],
        *[f"'x' AS l_{c}" for c in ("returnflag", "linestatus")],
        "timestamp_ntz'2020-01-01' AS l_shipdate",
    ),
}


@pytest.fixture(scope="module")
def tables():
    r = random.Random(3)
    customers = [(k, f"c{k}", r.randrange(3), float(r.randrange(500)), "BUILDING") for k in (1, 2, 150, 199, 200, 201, 1499, 1500, 1501, 1502, 14999, 10**9, 2**40)]
    keys = [c[0] for c in customers]
    orders = [(k, r.choice(keys[:-1]), "F", 1.0) for k in range(60)]
    lines = [(r.randrange(50), n) for n in range(200)]
    return customers, orders, lines


@pytest.fixture(scope="module")
def folder(spark, tables, tmp_path_factory):
    to = tmp_path_factory.mktemp("tables")
    schemas = {
        "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double",
        "lineitem": "l_orderkey long, l_linenumber int",
    }
    for (name, schema), rows in zip(schemas.items(), tables, strict=True):
        spark.createDataFrame(rows, schema).selectExpr("*", *UNUSED.get(name, ())).write.parquet(f"{to}/{name}.parquet")
    return str(to)


def test_theta_join_covers_all_customers(spark, folder, tables):
    customers = tables[0]
    want = {a[0]: sum(a[2] == b[2] and a[3] < b[3] < a[3] + 100 for b in customers) for a in customers}
    got = QUERIES["join_theta"](spark, folder).collect()
    assert len(got) == len(customers) and {x.c_custkey: x.n for x in got} == want and any(want[k] for k in want if k > 1500)


def test_load_with_aggregate_covers_all_customers(spark, folder, tables):
    _, orders, lines = tables
    count = Counter(k for k, _ in lines)
    want = set()
    for customer in {o[1] for o in orders}:
        own = sorted(o[0] for o in orders if o[1] == customer)
        want |= {(customer, k, count[k], at) for at, k in enumerate(own, 1)}
    got = [(x["__source_c_custkey"], x.o_orderkey, x.lines, x["__order__"]) for x in QUERIES["load_with_aggregate"](spark, folder).collect()]
    assert len(got) == len(orders) and set(got) == want and any(k >= 200 for k, *_ in got)
