"""The registered queries: one for each operator of the engine, with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.expr import agg, arg, call, cond, exists, exists_any, fragment, if_, map_of, parent, ref
from tessera.operators.load import load_related, summarise_related
from tessera.operators.mutate import bulk_create, destroy_query, update_many, update_query, upsert
from tessera.plans.catalog import query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _add(name: str, resource: str, build, sql: str, rounded: str = "", **values) -> None:
    """rounded: columns of float sums and averages (with :places), whose last digits depend on the
    order of addition."""
    places = [(c.partition(":")[0], int(c.partition(":")[2] or 4)) for c in rounded.split()]

    def run(spark: SparkSession, folder: str) -> DataFrame:
        out = build(query(spark, folder, resource, **values))
        out = out if isinstance(out, DataFrame) else out.to_df()
        return out.withColumns({c: F.round(c, n) for c, n in places}) if places else out

    run.__name__ = name
    if places:
        sql = f"SELECT * REPLACE ({', '.join(f'round({c}, {n}) AS {c}' for c, n in places)}) FROM ({sql})"
    QUERIES[name], ORACLES[name] = run, sql


_add(
    "flagship_top_customers", "customer",
    lambda q: q.filter(ref("nation.region.r_name") == "ASIA").aggregate(orders_n=agg("count", "orders"), spent=agg("sum", "orders", "o_totalprice"))
    .sort("-orders_n", "c_custkey").limit(10).select("c_custkey", "c_name").calculate(),
    """SELECT c_custkey, c_name, count(o_orderkey) AS orders_n, sum(o_totalprice) AS spent
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN orders ON o_custkey = c_custkey
    WHERE r_name = 'ASIA' GROUP BY c_custkey, c_name ORDER BY orders_n DESC, c_custkey LIMIT 10""",
    rounded="spent",
)
_add("scan_select", "customer", lambda q: q.select("c_custkey", "c_name", "c_acctbal"), "SELECT c_custkey, c_name, c_acctbal FROM customer")
_add(
    "filter_bool", "customer",
    lambda q: q.filter(((ref("c_acctbal") > 0) & (ref("c_mktsegment") != "BUILDING")) | ~(ref("c_nationkey") <= 20)).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE (c_acctbal > 0 AND c_mktsegment <> 'BUILDING') OR NOT c_nationkey <= 20",
)
_add(
    "filter_in", "customer", lambda q: q.filter(ref("c_nationkey").in_([1, 5, 9]), ~ref("c_mktsegment").in_(["BUILDING"])).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 5, 9) AND c_mktsegment NOT IN ('BUILDING')",
)
_add(
    "filter_in_column", "customer", lambda q: q.filter(ref("c_nationkey").in_(call("list", 3, 4))).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_nationkey IN (3, 4)",
)
_add(
    "filter_like_ilike", "part", lambda q: q.filter(call("like", ref("p_type"), "%S%") | call("ilike", ref("p_name"), "%A%1")).select("p_partkey"),
    "SELECT p_partkey FROM part WHERE p_type LIKE '%S%' OR p_name ILIKE '%A%1'",
)
_add(
    "filter_is_nil", "document", lambda q: q.filter(ref("label.quality").is_nil()).select("doc_id"),
    "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NULL",
)
_add(
    "filter_to_one_path", "order", lambda q: q.filter(ref("customer.nation.region.r_name") == "EUROPE").select("o_orderkey"),
    """SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'""",
)
_add(
    "filter_to_many_semi", "customer", lambda q: q.filter((ref("orders.o_totalprice") > 250000) & (ref("orders.o_orderstatus") == "F")).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000 AND o_orderstatus = 'F')",
)
_add(
    "exists_nested", "customer",
    lambda q: q.filter(exists("orders", (ref("o_orderstatus") == "O") & exists("lineitems", ref("l_quantity") >= 49))).select("c_custkey"),
    """SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O'
    AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 49))""",
)
_add(
    "exists_path", "nation", lambda q: q.filter(exists("customers.orders", ref("o_totalprice") > 300000)).select("n_nationkey"),
    """SELECT n_nationkey FROM nation WHERE EXISTS (SELECT 1 FROM customer JOIN orders ON o_custkey = c_custkey
    WHERE c_nationkey = n_nationkey AND o_totalprice > 300000)""",
)
_add(
    "exists_aggregate_inside", "nation", lambda q: q.filter(exists("customers", ref("order_count") > 18)).select("n_nationkey"),
    "SELECT n_nationkey FROM nation WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) > 18)",
)
_add(
    "not_exists_anti", "customer", lambda q: q.filter(~exists("orders", ref("o_orderstatus") == "P")).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
)
_add(
    "exists_under_or", "customer", lambda q: q.filter(exists("orders", ref("o_totalprice") > 300000) | (ref("c_acctbal") < 0)).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)",
)
_add(
    "exists_parent", "customer", lambda q: q.filter(exists("orders", ref("o_totalprice") > parent(ref("c_acctbal") * 40))).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > c_acctbal * 40)",
)
_add(
    "exists_two_level_parent", "customer",
    lambda q: q.filter(exists("orders", exists("lineitems", ref("l_extendedprice") > parent(parent(ref("c_acctbal") * 9))))).select("c_custkey"),
    """SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND EXISTS
    (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_extendedprice > c_acctbal * 9))""",
)
_add(
    "exists_unrelated", "customer", lambda q: q.filter(exists_any("supplier", (ref("s_nationkey") == parent("c_nationkey")) & (ref("s_acctbal") > parent("c_acctbal")))).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > c_acctbal)",
)
_add(
    "exists_over_limited", "customer", lambda q: q.filter(exists("top_orders", ref("o_orderstatus") == "P")).select("c_custkey"),
    """SELECT DISTINCT o_custkey AS c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    WHERE rn <= 2 AND o_orderstatus = 'P' AND o_custkey IN (SELECT c_custkey FROM customer)""",
)
_add(
    "join_theta", "customer", lambda q: q.aggregate(n=agg("count", "similar_balance")).select("c_custkey"),
    """SELECT a.c_custkey, count(b.c_custkey) AS n FROM customer a LEFT JOIN customer b
    ON a.c_nationkey = b.c_nationkey AND b.c_acctbal > a.c_acctbal AND b.c_acctbal < a.c_acctbal + 100 GROUP BY a.c_custkey""",
)
_add(
    "join_manual", "customer", lambda q: q.aggregate(n=agg("count", "same_segment_order")).select("c_custkey"),
    """SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND c_mktsegment LIKE 'B%' AND o_orderstatus = 'F' GROUP BY c_custkey""",
)
_add(
    "m2m_load", "supplier", lambda q: load_related(q, "parts", query_of(q, "part").filter(ref("p_size") < 5).sort("p_partkey").select("p_partkey")),
    """SELECT __source_s_suppkey, p_partkey, row_number() OVER (PARTITION BY __source_s_suppkey ORDER BY p_partkey)::INT AS __order__
    FROM (SELECT DISTINCT s_suppkey AS __source_s_suppkey, p_partkey FROM supplier JOIN lineitem ON l_suppkey = s_suppkey JOIN part ON p_partkey = l_partkey WHERE p_size < 5)""",
)
_add(
    "through_three_hop", "region", lambda q: q.aggregate(n=agg("count", "orders"), total=agg("sum", "orders", "o_totalprice")).calculate().select("r_name"),
    """SELECT r_name, count(o_orderkey) AS n, sum(o_totalprice) AS total FROM region LEFT JOIN nation ON n_regionkey = r_regionkey
    LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY r_name""",
    rounded="total",
)
_add(
    "load_topn_per_parent", "customer", lambda q: load_related(q, "orders", query_of(q, "order").sort("-o_totalprice", "o_orderkey").limit(2).select("o_orderkey", "o_totalprice")),
    """SELECT o_custkey AS __source_c_custkey, o_orderkey, o_totalprice, rn::INT AS __order__ FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn <= 2""",
)
_add(
    "load_offset_per_parent", "customer", lambda q: load_related(q, "orders", query_of(q, "order").sort("o_orderdate", "o_orderkey").offset(1).limit(3).select("o_orderkey")),
    """SELECT o_custkey AS __source_c_custkey, o_orderkey, rn::INT AS __order__ FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn BETWEEN 2 AND 4""",
)
_add(
    "load_from_many_has_one", "customer", lambda q: load_related(q, "latest_order", query_of(q, "order").select("o_orderkey")),
    """SELECT o_custkey AS __source_c_custkey, o_orderkey, 1 AS __order__ FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders JOIN customer ON o_custkey = c_custkey) WHERE rn = 1""",
)
_add(
    "load_keyset_per_parent", "customer", lambda q: load_related(q, "orders", query_of(q, "order").sort("o_totalprice", "o_orderkey").after(150000.0, 0).limit(2).select("o_orderkey")),
    """SELECT o_custkey AS __source_c_custkey, o_orderkey, rn::INT AS __order__ FROM
    (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rn FROM orders JOIN customer ON o_custkey = c_custkey
     WHERE o_totalprice > 150000 OR (o_totalprice = 150000 AND o_orderkey > 0)) WHERE rn <= 2""",
)
_add(
    "load_with_aggregate", "customer", lambda q: load_related(q, "orders", query_of(q, "order").aggregate(lines=agg("count", "lineitems")).sort("o_orderkey").select("o_orderkey")),
    """SELECT o_custkey AS __source_c_custkey, o_orderkey, coalesce(n, 0) AS lines, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)::INT AS __order__
    FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
)
_add(
    "load_count_per_parent", "customer", lambda q: summarise_related(q, "orders", n=agg("count")),
    "SELECT c_custkey AS __source_c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)
_add(
    "load_lists_nested", "region",
    lambda q: q.load("nations", query_of(q, "nation").sort("n_name").select("n_name")).select("r_regionkey").to_df().select(
        "r_regionkey", F.array_join(F.transform("nations", lambda x: x["n_name"]), ",").alias("names")),
    "SELECT r_regionkey, coalesce(string_agg(n_name, ',' ORDER BY n_name), '') AS names FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey",
)
_add(
    "agg_count_sum_avg_min_max", "customer",
    lambda q: q.aggregate(n=agg("count", "orders"), s=agg("sum", "orders", "o_totalprice"), a=agg("avg", "orders", "o_totalprice"), lo=agg("min", "orders", "o_totalprice"), hi=agg("max", "orders", "o_totalprice")).select("c_custkey"),
    "SELECT c_custkey, count(o_orderkey) AS n, sum(o_totalprice) AS s, avg(o_totalprice) AS a, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
    rounded="s a:8",
)
_add(
    "agg_default", "customer", lambda q: q.aggregate(s=agg("sum", "orders", "o_totalprice", where=ref("o_totalprice") > 350000, default=0.0)).select("c_custkey"),
    "SELECT c_custkey, coalesce(sum(o_totalprice) FILTER (WHERE o_totalprice > 350000), 0) AS s FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
    rounded="s",
)
_add(
    "agg_count_uniq", "customer", lambda q: q.aggregate(n=agg("count", "orders", "o_orderpriority", uniq=True)).select("c_custkey"),
    "SELECT c_custkey, count(DISTINCT o_orderpriority) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)
_add(
    "agg_filtered", "customer",
    lambda q: q.aggregate(f=agg("count", "orders", where=ref("o_orderstatus") == "F"), o=agg("count", "orders", where=ref("o_orderstatus") == "O")).select("c_custkey"),
    "SELECT c_custkey, count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS f, count(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)
_add(
    "agg_first_sorted", "customer", lambda q: q.aggregate(first_priority=agg("first", "orders", "o_orderpriority", sort=("-o_totalprice", "o_orderkey"))).select("c_custkey"),
    """SELECT c_custkey, first_priority FROM customer LEFT JOIN (SELECT o_custkey, o_orderpriority AS first_priority,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) ON o_custkey = c_custkey AND rn = 1""",
)
_add(
    "agg_list_sorted", "customer", lambda q: q.aggregate(keys=agg("list", "orders", "o_orderkey", sort=("o_orderdate", "o_orderkey"))).select("c_custkey").to_df().withColumn("keys", F.array_join(F.col("keys").cast("array<string>"), ",")),
    "SELECT c_custkey, coalesce(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderdate, o_orderkey), '') AS keys FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)
_add(
    "agg_list_uniq", "customer", lambda q: q.aggregate(states=agg("list", "orders", "o_orderstatus", sort=("o_orderstatus",), uniq=True)).select("c_custkey").to_df().withColumn("states", F.array_join("states", ",")),
    "SELECT c_custkey, coalesce(string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus), '') AS states FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)
_add(
    "agg_exists", "customer", lambda q: q.aggregate(has_large=agg("exists", "large_orders")).select("c_custkey"),
    "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 50000) AS has_large FROM customer",
)
_add(
    "agg_custom_string_agg", "nation", lambda q: q.aggregate(names=agg("custom", "suppliers", "s_name", custom=lambda c: F.array_join(F.array_sort(F.collect_list(c)), ","))).select("n_nationkey"),
    "SELECT n_nationkey, string_agg(s_name, ',' ORDER BY s_name) AS names FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey",
)
_add(
    "agg_multi_hop", "nation", lambda q: q.aggregate(n=agg("count", "customers.orders.lineitems"), q=agg("sum", "customers.orders.lineitems", "l_quantity")).select("n_name"),
    """SELECT n_name, count(l_orderkey) AS n, sum(l_quantity) AS q FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY n_name""",
    rounded="q",
)
_add(
    "agg_over_limited_relationship", "customer", lambda q: q.aggregate(top_two=agg("sum", "top_orders", "o_totalprice")).select("c_custkey"),
    """SELECT c_custkey, sum(o_totalprice) AS top_two FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    ON o_custkey = c_custkey AND rn <= 2 GROUP BY c_custkey""",
    rounded="top_two",
)
_add(
    "agg_parent_filter", "customer", lambda q: q.aggregate(n=agg("count", "orders", where=ref("o_totalprice") > parent(ref("c_acctbal") * 20))).select("c_custkey"),
    "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 20 GROUP BY c_custkey",
)
_add(
    "agg_join_filter", "nation", lambda q: q.aggregate(n=agg("count", "customers.orders", join_filters=(("customers", ref("c_acctbal") > 0),))).select("n_nationkey"),
    "SELECT n_nationkey, count(o_orderkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 0 LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n_nationkey",
)
_add(
    "agg_nested", "nation", lambda q: q.aggregate(most=agg("max", "customers", ref("order_count")), total=agg("sum", "customers", ref("order_count"))).select("n_nationkey"),
    """SELECT n_nationkey, max(n) AS most, sum(n)::BIGINT AS total FROM nation LEFT JOIN (SELECT c_nationkey, c_custkey, count(o_orderkey) AS n
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL) ON c_nationkey = n_nationkey GROUP BY n_nationkey""",
)
_add(
    "agg_unrelated", "customer", lambda q: q.aggregate(
        n=agg("count", resource="supplier", where=ref("s_nationkey") == parent("c_nationkey")),
        richest=agg("max", of="s_acctbal", resource="supplier", where=(ref("s_nationkey") == parent("c_nationkey")) & (ref("s_acctbal") > parent("c_acctbal"))),
        every=agg("count", resource="supplier")).select("c_custkey"),
    """SELECT c_custkey, (SELECT count(*) FROM supplier WHERE s_nationkey = c_nationkey) AS n,
    (SELECT max(s_acctbal) FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal > c_acctbal) AS richest, (SELECT count(*) FROM supplier) AS every FROM customer""",
)
_add(
    "agg_m2m", "supplier", lambda q: q.aggregate(n=agg("count", "parts", "p_partkey", uniq=True)).select("s_suppkey"),
    "SELECT s_suppkey, count(DISTINCT p_partkey) AS n FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY s_suppkey",
)
_add(
    "agg_inline_in_expression", "customer", lambda q: q.calculate(share=agg("count", "orders", where=ref("o_orderstatus") == "F") * 100 / (agg("count", "orders") + 1)).select("c_custkey"),
    "SELECT c_custkey, count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') * 100 / (count(o_orderkey) + 1) AS share FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)
_add(
    "query_agg_grouped", "order", lambda q: q.filter(ref("o_totalprice") > 1000).summarise(
        n=agg("count"), total=agg("sum", of="o_totalprice"), f=agg("count", where=ref("o_orderstatus") == "F"), top=agg("max", of="o_totalprice"), none=agg("sum", of="o_totalprice", where=ref("o_orderkey") < 0, default=0.0)),
    "SELECT count(*) AS n, sum(o_totalprice) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, max(o_totalprice) AS top, 0.0::DOUBLE AS none FROM orders WHERE o_totalprice > 1000",
    rounded="total",
)
_add(
    "query_agg_limited", "order", lambda q: q.sort("-o_totalprice", "o_orderkey").limit(25).summarise(n=agg("count"), total=agg("sum", of="o_totalprice")),
    "SELECT count(*) AS n, sum(o_totalprice) AS total FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25)",
    rounded="total",
)
_add("count_with_page", "order", lambda q: q.filter(ref("o_orderstatus") == "P").count(), "SELECT count(*) AS count FROM orders WHERE o_orderstatus = 'P'")
_add(
    "sort_by_aggregate", "customer", lambda q: q.sort("-order_total", "c_custkey").limit(20).select("c_custkey", "order_total"),
    "SELECT c_custkey, sum(o_totalprice) AS order_total FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey ORDER BY order_total DESC NULLS FIRST, c_custkey LIMIT 20",
    rounded="order_total",
)
_add(
    "sort_by_path_expression", "customer", lambda q: q.sort(ref("nation.n_name"), (ref("c_acctbal") * -1, "desc_nils_last"), "c_custkey").offset(5).limit(30).select("c_custkey"),
    "SELECT c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey ORDER BY n_name, c_acctbal * -1 DESC NULLS LAST, c_custkey LIMIT 30 OFFSET 5",
)
_add(
    "distinct_on", "customer", lambda q: q.distinct("c_nationkey", "c_mktsegment").sort("c_custkey").select("c_custkey", "c_nationkey", "c_mktsegment"),
    "SELECT DISTINCT ON (c_nationkey, c_mktsegment) c_custkey, c_nationkey, c_mktsegment FROM customer ORDER BY c_nationkey, c_mktsegment, c_custkey",
)
_add(
    "distinct_sort", "customer", lambda q: q.distinct(ref("nation.region.r_name")).distinct_sort("-c_acctbal", "c_custkey").sort("c_custkey").limit(3).select("c_custkey", "c_acctbal"),
    """SELECT c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY c_acctbal DESC, c_custkey) AS rn
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) WHERE rn = 1 ORDER BY c_custkey LIMIT 3""",
)
_add(
    "keyset_page", "order", lambda q: q.sort("-o_orderpriority", "o_totalprice", "o_orderkey").after("3-MEDIUM", 100000.0, 0).limit(40).select("o_orderkey"),
    """SELECT o_orderkey FROM orders WHERE o_orderpriority < '3-MEDIUM' OR (o_orderpriority = '3-MEDIUM' AND (o_totalprice > 100000 OR (o_totalprice = 100000 AND o_orderkey > 0)))
    ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey LIMIT 40""",
)


def query_of(q, resource: str):
    """A query on another resource of the same engine."""
    from tessera.plans.query import Query

    return Query(q.engine, resource)


def _custom(q, low=None, high=None):
    q = q.select("c_custkey", "c_mktsegment")
    q = q.filter(ref("c_acctbal") > low) if low is not None else q
    return q.filter(ref("c_acctbal") < high) if high is not None else q


_C = "SELECT c_custkey, c_mktsegment FROM customer WHERE "
_add("combo_union_all", "customer", lambda q: _custom(q, 5000).union_all(_custom(q, 8000)), f"{_C} c_acctbal > 5000 UNION ALL {_C} c_acctbal > 8000")
_add("combo_union", "customer", lambda q: _custom(q, 5000).union(_custom(q, high=0)), f"{_C} c_acctbal > 5000 UNION {_C} c_acctbal < 0")
_add("combo_intersect", "customer", lambda q: _custom(q, 2000).intersect(_custom(q, high=7000)), f"{_C} c_acctbal > 2000 INTERSECT {_C} c_acctbal < 7000")
_add("combo_except", "customer", lambda q: _custom(q, 2000).except_(_custom(q, 7000)), f"{_C} c_acctbal > 2000 EXCEPT {_C} c_acctbal > 7000")
_add(
    "combo_left_assoc", "customer", lambda q: _custom(q, 8000).union(_custom(q, high=1000)).intersect(_custom(q, high=9000)).except_(_custom(q, high=0)),
    f"(({_C} c_acctbal > 8000 UNION {_C} c_acctbal < 1000) INTERSECT {_C} c_acctbal < 9000) EXCEPT {_C} c_acctbal < 0",
)
_add(
    "combo_part_limits", "customer", lambda q: q.sort("-c_acctbal", "c_custkey").limit(5).select("c_custkey").union_all(q.sort("c_acctbal", "c_custkey").limit(5).select("c_custkey")).sort("c_custkey").limit(7),
    """SELECT c_custkey FROM ((SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5) UNION ALL
    (SELECT c_custkey FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5)) ORDER BY c_custkey LIMIT 7""",
)
_add(
    "combo_calc_fields", "customer",
    lambda q: q.filter(ref("c_acctbal") > 9000).calculate(grade=if_(ref("c_custkey") > 0, 2)).select("c_custkey").union(q.filter(ref("c_acctbal") < -500).calculate(grade=if_(ref("c_custkey") > 0, 1)).select("c_custkey"))
    .filter(ref("c_mktsegment") != "BUILDING").calculate(twice=ref("grade") * 2).sort("-grade", "c_custkey").limit(50).select("c_custkey", "grade"),
    """SELECT c_custkey, grade, grade * 2 AS twice FROM (SELECT c_custkey, 2 AS grade FROM customer WHERE c_acctbal > 9000 UNION SELECT c_custkey, 1 FROM customer WHERE c_acctbal < -500)
    JOIN customer USING (c_custkey) WHERE c_mktsegment <> 'BUILDING' ORDER BY grade DESC, c_custkey LIMIT 50""",
)
_add(
    "calc_case_cond", "customer", lambda q: q.calculate(
        grade=cond((ref("c_acctbal") < 0, "debt"), (ref("c_acctbal") < 5000, "mid"), otherwise="high"), yes=if_(ref("c_nationkey") > 10, 1, 0)).select("c_custkey"),
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS grade, CASE WHEN c_nationkey > 10 THEN 1 ELSE 0 END AS yes FROM customer",
)
_add(
    "calc_string_fns", "customer", lambda q: q.calculate(
        pos=call("string_position", ref("c_name"), "0"), size=call("string_length", ref("c_name")), parts=call("length", call("string_split", ref("c_name"), separator="#")),
        joined=call("string_join", ref("c_name"), ref("c_mktsegment"), sep="-"), head=call("starts_with", ref("c_mktsegment"), "B"), second=call("at", call("string_split", ref("c_name"), separator="#"), 1),
        has=call("contains", ref("c_name"), "_")).select("c_custkey", "name_and_segment"),
    """SELECT c_custkey, c_name || ' / ' || c_mktsegment AS name_and_segment, nullif(instr(c_name, '0'), 0)::INT - 1 AS pos, length(c_name)::INT AS size,
    len(string_split(c_name, '#'))::INT AS parts, c_name || '-' || c_mktsegment AS joined, starts_with(c_mktsegment, 'B') AS head, string_split(c_name, '#')[2] AS second, contains(c_name, '_') AS has FROM customer""",
)
_add(
    "calc_arguments", "customer", lambda q: q.calculate(above=ref("balance_above", than=2500.0), over=ref("c_acctbal") > arg("limit")).select("c_custkey"),
    "SELECT c_custkey, c_acctbal > 2500 AS above, c_acctbal > 4000 AS over FROM customer", arguments={"limit": 4000.0},
)
_add(
    "calc_fragment", "customer", lambda q: q.calculate(x=fragment("pmod(?, 7) + length(?)", ref("c_custkey"), ref("c_mktsegment"))).select("c_custkey"),
    "SELECT c_custkey, c_custkey % 7 + length(c_mktsegment) AS x FROM customer",
)
_add(
    "calc_temporal", "order", lambda q: q.calculate(
        later=call("datetime_add", ref("o_orderdate"), 1, unit="month"), before=call("datetime_sub", ref("o_orderdate"), days=3, hours=2)).select("o_orderkey"),
    "SELECT o_orderkey, o_orderdate + INTERVAL 1 MONTH AS later, o_orderdate - INTERVAL 3 DAY - INTERVAL 2 HOUR AS before FROM orders",
)
_add(
    "calc_round_rem_div", "lineitem", lambda q: q.calculate(
        r=call("round", call("type", ref("l_extendedprice"), to="decimal(18,4)"), places=1), m=ref("l_orderkey") % 7, d=call("idiv", ref("l_orderkey"), 3), neg=-ref("l_linenumber")).select("l_orderkey", "l_linenumber"),
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice::DECIMAL(18,4), 1) AS r, l_orderkey % 7 AS m, l_orderkey // 3 AS d, -l_linenumber AS neg FROM lineitem",
)
_add(
    "calc_or_and", "document", lambda q: q.calculate(
        q=call("or_else", ref("label.quality"), 9), t=call("and_then", ref("label.quality"), ref("label.toxic"))).select("doc_id"),
    "SELECT d.doc_id, coalesce(quality, 9) AS q, CASE WHEN quality IS NOT NULL THEN toxic END AS t FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
_add(
    "calc_map", "customer", lambda q: q.calculate(m=map_of(a=ref("c_custkey"), b=map_of(n=agg("count", "orders")))).select("c_custkey").to_df().select("c_custkey", F.col("m.a").alias("a"), F.col("m.b.n").alias("n")),
    "SELECT c_custkey, c_custkey AS a, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)
_add(
    "json_get_path", "event", lambda q: q.calculate(k=call("json_path", ref("props"), path="$.k", to="int")).filter(ref("value") > 0).select("event_id"),
    "SELECT event_id, (props::JSON ->> '$.k')::INT AS k FROM events WHERE value > 0",
)
_span = lambda days: call("range", ref("o_orderdate"), call("datetime_add", ref("o_orderdate"), days))
_add(
    "range_predicates", "order", lambda q: q.calculate(
        o=call("range_overlaps", _span(30), call("range", call("type", "1997-01-01", to="timestamp_ntz"), call("type", "1997-02-01", to="timestamp_ntz"))),
        c=call("range_contains", _span(30), call("type", "1997-01-01", to="timestamp_ntz")),
        a=call("range_adjacent", _span(5), call("range", call("datetime_add", ref("o_orderdate"), 2 + ref("o_orderkey") % 7), call("datetime_add", ref("o_orderdate"), 30)))).select("o_orderkey"),
    """SELECT o_orderkey, o_orderdate < TIMESTAMP '1997-02-01' AND o_orderdate + INTERVAL 30 DAY > TIMESTAMP '1997-01-01' AS o,
    o_orderdate <= TIMESTAMP '1997-01-01' AND o_orderdate + INTERVAL 30 DAY > TIMESTAMP '1997-01-01' AS c, o_orderkey % 7 = 3 AS a FROM orders""",
)
_grams = "list_distinct(flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
_add(
    "trigram_similarity", "part", lambda q: q.calculate(s=call("trigram_similarity", ref("p_name"), ref("p_type"))).select("p_partkey"),
    f"""SELECT p_partkey, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) AS s
    FROM (SELECT p_partkey, {_grams.format('p_name')} AS a, {_grams.format('p_type')} AS b FROM part)""",
)
_probe = [((i * 37) % 64 - 32) / 64 for i in range(64)]
_literal = "[" + ", ".join(f"{x}::DOUBLE" for x in _probe) + "]"
_add(
    "vector_cosine", "embedding", lambda q: q.calculate(d=call("round", call("vector_cosine_distance", ref("embedding"), _probe), places=9)).select("vec_id"),
    f"SELECT vec_id, round(1 - list_cosine_similarity(embedding::DOUBLE[], {_literal}), 9) AS d FROM embeddings",
)
_add(
    "vector_l2_topk", "embedding", lambda q: q.calculate(d=call("round", call("vector_l2_distance", ref("embedding"), _probe), places=9)).sort("d", "vec_id").limit(10).select("vec_id"),
    f"SELECT vec_id, round(list_distance(embedding::DOUBLE[], {_literal}), 9) AS d FROM embeddings ORDER BY d, vec_id LIMIT 10",
)


def _loaded(q, resource: str) -> DataFrame:
    return query_of(q, resource).to_df()


def _incoming(q) -> DataFrame:
    """Customers to merge: every third one with another balance, and as many new ones."""
    rows = _loaded(q, "customer").filter("c_custkey % 3 = 0")
    old = rows.withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return old.unionByName(rows.withColumn("c_custkey", F.col("c_custkey") + 1000000).withColumn("c_name", F.concat("c_name", F.lit("+"))))


def _upserted(q):
    return upsert(q.engine, "customer", _incoming(q), fields=("c_acctbal",), condition=lambda old, new: old("c_acctbal") > 0)


_S = "SELECT c_custkey, c_acctbal + CASE WHEN c_custkey % 3 = 0 AND c_acctbal > 0 THEN 1 ELSE 0 END AS c_acctbal FROM customer"
_add(
    "merge_upsert", "customer", lambda q: _upserted(q).rows.select("c_custkey", "c_acctbal"),
    f"{_S} UNION ALL SELECT c_custkey + 1000000, c_acctbal FROM customer WHERE c_custkey % 3 = 0",
)
_add(
    "merge_actions", "customer", lambda q: _upserted(q).changed.select("c_custkey", "_action"),
    """SELECT c_custkey, 'update' AS _action FROM customer WHERE c_custkey % 3 = 0 AND c_acctbal > 0
    UNION ALL SELECT c_custkey + 1000000, 'insert' FROM customer WHERE c_custkey % 3 = 0""",
)
_add(
    "bulk_create", "region",
    lambda q: bulk_create(q.engine, "region", _loaded(q, "region").select((F.col("r_regionkey") + 100).alias("r_regionkey")), {"r_name": call("concat", "region ", call("type", ref("r_regionkey"), to="string"))}).rows,
    "SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey + 100, 'region ' || (r_regionkey + 100) FROM region",
)
_add(
    "update_many_presence", "customer",
    lambda q: update_many(q.engine, "customer", _loaded(q, "customer").filter("c_custkey % 5 = 0").select("c_custkey", F.lit(None).cast("string").alias("c_name"), (F.col("c_acctbal") * 2).alias("c_acctbal"), (F.col("c_custkey") % 2 == 0).alias("has_name")), {"c_name": "has_name"}).rows.select("c_custkey", "c_name", "c_acctbal"),
    """SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS c_name, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal FROM customer""",
)
_add(
    "update_query", "order", lambda q: update_query(q.filter(ref("o_orderstatus") == "F"), {"o_totalprice": ref("o_totalprice") - 1, "o_orderpriority": ref("customer.c_mktsegment")}).rows.select("o_orderkey", "o_totalprice", "o_orderpriority"),
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderstatus = 'F' THEN c_mktsegment ELSE o_orderpriority END AS o_orderpriority FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
_add(
    "update_limited", "customer", lambda q: update_query(q.filter(exists("orders")).sort("-c_acctbal", "c_custkey").limit(10), {"c_acctbal": ref("c_acctbal") - 100}).changed.select("c_custkey", "c_acctbal"),
    "SELECT c_custkey, c_acctbal - 100 AS c_acctbal FROM (SELECT * FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) ORDER BY c_acctbal DESC, c_custkey LIMIT 10)",
)
_add(
    "destroy_query", "customer", lambda q: destroy_query(q.filter(~exists("orders", ref("o_orderstatus") == "F"))).rows.select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')",
)
