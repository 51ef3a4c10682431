"""Further registered queries: operators whose resources need more than the driver's plain tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.expr import actor, agg, call, cond, context, exists, fragment, if_, map_of, parent, ref, tenant
from tessera.functions.ranges import make
from tessera.functions.registry import register
from tessera.operators.load import load_related, summarise_related
from tessera.operators.mutate import bulk_create, cascade, create, destroy, destroy_query, in_input_order, optimistic, returning, update, update_many, update_query, upsert
from tessera.plans.catalog import DOMAIN
from tessera.plans.catalog_queries import ORACLES, QUERIES, _add, query_of
from tessera.plans.query import Query
from tessera.schema import Attribute, Calculation, Check, Domain, Exclusion, Identity, Reference, Relationship, Resource

A = Attribute


def _having(q: Query, name: str, **changes) -> Query:
    """The query with one resource declared otherwise."""
    resources = tuple(replace(r, _index={}, **changes) if r.name == name else r for r in q.engine.domain.resources)
    return replace(q, engine=q.engine.with_values(domain=Domain(resources)))


def _more(q: Query, name: str, **extra) -> Query:
    """The query with relationships, calculations and the like added to one resource."""
    return _having(q, name, **{k: getattr(q.engine.domain[name], k) + v for k, v in extra.items()})


def _on(q: Query, resource: Resource, df: DataFrame) -> Query:
    """A query on a resource over derived rows."""
    repos = {**q.engine.repos, "default": lambda table, tenant: df if table == resource.table else q.engine.repos["default"](table, tenant)}
    return Query(q.engine.with_values(domain=Domain((*q.engine.domain.resources, resource)), repos=repos), resource.name)


def _rows(q: Query, name: str) -> DataFrame:
    return query_of(q, name).to_df()


# -- filters ---------------------------------------------------------------------------------------

_add(
    "filter_at_path", "customer",
    lambda q: q.filter((ref("orders.o_orderstatus") == "F") & exists("lineitems", ref("l_quantity") >= 50, at="orders")).select("c_custkey"),
    """SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'
    AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 50))""",
)
_add(
    "filter_nested_siblings", "nation",
    lambda q: q.filter(ref("customers.c_acctbal") < 0, ref("customers.orders.o_orderstatus") == "P", ref("customers.orders.o_totalprice") > 100000).select("n_nationkey"),
    """SELECT n_nationkey FROM nation WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal < 0 AND EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P' AND o_totalprice > 100000))""",
)
_add(
    "filter_to_many_or_own", "customer", lambda q: q.filter((ref("orders.o_totalprice") > 400000) | (ref("c_acctbal") < 0)).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
_add(
    "filter_is_nil_relationship", "document", lambda q: q.filter(ref("label").is_nil() | (ref("label.toxic") == 1)).select("doc_id"),
    "SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.toxic = 1",
)
_add(
    "base_filter", "customer", lambda q: _having(q, "order", base_filter=ref("o_orderstatus") != "F").filter(exists("orders", ref("o_totalprice") > 250000))
    .aggregate(n=agg("count", "orders")).select("c_custkey"),
    """SELECT c_custkey, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus <> 'F' GROUP BY c_custkey HAVING max(o_totalprice) > 250000""",
)
_add(
    "read_policy", "order", lambda q: _having(q, "order", read_policy=ref("customer.c_nationkey") == actor("nation")).filter(ref("o_totalprice") > context("least")).select("o_orderkey"),
    "SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7 AND o_totalprice > 100000",
    actor={"nation": 7}, context={"least": 100000},
)
_add(
    "filter_json_list", "event",
    lambda q: q.filter(call("json_list_has", call("concat", '{"tags": ["', ref("event_type"), '", "x"]}'), "click", path="$.tags")).select("event_id"),
    "SELECT event_id FROM events WHERE event_type = 'click'",
)
_add(
    "filter_intersects", "customer", lambda q: q.filter(call("intersects", call("list", ref("c_nationkey"), 100), call("list", 3, 4, 5))).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_nationkey IN (3, 4, 5)",
)
_add(
    "filter_fragment_and_required", "customer",
    lambda q: q.filter(fragment("? BETWEEN ? AND ?", ref("c_acctbal"), 0, 1000)).calculate(s=call("required", ref("c_mktsegment"), name="segment"), e=if_(ref("c_custkey") < 0, call("error", "negative"), ref("c_custkey"))).select("c_custkey"),
    "SELECT c_custkey, c_mktsegment AS s, c_custkey AS e FROM customer WHERE c_acctbal BETWEEN 0 AND 1000",
)
_add(
    "calc_binding", "nation", lambda q: q.calculate(b=call("binding")).select("n_nationkey").to_df().select("n_nationkey", F.col("b.n_name").alias("name")),
    "SELECT n_nationkey, n_name AS name FROM nation",
)

# -- relationships and loads --------------------------------------------------------------------------

_manual = Relationship("best_f", "has_many", "order", "c_custkey", "o_custkey", sort=("-o_totalprice", "o_orderkey"), limit=2,
                       manual=lambda s, d: (s("c_custkey") == d("o_custkey")) & (d("o_orderstatus") == "F"))
_add(
    "manual_limited", "customer", lambda q: _more(q, "customer", relationships=(_manual,)).aggregate(n=agg("count", "best_f"), top=agg("sum", "best_f", "o_totalprice")).select("c_custkey"),
    """SELECT c_custkey, count(o_totalprice) AS n, sum(o_totalprice) AS top FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
    FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey AND rn <= 2 GROUP BY c_custkey""",
    rounded="top",
)
_second = Relationship("second_orders", "has_many", "order", "c_custkey", "o_custkey", sort=("o_orderdate", "o_orderkey"), limit=2, offset=1)
_add(
    "relationship_offset", "customer", lambda q: load_related(_more(q, "customer", relationships=(_second,)), "second_orders").select("__source_c_custkey", "o_orderkey", "__order__"),
    """SELECT o_custkey AS __source_c_custkey, o_orderkey, (rn - 1)::INT AS __order__ FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)) WHERE rn IN (2, 3)""",
)
_add(
    "load_nested_pages", "nation",
    lambda q: q.load("customers", query_of(q, "customer").sort("-c_acctbal", "c_custkey").limit(3).select("c_custkey")
                     .load("orders", query_of(q, "order").sort("o_orderkey").offset(1).limit(2).select("o_orderkey"))).select("n_nationkey").to_df()
    .select("n_nationkey", F.array_join(F.transform("customers", lambda c: F.concat(c["c_custkey"], F.lit(":"), F.array_join(F.transform(c["orders"], lambda o: o["o_orderkey"]), ","))), ";").alias("tree")),
    """WITH c AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer),
    o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders),
    l AS (SELECT c_nationkey, c.rn, c_custkey || ':' || coalesce(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o.rn), '') AS t FROM c LEFT JOIN o ON o_custkey = c_custkey AND o.rn IN (2, 3) WHERE c.rn <= 3 GROUP BY c_nationkey, c.rn, c_custkey)
    SELECT n_nationkey, coalesce(string_agg(t, ';' ORDER BY rn), '') AS tree FROM nation LEFT JOIN l ON c_nationkey = n_nationkey GROUP BY n_nationkey""",
)
_add(
    "load_of_chosen_parents", "customer",
    lambda q: load_related(q.filter(ref("c_mktsegment") == "BUILDING").sort("-c_acctbal", "c_custkey").limit(50), "orders", query_of(q, "order").aggregate(lines=agg("count", "lineitems")).sort("-o_totalprice", "o_orderkey").limit(1).select("o_orderkey")),
    """WITH p AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 50),
    o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders JOIN p ON o_custkey = c_custkey)
    SELECT o_custkey AS __source_c_custkey, o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS lines, 1 AS __order__ FROM o WHERE rn = 1""",
)
_add(
    "summary_of_limited_load", "customer", lambda q: summarise_related(q, "orders", query_of(q, "order").sort("-o_totalprice", "o_orderkey").limit(3), n=agg("count"), low=agg("min", "", "o_totalprice")),
    """SELECT c_custkey AS __source_c_custkey, count(o_orderkey) AS n, min(o_totalprice) AS low FROM customer LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    ON o_custkey = c_custkey AND rn <= 3 GROUP BY c_custkey""",
)
_link = Relationship("some_lines", "has_many", "lineitem", "s_suppkey", "l_suppkey", filter=ref("l_quantity") >= 49)
_add(
    "m2m_join_relationship", "supplier",
    lambda q: load_related(_more(q, "supplier", relationships=(_link, Relationship("big_parts", "many_to_many", "part", "s_suppkey", "p_partkey", through=("lineitem", "l_suppkey", "l_partkey"), join_relationship="some_lines"))),
                           "big_parts", query_of(q, "part").sort("p_partkey").select("p_partkey")),
    """SELECT s AS __source_s_suppkey, p_partkey, row_number() OVER (PARTITION BY s ORDER BY p_partkey)::INT AS __order__ FROM
    (SELECT DISTINCT s_suppkey AS s, p_partkey FROM supplier JOIN lineitem ON l_suppkey = s_suppkey AND l_quantity >= 49 JOIN part ON p_partkey = l_partkey)""",
)

# -- aggregates ---------------------------------------------------------------------------------------

_maybe = cond((ref("o_totalprice") > 150000, ref("o_orderpriority")))
_add(
    "agg_first_include_nil", "customer",
    lambda q: q.aggregate(a=agg("first", "orders", _maybe, sort=("o_orderkey",)), b=agg("first", "orders", _maybe, sort=("o_orderkey",), include_nil=True)).select("c_custkey"),
    """SELECT c_custkey, arg_min(o_orderpriority, o_orderkey) FILTER (WHERE o_totalprice > 150000) AS a,
    first(CASE WHEN o_totalprice > 150000 THEN o_orderpriority END ORDER BY o_orderkey) AS b FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
_add(
    "agg_list_include_nil", "customer", lambda q: q.aggregate(xs=agg("list", "orders", _maybe, sort=("o_orderkey",), include_nil=True)).calculate(n=call("count_nils", agg("list", "orders", _maybe, sort=("o_orderkey",), include_nil=True)))
    .select("c_custkey").to_df().select("c_custkey", "n", F.array_join("xs", ",", "-").alias("xs")),
    """SELECT c_custkey, count(o_orderkey) FILTER (WHERE o_totalprice <= 150000)::INT AS n, coalesce(string_agg(CASE WHEN o_totalprice > 150000 THEN o_orderpriority ELSE '-' END, ',' ORDER BY o_orderkey) FILTER (WHERE o_orderkey IS NOT NULL), '') AS xs
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
)
_add(
    "agg_avg_uniq", "customer", lambda q: q.aggregate(a=agg("avg", "orders.lineitems", "l_quantity", uniq=True), s=agg("sum", "orders.lineitems", "l_quantity", uniq=True)).select("c_custkey"),
    """SELECT c_custkey, avg(DISTINCT l_quantity) AS a, sum(DISTINCT l_quantity) AS s FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY c_custkey""",
    rounded="a s",
)
_same = ref("s_nationkey") == parent("c_nationkey")
_add(
    "agg_unrelated_kinds", "customer",
    lambda q: q.aggregate(
        n=agg("count", where=_same, resource="supplier"), s=agg("sum", of="s_acctbal", where=_same, resource="supplier"), a=agg("avg", of="s_acctbal", where=_same, resource="supplier"),
        lo=agg("min", of="s_acctbal", where=_same, resource="supplier"), hi=agg("max", of="s_acctbal", where=_same, resource="supplier"), e=agg("exists", where=_same, resource="supplier"),
        f=agg("first", of="s_name", where=_same, resource="supplier", sort=("s_suppkey",)), xs=agg("list", of="s_suppkey", where=_same, resource="supplier", sort=("-s_suppkey",), then=lambda xs: F.array_join(xs, ","))).select("c_custkey"),
    """SELECT c_custkey, count(s_suppkey) AS n, sum(s_acctbal) AS s, avg(s_acctbal) AS a, min(s_acctbal) AS lo, max(s_acctbal) AS hi, count(s_suppkey) > 0 AS e, arg_min(s_name, s_suppkey) AS f,
    coalesce(string_agg(s_suppkey::VARCHAR, ',' ORDER BY s_suppkey DESC), '') AS xs FROM customer LEFT JOIN supplier ON s_nationkey = c_nationkey GROUP BY c_custkey""",
    rounded="s a",
)
_add(
    "agg_read_action", "customer", lambda q: _having(q, "order", read_actions=(("open", ref("o_orderstatus") == "O"),)).aggregate(n=agg("count", "orders"), o=agg("count", "orders", read_action="open")).select("c_custkey"),
    "SELECT c_custkey, count(o_orderkey) AS n, count(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS o FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey",
)

# -- functions ----------------------------------------------------------------------------------------

_add(
    "calc_more_strings", "customer", lambda q: q.calculate(
        ends=call("ends_with", ref("c_name"), "1"), trimmed=call("string_trim", call("concat", "  ", ref("c_mktsegment"), " ")), down=call("string_downcase", ref("c_mktsegment")), up=call("string_upcase", ref("c_name"))).select("c_custkey"),
    "SELECT c_custkey, suffix(c_name, '1') AS ends, c_mktsegment AS trimmed, lower(c_mktsegment) AS down, upper(c_name) AS up FROM customer",
)
_add(
    "calc_integer_division", "order", lambda q: q.calculate(d=call("idiv", ref("o_orderkey") + 9007199254740993, 3), e=call("idiv", -ref("o_orderkey"), 4)).select("o_orderkey"),
    "SELECT o_orderkey, (o_orderkey + 9007199254740993) // 3 AS d, -(o_orderkey // 4) AS e FROM orders",
)
_add(
    "calc_clock", "order", lambda q: q.filter(ref("o_orderdate") > call("ago", years=90), ref("o_orderdate") < call("from_now", 1, unit="year")).calculate(
        past=ref("o_orderdate") < call("now"), day=call("type", ref("o_orderdate"), to="date") < call("today")).select("o_orderkey"),
    "SELECT o_orderkey, o_orderdate < now()::TIMESTAMP AS past, o_orderdate::DATE < today() AS day FROM orders WHERE o_orderdate > now()::TIMESTAMP - INTERVAL 90 YEAR AND o_orderdate < now()::TIMESTAMP + INTERVAL 1 YEAR",
)
_add(
    "calc_durations", "order", lambda q: q.calculate(
        a=ref("o_orderdate") + call("duration", months=1, hours=2), b=ref("o_orderdate") - call("duration", weeks=1, minutes=5),
        d=call("date_add", call("type", ref("o_orderdate"), to="date"), 1, unit="month")).select("o_orderkey"),
    "SELECT o_orderkey, o_orderdate + INTERVAL 1 MONTH + INTERVAL 2 HOUR AS a, o_orderdate - INTERVAL 7 DAY - INTERVAL 5 MINUTE AS b, (o_orderdate::DATE + INTERVAL 1 MONTH)::DATE AS d FROM orders",
)
_add(
    "calc_start_of_day", "event", lambda q: q.calculate(d=call("type", call("start_of_day", call("type", ref("ts"), to="timestamp"), zone="Etc/GMT-3"), to="string")).select("event_id"),
    "SELECT event_id, strftime(date_trunc('day', ts + INTERVAL 3 HOUR) - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS d FROM events",
)
_STAY = Resource("stay", (A("id", "integer", primary_key=True), A("days", "map")), table="stays")


def _stays(q: Query) -> Query:
    orders = _rows(q, "order")
    low = F.pmod(F.col("o_orderkey"), F.lit(11))
    high = F.when(F.pmod(F.col("o_orderkey"), F.lit(5)) > 0, low + F.pmod(F.col("o_custkey"), F.lit(7)) - 1)
    return _on(q, _STAY, orders.select(F.col("o_orderkey").alias("id"), make(low, high).alias("days")))


_add(
    "range_values", "order", lambda q: _stays(q).calculate(
        has=call("range_contains", ref("days"), 6), over=call("range_overlaps", ref("days"), call("range", call("type", 3, to="long"), call("type", 5, to="long"))), inside=call("range_contains_range", call("range", call("type", 2, to="long"), call("type", 9, to="long")), ref("days")),
        lo=call("range_lower", ref("days")), hi=call("range_upper", ref("days"))).select("id"),
    """SELECT id, NOT empty AND lo <= 6 AND coalesce(6 < hi, true) AS has, NOT empty AND lo < 5 AND coalesce(hi > 3, true) AS over, empty OR (lo >= 2 AND coalesce(hi <= 9, false)) AS inside, lo, hi
    FROM (SELECT *, coalesce(lo >= hi, false) AS empty FROM (SELECT o_orderkey AS id, o_orderkey % 11 AS lo, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 11 + o_custkey % 7 - 1 END AS hi FROM orders))""",
)
_add(
    "range_order", "order", lambda q: _stays(q).sort(call("range_sort_key", ref("days")), "id").limit(200).select("id"),
    """SELECT id FROM (SELECT *, coalesce(lo >= hi, false) AS empty FROM (SELECT o_orderkey AS id, o_orderkey % 11 AS lo, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 11 + o_custkey % 7 - 1 END AS hi FROM orders))
    ORDER BY NOT empty, CASE WHEN NOT empty THEN lo END NULLS FIRST, CASE WHEN NOT empty THEN hi END NULLS LAST, id LIMIT 200""",
)
_words = "regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')".replace("{{", "{").replace("}}", "}")
_add(
    "text_match", "benchmark", lambda q: q.filter(call("text_match", ref("text"), query="(the | of) & !and")).select("item_id"),
    f"SELECT item_id FROM benchmark WHERE (list_contains({_words}, 'the') OR list_contains({_words}, 'of')) AND NOT list_contains({_words}, 'and')",
)
_g = "flatten(list_transform(list_filter(regexp_split_to_array(lower({0}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3))))"
_add(
    "trigram_word_similarity", "nation", lambda q: q.calculate(s=call("round", call("trigram_word_similarity", ref("region.r_name"), call("concat", ref("n_name"), " ", ref("region.r_name"), " x")), places=9)).select("n_nationkey"),
    f"""SELECT n_nationkey, round(list_max(flatten(list_transform(range(1, len(b) + 1), lambda i: list_transform(range(i, len(b) + 1), lambda j: len(list_intersect(a, b[i:j])) / len(list_distinct(list_concat(a, b[i:j]))))))), 9) AS s
    FROM (SELECT n_nationkey, a, list_filter(b, lambda x, i: list_position(b, x) = i) AS b
      FROM (SELECT n_nationkey, {_g.format('r_name')} AS a, {_g.format("n_name || ' ' || r_name || ' x'")} AS b FROM nation JOIN region ON n_regionkey = r_regionkey))""",
)
_path = call("list", ref("nation.region.r_name"), ref("nation.n_name"), ref("c_mktsegment"))
_add(
    "label_paths", "customer", lambda q: q.calculate(
        n=call("path_levels", _path), below=call("path_is_ancestor", call("list", "ASIA"), _path), root=call("string_join", call("path_shared_root", _path, call("list", "ASIA", "x")), sep="."),
        back=call("path_unescape", call("path_escape", call("concat", ref("c_name"), "-é_")))).select("c_custkey"),
    """SELECT c_custkey, 3 AS n, r_name = 'ASIA' AS below, CASE WHEN r_name = 'ASIA' THEN 'ASIA' ELSE '' END AS root, c_name || '-é_' AS back
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
_add(
    "calc_composite", "customer",
    lambda q: q.calculate(p=call("type", map_of(key=ref("c_nationkey"), rest=ref("c_acctbal")), to="struct<key:bigint,rest:decimal(18,2)>")).select("c_custkey").to_df().select("c_custkey", F.col("p.key").alias("k"), F.col("p.rest").alias("r")),
    "SELECT c_custkey, c_nationkey::BIGINT AS k, c_acctbal::DECIMAL(18,2) AS r FROM customer",
)
_BIO = Resource("biography", (A("id", "integer", primary_key=True), A("bio", "map")), table="biographies")
_add(
    "filter_embedded", "customer",
    lambda q: _on(q, _BIO, _rows(q, "customer").select(F.col("c_custkey").alias("id"), F.struct(F.col("c_mktsegment").alias("segment"), F.struct(F.col("c_acctbal").alias("balance")).alias("money")).alias("bio")))
    .filter(ref("bio")["segment"] == "BUILDING", ref("bio")["money"]["balance"] > 100).select("id"),
    "SELECT c_custkey AS id FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 100",
)
_add(
    "filter_intersects_mixed", "customer", lambda q: q.filter(call("intersects", call("list", ref("c_nationkey"), 100), call("list", "3", "4"), of="string")).select("c_custkey"),
    "SELECT c_custkey FROM customer WHERE c_nationkey IN (3, 4)",
)
_add(
    "calc_whitespace_and_ids", "nation", lambda q: q.calculate(t=call("trim_whitespace", call("concat", "\t ", ref("n_name"), "\n")), u=call("uuid_v7")).select("n_nationkey").to_df()
    .select("n_nationkey", "t", F.col("u").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("u")),
    "SELECT n_nationkey, n_name AS t, true AS u FROM nation",
)
register("halved", lambda a: a / 2)
_add("custom_expression", "customer", lambda q: q.calculate(h=call("halved", ref("c_acctbal"))).select("c_custkey"), "SELECT c_custkey, c_acctbal / 2 AS h FROM customer")
_add(
    "hidden_calculation", "customer",
    lambda q: _more(q, "customer", calculations=(Calculation("twice", ref("c_acctbal") * 2, public=False),)).calculate(twice=ref("twice")).select("c_custkey").to_df().select("c_custkey", F.col("calculations.twice").alias("t")),
    "SELECT c_custkey, c_acctbal * 2 AS t FROM customer",
)
_add(
    "single_row_values", "region", lambda q: q.engine.spark.range(1).select(F.lit(q.engine.evaluate(call("concat", "a", call("type", call("idiv", 7, 2), to="string")))).alias("v")),
    "SELECT 'a3' AS v",
)
_add("lock_modes", "nation", lambda q: q.lock("for update nowait").select("n_nationkey"), "SELECT n_nationkey FROM nation")

# -- tenants and tables ------------------------------------------------------------------------------

_TENANT = Resource("own_document", (A("doc_id", "integer", primary_key=True), A("source")), table="documents", tenant_by="attribute", tenant_attribute="source")
_add(
    "tenant_by_attribute", "document",
    lambda q: replace(q, engine=q.engine.with_values(domain=Domain((*q.engine.domain.resources, _TENANT)), tenant="src3"), resource="own_document").calculate(t=tenant()).select("doc_id"),
    "SELECT doc_id, 'src3' AS t FROM documents WHERE source = 'src3'",
)
_NAMED = Resource("named", (A("s_suppkey", "integer", primary_key=True), A("label", source="s_name")), polymorphic=True)
_add(
    "polymorphic_table", "supplier",
    lambda q: replace(q, engine=q.engine.with_values(domain=Domain((*q.engine.domain.resources, _NAMED)), tables={"named": "supplier"}), resource="named").select("s_suppkey", "label"),
    "SELECT s_suppkey, s_name AS label FROM supplier",
)

# -- mutations ---------------------------------------------------------------------------------------

_add(
    "create_one", "region", lambda q: create(q.engine, "region", r_regionkey=77, r_name=call("concat", "NEW", "LAND")).rows,
    "SELECT r_regionkey, r_name FROM region UNION ALL SELECT 77, 'NEWLAND'",
)
_add(
    "create_in_order", "nation",
    lambda q: in_input_order(bulk_create(q.engine, "nation", _rows(q, "nation").repartition(3, "n_regionkey").sortWithinPartitions("n_nationkey").select((F.col("n_nationkey") + 100).alias("n_nationkey"), "n_name", "n_regionkey")))
    .agg(F.count_distinct("_ordinal").alias("n"), F.min("_ordinal").alias("low"), F.max("_ordinal").alias("high")),
    "SELECT count(*) AS n, 0 AS low, count(*) - 1 AS high FROM nation",
)


def _richer(q: Query) -> DataFrame:
    """Every customer of a positive balance again, with one more."""
    return _rows(q, "customer").filter("c_acctbal > 0").select("c_custkey", "c_name", "c_nationkey", (F.col("c_acctbal") + 1).alias("c_acctbal"), "c_mktsegment")


_add(
    "upsert_skipped", "customer",
    lambda q: upsert(q.engine, "customer", _richer(q), fields=("c_acctbal",), condition=lambda old, new: old("c_acctbal") > 5000, return_skipped=True).changed.select("c_custkey", "c_acctbal", "_action"),
    """SELECT c_custkey, c_acctbal + CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS c_acctbal, CASE WHEN c_acctbal > 5000 THEN 'update' ELSE 'skip' END AS _action FROM customer WHERE c_acctbal > 0""",
)
_touch = tuple(replace(a, update_default="touched") if a.name == "c_mktsegment" else a for a in DOMAIN["customer"].attributes)
_add(
    "upsert_update_defaults", "customer",
    lambda q: upsert(_having(q, "customer", attributes=_touch).engine, "customer", _richer(q).drop("c_mktsegment"), fields=("c_acctbal",)).rows.select("c_custkey", "c_acctbal", "c_mktsegment"),
    "SELECT c_custkey, c_acctbal + CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS c_acctbal, CASE WHEN c_acctbal > 0 THEN 'touched' ELSE c_mktsegment END AS c_mktsegment FROM customer",
)
_add(
    "upsert_without_touching", "customer",
    lambda q: upsert(_having(q, "customer", attributes=_touch).engine, "customer", _richer(q), fields=("c_acctbal",), touch_update_defaults=False).rows.select("c_custkey", "c_mktsegment"),
    "SELECT c_custkey, c_mktsegment FROM customer",
)
_add(
    "upsert_by_name", "customer",
    lambda q: upsert(q.engine, "customer", _richer(q).withColumn("c_custkey", F.col("c_custkey") + 500000000), identity="by_name", fields=("c_acctbal",)).rows.select("c_custkey", "c_acctbal"),
    "SELECT c_custkey, c_acctbal + CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS c_acctbal FROM customer",
)
_nulls = Identity("segment_name", ("c_mktsegment", "c_name"), nils_distinct=False)


def _unnamed(q: Query) -> Query:
    rows = _rows(q, "customer").withColumn("c_mktsegment", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))
    return _on(q, replace(DOMAIN["customer"], name="buyer", table="buyers", identities=(_nulls,), _index={}), rows)


_add(
    "upsert_equal_nils", "customer",
    lambda q: upsert(_unnamed(q).engine, "buyer", _unnamed(q).to_df().withColumns({"c_custkey": F.col("c_custkey") + 500000000, "c_acctbal": F.lit(1.0)}), identity="segment_name", fields=("c_acctbal",)).rows.select("c_custkey", "c_acctbal"),
    "SELECT c_custkey, 1.0::DOUBLE AS c_acctbal FROM customer",
)
_partial = Identity("rich_name", ("c_name",), where=ref("c_acctbal") > 0)
_add(
    "upsert_identity_where", "customer",
    lambda q: upsert(_having(q, "customer", identities=(_partial,)).engine, "customer", _rows(q, "customer").withColumn("c_custkey", F.col("c_custkey") + 500000000), identity="rich_name", fields=("c_mktsegment",)).changed.select("c_custkey", "_action"),
    "SELECT c_custkey, 'update' AS _action FROM customer WHERE c_acctbal > 0 UNION ALL SELECT c_custkey + 500000000, 'insert' FROM customer WHERE c_acctbal <= 0",
)
_add(
    "update_one", "nation", lambda q: update(q.filter(ref("n_nationkey") == 3), {"n_name": call("concat", ref("n_name"), "!")}).changed.select("n_nationkey", "n_name"),
    "SELECT n_nationkey, n_name || '!' AS n_name FROM nation WHERE n_nationkey = 3",
)
_add("destroy_one", "nation", lambda q: destroy(q.filter(ref("n_nationkey") == 3)).rows.select("n_nationkey"), "SELECT n_nationkey FROM nation WHERE n_nationkey <> 3")
_add(
    "update_optimistic", "region", lambda q: _versioned(q),
    "SELECT r_regionkey, 2 AS version FROM region WHERE r_regionkey = 2",
)


def _versioned(q: Query) -> DataFrame:
    table = Resource("versioned", (A("r_regionkey", "integer", primary_key=True), A("version", "integer")), table="versioned")
    own = _on(q, table, _rows(q, "region").select("r_regionkey", F.lit(1).alias("version")))
    return update(*optimistic(own.filter(ref("r_regionkey") == 2), "version", 1)).changed.select("r_regionkey", "version")


_add(
    "update_returning", "customer",
    lambda q: returning(q.engine, "customer", update_query(q.filter(ref("c_acctbal") < 0), {"c_acctbal": -ref("c_acctbal")}), "c_custkey", "c_acctbal", "name_and_segment", "order_count"),
    """SELECT c_custkey, -c_acctbal AS c_acctbal, c_name || ' / ' || c_mktsegment AS name_and_segment, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS order_count, 'update' AS _action FROM customer WHERE c_acctbal < 0""",
)
_owned = lambda how: (Reference("o_custkey", "customer", "c_custkey", on_delete=how),)
_add(
    "cascade_delete", "customer",
    lambda q: cascade((x := _having(q, "order", references=_owned("delete"))).engine, "customer", destroy_query(x.filter(ref("c_acctbal") < 0)).changed)["order"].select("o_orderkey"),
    "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
_add(
    "cascade_nilify", "customer",
    lambda q: cascade((x := _having(q, "order", references=_owned("nilify"))).engine, "customer", destroy_query(x.filter(ref("c_acctbal") < 0)).changed)["order"].select("o_orderkey", "o_custkey"),
    "SELECT o_orderkey, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) THEN o_custkey END AS o_custkey FROM orders",
)
_rules = {"checks": (Check("not_poor", "c_acctbal", ref("c_acctbal") > -100000),), "references": (Reference("c_nationkey", "nation", "n_nationkey"),)}
_add(
    "update_under_constraints", "customer",
    lambda q: update_many(_having(q, "customer", **_rules).engine, "customer", _rows(q, "customer").select("c_custkey", (F.col("c_acctbal") - 5).alias("c_acctbal"), ((F.col("c_nationkey") + 1) % 25).alias("c_nationkey"))).rows.select("c_custkey", "c_acctbal", "c_nationkey"),
    "SELECT c_custkey, c_acctbal - 5 AS c_acctbal, (c_nationkey + 1) % 25 AS c_nationkey FROM customer",
)
_add(
    "write_policy", "customer", lambda q: update_query(_having(q, "customer", write_policy=ref("nation.n_regionkey") == actor("region")), {"c_acctbal": ref("c_acctbal") + 1}).changed.select("c_custkey", "c_acctbal"),
    "SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2", actor={"region": 2},
)
_add(
    "exclusion_kept", "order",
    lambda q: bulk_create((x := _having_stay(q)).engine, "stay", _shifted(x)).rows.select("id"),
    "SELECT o_orderkey AS id FROM orders UNION ALL SELECT o_orderkey + 1000000000 FROM orders",
)


def _having_stay(q: Query) -> Query:
    """A stay of ten days in a room of its own for each order."""
    room = Resource("stay", (A("id", "integer", primary_key=True), A("room", "integer"), A("days", "map")), table="stays", exclusions=(Exclusion("no_overlap", ("room",), "days"),))
    orders = _rows(q, "order")
    return _on(q, room, orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("room"), make(F.lit(0), F.lit(10)).alias("days")))


def _shifted(x: Query) -> DataFrame:
    """Stays that begin when the others end."""
    return x.to_df().select((F.col("id") + 1000000000).alias("id"), "room", make(F.lit(10), F.lit(20)).alias("days"))


__all__ = ["ORACLES", "QUERIES"]
