"""The driver's tables as resources."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tessera.expr import agg, call, parent, ref
from tessera.plans.query import Query
from tessera.schema import Attribute, Calculation, Domain, Identity, Relationship, Resource
from tessera.sources.engine import Engine, parquet_tables


def _attributes(key: str, text: str) -> tuple[Attribute, ...]:
    """"name:type ..." with the primary key's names in key."""
    keys = key.split()
    return tuple(Attribute(n, t or "string", primary_key=n in keys) for n, _, t in (x.partition(":") for x in text.split()))


def _belongs(name: str, to: str, source: str, destination: str) -> Relationship:
    return Relationship(name, "belongs_to", to, source, destination)


def _many(name: str, to: str, source: str, destination: str, **more) -> Relationship:
    return Relationship(name, "has_many", to, source, destination, **more)


DOMAIN = Domain(
    (
        Resource(
            "region", _attributes("r_regionkey", "r_regionkey:integer r_name"), table="region",
            relationships=(
                _many("nations", "nation", "r_regionkey", "n_regionkey"),
                Relationship("customers", "has_many", "customer", path=("nations", "customers")),
                Relationship("orders", "has_many", "order", path=("nations", "customers", "orders")),
            ),
        ),
        Resource(
            "nation", _attributes("n_nationkey", "n_nationkey:integer n_name n_regionkey:integer"), table="nation",
            relationships=(
                _belongs("region", "region", "n_regionkey", "r_regionkey"),
                _many("customers", "customer", "n_nationkey", "c_nationkey"),
                _many("suppliers", "supplier", "n_nationkey", "s_nationkey"),
            ),
        ),
        Resource(
            "customer",
            _attributes("c_custkey", "c_custkey:integer c_name c_nationkey:integer c_acctbal:float c_mktsegment"),
            table="customer",
            relationships=(
                _belongs("nation", "nation", "c_nationkey", "n_nationkey"),
                _many("orders", "order", "c_custkey", "o_custkey"),
                _many("top_orders", "order", "c_custkey", "o_custkey", sort=("-o_totalprice", "o_orderkey"), limit=2),
                Relationship("latest_order", "has_one", "order", "c_custkey", "o_custkey", sort=("-o_orderdate", "o_orderkey"), from_many=True),
                _many("large_orders", "order", "c_custkey", "o_custkey", filter=ref("o_totalprice") > 50000),
                _many(
                    "similar_balance", "customer", "c_custkey", "c_custkey", no_attributes=True,
                    filter=(ref("c_nationkey") == parent("c_nationkey")) & (ref("c_acctbal") > parent("c_acctbal")) & (ref("c_acctbal") < parent(ref("c_acctbal") + 100)),
                ),
                _many("same_segment_order", "order", "c_custkey", "o_custkey", manual=lambda s, d: (s("c_custkey") == d("o_custkey")) & s("c_mktsegment").startswith("B") & (d("o_orderstatus") == "F")),
            ),
            calculations=(
                Calculation("name_and_segment", call("concat", ref("c_name"), " / ", ref("c_mktsegment"))),
                Calculation("balance_above", lambda than=0: ref("c_acctbal") > than),
            ),
            aggregates=(
                ("order_count", agg("count", "orders")),
                ("order_total", agg("sum", "orders", "o_totalprice")),
            ),
            identities=(Identity("by_name", ("c_name",)),),
        ),
        Resource(
            "supplier", _attributes("s_suppkey", "s_suppkey:integer s_name s_nationkey:integer s_acctbal:float"), table="supplier",
            relationships=(
                _belongs("nation", "nation", "s_nationkey", "n_nationkey"),
                Relationship("parts", "many_to_many", "part", "s_suppkey", "p_partkey", through=("lineitem", "l_suppkey", "l_partkey")),
            ),
        ),
        Resource(
            "part",
            _attributes("p_partkey", "p_partkey:integer p_name p_brand p_type p_size:integer p_retailprice:float"), table="part",
            relationships=(
                _many("lineitems", "lineitem", "p_partkey", "l_partkey"),
                Relationship("suppliers", "many_to_many", "supplier", "p_partkey", "s_suppkey", through=("lineitem", "l_partkey", "l_suppkey")),
            ),
        ),
        Resource(
            "order",
            _attributes("o_orderkey", "o_orderkey:integer o_custkey:integer o_orderstatus o_totalprice:float o_orderdate:datetime o_orderpriority"),
            table="orders",
            relationships=(
                _belongs("customer", "customer", "o_custkey", "c_custkey"),
                _many("lineitems", "lineitem", "o_orderkey", "l_orderkey"),
            ),
            aggregates=(("line_count", agg("count", "lineitems")), ("quantity", agg("sum", "lineitems", "l_quantity"))),
        ),
        Resource(
            "lineitem",
            _attributes(
                "l_orderkey l_linenumber",
                "l_orderkey:integer l_partkey:integer l_suppkey:integer l_linenumber:integer l_quantity:float l_extendedprice:float "
                "l_discount:float l_tax:float l_returnflag l_linestatus l_shipdate:datetime",
            ),
            table="lineitem",
            relationships=(
                _belongs("order", "order", "l_orderkey", "o_orderkey"),
                _belongs("part", "part", "l_partkey", "p_partkey"),
                _belongs("supplier", "supplier", "l_suppkey", "s_suppkey"),
            ),
        ),
        Resource("event", _attributes("event_id", "event_id:integer ts:datetime user_id:integer event_type value:float props"), table="events"),
        Resource("embedding", _attributes("vec_id", "vec_id:integer embedding:vector label:integer"), table="embeddings"),
        Resource(
            "document", _attributes("doc_id", "doc_id:integer text lang source n_chars:integer"), table="documents",
            relationships=(Relationship("label", "has_one", "label", "doc_id", "doc_id"),),
        ),
        Resource("label", _attributes("doc_id", "doc_id:integer quality:integer toxic:integer"), table="labels"),
        Resource("page", _attributes("page_id", "page_id:integer url html"), table="pages"),
        Resource("benchmark", _attributes("item_id", "item_id:integer text"), table="benchmark"),
        Resource("turn", _attributes("conv_id turn", "conv_id:integer turn:integer role text"), table="conversations"),
    )
)


def engine(spark: SparkSession, folder: str, domain: Domain = DOMAIN, **values) -> Engine:
    return Engine(spark, domain, {"default": parquet_tables(spark, folder)}, **values)


def query(spark: SparkSession, folder: str, resource: str, **values) -> Query:
    return Query(engine(spark, folder, **values), resource)
