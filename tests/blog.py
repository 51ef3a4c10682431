"""Literal rows with nulls for what the driver's tables can't show."""

from tessera.expr import agg, call, exists, if_, parent, ref
from tessera.plans.query import Query
from tessera.schema import Attribute, Calculation, Check, Domain, Identity, Reference, Relationship, Resource
from tessera.sources.engine import Engine

A, R = Attribute, Relationship

DOMAIN = Domain(
    (
        Resource(
            "author", (A("id", "integer", primary_key=True), A("first_name"), A("last_name"), A("badges", "array<string>"), A("bio", "map", select=False)), table="authors",
            relationships=(R("posts", "has_many", "post", "id", "author_id"), R("first_post", "has_one", "post", "id", "author_id", sort=("id",), from_many=True)),
            calculations=(Calculation("full_name", call("concat", ref("first_name"), " ", ref("last_name"))), Calculation("secret", call("string_length", ref("first_name")), public=False)),
            aggregates=(("post_count", agg("count", "posts")),),
            identities=(Identity("names", ("first_name", "last_name"), nils_distinct=False),),
        ),
        Resource(
            "post",
            (A("id", "integer", primary_key=True), A("title", source="title_column"), A("score", "integer"), A("author_id", "integer"), A("category", "ci_string"), A("status", one_of=("open", "closed"))),
            table="posts",
            relationships=(
                R("author", "belongs_to", "author", "author_id", "id"),
                R("comments", "has_many", "comment", "id", "post_id"),
                R("popular", "has_many", "comment", "id", "post_id", filter=ref("likes") > 1),
                R("linked", "many_to_many", "post", "id", "id", through=("link", "source", "target")),
                R("first_link", "has_many", "link", "id", "source", sort=("-target",), limit=1),
                R("last_linked", "many_to_many", "post", "id", "id", through=("link", "source", "target"), join_relationship="first_link"),
                R("higher", "has_many", "post", no_attributes=True, filter=ref("score") > parent("score")),
            ),
            calculations=(Calculation("negative_score", -ref("score")), Calculation("busy", exists("comments"))),
            checks=(Check("positive", "score", ref("score") >= 0, "is negative"),),
            references=(Reference("author_id", "author", "id"),),
        ),
        Resource(
            "comment", (A("id", "integer", primary_key=True), A("post_id", "integer"), A("title"), A("likes", "integer")), table="comments",
            relationships=(R("post", "belongs_to", "post", "post_id", "id"),),
            references=(Reference("post_id", "post", "id", on_delete="delete"),),
        ),
        Resource("link", (A("source", "integer", primary_key=True), A("target", "integer", primary_key=True)), table="links"),
        Resource("rating", (A("id", "integer", primary_key=True), A("score", "integer")), polymorphic=True),
        Resource("note", (A("id", "integer", primary_key=True), A("org"), A("body")), table="notes", tenant_by="attribute", tenant_attribute="org"),
        Resource("memo", (A("id", "integer", primary_key=True), A("body")), table="memos", tenant_by="schema"),
        Resource("view", (A("at", "integer"), A("post_id", "integer")), table="views"),
    )
)


def engine(spark, **values) -> Engine:
    make = spark.createDataFrame
    tables = {
        "authors": make([(1, "Ada", "L", ["x", None], None), (2, "Bob", None, [], None), (3, None, "Z", None, None)], "id long, first_name string, last_name string, badges array<string>, bio string"),
        "posts": make(
            [(1, "alpha", 3, 1, "News", "open"), (2, "beta", None, 1, "news", "closed"), (3, "gamma", 1, 2, "Other", "open"), (4, None, 3, None, None, None)],
            "id long, title_column string, score long, author_id long, category string, status string",
        ),
        "comments": make([(1, 1, "c", 5), (2, 1, "a", None), (3, 1, "b", 2), (4, 2, None, 0), (5, 2, "a", 7), (6, None, "lost", 1)], "id long, post_id long, title string, likes long"),
        "links": make([(1, 2), (1, 3), (2, 3)], "source long, target long"),
        "post_ratings": make([(1, 5)], "id long, score long"),
        "notes": make([(1, "a", "one"), (2, "b", "two")], "id long, org string, body string"),
        "t1/memos": make([(1, "first")], "id long, body string"),
        "t2/memos": make([(2, "second")], "id long, body string"),
        "views": make([(1, 1)], "at long, post_id long"),
    }

    def load(table, tenant):
        return tables[f"{tenant}/{table}" if tenant else table]

    return Engine(spark, DOMAIN, {"default": load}, **values)


def query(spark, resource: str, **values) -> Query:
    return Query(engine(spark, **values), resource)


def ids(df, column="id"):
    return [r[column] for r in df.collect()]


__all__ = ["DOMAIN", "agg", "call", "engine", "exists", "ids", "if_", "parent", "query", "ref"]
