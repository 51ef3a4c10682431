"""Operations between declarations, their order and their inverses; timeouts; zones; row-wise functions."""

import datetime
from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.errors import QueryTimeout
from tessera.expr import call, ref
from tessera.functions.registry import register
from tessera.schema import Attribute, Check, Domain, Identity, Reference, Resource
from tessera.sources.operations import down, migrate, operations, ordered
from tests.blog import query

A = Attribute
AUTHOR = Resource("author", (A("id", "integer", primary_key=True), A("name"), A("age", "integer")), table="authors", identities=(Identity("by_name", ("name",)),))
POST = Resource(
    "post", (A("id", "integer", primary_key=True), A("title"), A("author_id", "integer")), table="posts",
    references=(Reference("author_id", "author", "id"),), checks=(Check("titled", "title", ref("title") != ""),),
)


def kinds(ops):
    return [(o.kind, o.table, o.name) for o in ops]


def before(ops, first, then):
    found = kinds(ops)
    return found.index(first) < found.index(then)


def test_new_tables_come_in_the_order_of_their_keys():
    ops = operations(Domain(()), Domain((POST, AUTHOR)))
    assert before(ops, ("create_table", "authors", ""), ("add_reference", "posts", "author_id"))
    assert before(ops, ("add_primary_key", "authors", ""), ("add_reference", "posts", "author_id"))
    assert before(ops, ("add_column", "posts", "author_id"), ("add_reference", "posts", "author_id"))
    assert all(before(ops, ("create_table", o.table, ""), (o.kind, o.table, o.name)) for o in ops if o.kind != "create_table")
    gone = down(ops)
    assert before(gone, ("remove_reference", "posts", "author_id"), ("drop_table", "authors", ""))
    assert set(kinds(operations(Domain((POST, AUTHOR)), Domain(())))) <= set(kinds(gone))


def test_dropped_tables_wait_for_the_keys_that_point_at_them():
    left = replace(POST, references=(), attributes=POST.attributes[:2], _index={})
    ops = operations(Domain((AUTHOR, POST)), Domain((left,)))
    assert before(ops, ("remove_reference", "posts", "author_id"), ("drop_table", "authors", ""))
    assert before(ops, ("remove_reference", "posts", "author_id"), ("remove_column", "posts", "author_id"))
    assert before(ops, ("remove_unique", "authors", "by_name"), ("drop_table", "authors", ""))


def test_changes_of_a_table():
    new = replace(
        AUTHOR, attributes=(A("id", "integer", primary_key=True), A("full_name", source="label"), A("age", "string"), A("mail", default="none")), _index={},
        identities=(Identity("by_label", ("full_name",)),), tenant_by="schema",
    )
    ops = operations(Domain((AUTHOR,)), Domain((new,)), renamed_columns={("authors", "name"): "label"})
    assert {("rename_column", "authors", "name"), ("alter_column", "authors", "age"), ("add_column", "authors", "mail"), ("move_table", "authors", "")} <= set(kinds(ops))
    assert not any(o.kind in ("remove_column",) or (o.kind == "add_column" and o.name == "label") for o in ops)
    assert before(ops, ("rename_column", "authors", "name"), ("add_unique", "authors", "by_label"))
    assert operations(Domain((AUTHOR,)), Domain((AUTHOR,))) == []
    same = replace(AUTHOR, identities=(Identity("other", ("name",)),), _index={})
    assert kinds(operations(Domain((AUTHOR,)), Domain((same,)))) == [("rename_unique", "authors", "by_name")]
    stricter = replace(AUTHOR, identities=(Identity("by_name", ("name",), nils_distinct=False),), _index={})
    assert kinds(operations(Domain((AUTHOR,)), Domain((stricter,)))) == [("remove_unique", "authors", "by_name"), ("add_unique", "authors", "by_name")]
    moved = replace(AUTHOR, table="people", _index={})
    ops = operations(Domain((AUTHOR,)), Domain((moved,)), {"authors": "people"})
    assert [(o.kind, o.table, o.after) for o in ops] == [("rename_table", "authors", "people")]
    assert [(o.kind, o.table, o.after) for o in down(ops)] == [("rename_table", "people", "authors")]
    assert ordered([]) == []


def test_rows_follow_and_come_back(spark):
    new = replace(AUTHOR, attributes=(A("id", "integer", primary_key=True), A("label"), A("age", "string"), A("mail", default="none")), identities=(), _index={})
    ops = operations(Domain((AUTHOR,)), Domain((new,)), renamed_columns={("authors", "name"): "label"})
    rows = spark.createDataFrame([(1, "Ada", 36), (2, None, None)], "id long, name string, age long")
    there = migrate(rows, "authors", ops)
    assert sorted(there.columns) == ["age", "id", "label", "mail"] and dict(there.dtypes)["age"] == "string"
    assert sorted(map(tuple, there.select("id", "label", "age", "mail").collect()), key=repr) == [(1, "Ada", "36", "none"), (2, None, None, "none")]
    back = migrate(there, "authors", down(ops))
    assert sorted(map(tuple, back.select("id", "name", "age").collect()), key=repr) == [(1, "Ada", 36), (2, None, None)]


def test_timeout(spark):
    register("wait", lambda a: F.udf(lambda x: __import__("time").sleep(20) or x, "long")(a))
    slow = query(spark, "post").calculate(x=call("wait", ref("id"))).select("id")
    with pytest.raises(QueryTimeout):
        slow.collect(timeout=2)
    assert len(query(spark, "post").collect(timeout=60)) == 4


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_instants_compare_alike_in_every_session_zone(spark, zone):
    """An instant is the same instant wherever the session is; only what has no zone follows the session's."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = datetime.datetime(2024, 3, 10, 6, 30, tzinfo=datetime.UTC)
        e = query(spark, "post").engine
        rows = spark.range(5).select("id", F.timestamp_seconds(F.lit(int(at.timestamp())) + (F.col("id") - 2) * 3600).alias("at"))
        moments = Resource("moment", (A("id", "integer", primary_key=True), A("at", "datetime")), table="moments")
        from tessera.plans.query import Query

        q = Query(e.with_values(domain=Domain((moments,)), repos={"default": lambda t, tenant: rows}), "moment")
        assert [r["id"] for r in q.filter(ref("at") < at).sort("id").collect()] == [0, 1]
        assert [r["id"] for r in q.filter(call("datetime_add", ref("at"), 1, unit="hour") == at).collect()] == [1]
        start = q.calculate(d=call("start_of_day", ref("at"), zone="Europe/Berlin")).select("id").sort("id").collect()
        assert {int(r["d"].timestamp()) for r in start} == {int(datetime.datetime(2024, 3, 9, 23, tzinfo=datetime.UTC).timestamp())}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_function_of_the_rows_in_python(spark):
    """A module's own calculation runs on Arrow batches, not row by row."""

    def initials(first: pd.Series, last: pd.Series) -> pd.Series:
        return first.str[:1] + last.str[:1]

    register("initials", F.pandas_udf(initials, "string"))
    out = query(spark, "author").calculate(i=call("initials", ref("first_name"), ref("last_name"))).select("id").sort("id").collect()
    assert [r["i"] for r in out] == ["AL", None, None]
