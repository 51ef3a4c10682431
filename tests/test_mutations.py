"""Mutations, constraints, the versioned store, schema inference."""

import pytest

from tessera.errors import ConstraintError, PlanError, StaleRecord
from tessera.expr import agg, call, exists, ref
from tessera.operators.mutate import bulk_create, cascade, create, destroy, destroy_query, in_input_order, update, update_many, update_query, upsert
from tessera.schema import Domain
from tessera.sources.engine import Engine
from tessera.sources.introspect import diff, infer, sensitive, with_reverse
from tessera.sources.store import VersionedStore
from tests.blog import engine, query


def test_bulk_create_and_order(spark):
    given = spark.createDataFrame([(9, "z"), (8, "y")], "id long, title string")
    done = bulk_create(engine(spark), "post", given, {"score": call("string_length", ref("title"))})
    assert [(r["id"], r["score"], r["_action"]) for r in in_input_order(done).orderBy("_ordinal").collect()] == [(9, 1, "insert"), (8, 1, "insert")]
    assert done.rows.count() == 6


@pytest.mark.parametrize(
    ("row", "field"),
    [((1, "x", 1, "open", 1), "id"), ((9, "x", -1, "open", 1), "score"), ((9, "x", 1, "odd", 1), "status"), ((9, "x", 1, "open", 77), "author_id")],
)
def test_constraints(spark, row, field):
    given = spark.createDataFrame([row], "id long, title string, score long, status string, author_id long")
    with pytest.raises(ConstraintError) as e:
        bulk_create(engine(spark), "post", given)
    assert [x["field"] for x in e.value.errors] == [field]


def test_upsert(spark):
    given = spark.createDataFrame([(1, "new", 7), (2, "newer", 8), (10, "x", 1)], "id long, title string, score long")
    done = upsert(engine(spark), "post", given, fields=("title",), condition=lambda old, new: old("score") < new("score"), return_skipped=True)
    assert {r["id"]: r["_action"] for r in done.changed.collect()} == {1: "update", 2: "skip", 10: "insert"}
    rows = {r["id"]: (r["title"], r["score"]) for r in done.rows.collect()}
    assert rows[1] == ("new", 3) and rows[2] == ("beta", None) and rows[10] == ("x", 1) and len(rows) == 5


def test_upsert_null_keys_match_if_nils_are_not_distinct(spark):
    given = spark.createDataFrame([(50, "Bob", None)], "id long, first_name string, last_name string")
    done = upsert(engine(spark), "author", given, identity="names", fields=())
    assert done.rows.count() == 3
    twice = given.union(given)
    with pytest.raises(ConstraintError):
        upsert(engine(spark), "author", twice, identity="names")


def test_update_many_tells_null_from_absent(spark):
    changes = spark.createDataFrame([(1, None, True), (2, None, False)], "id long, title string, has boolean")
    done = update_many(engine(spark), "post", changes, {"title": "has"})
    assert {r["id"]: r["title"] for r in done.rows.collect()} == {1: None, 2: "beta", 3: "gamma", 4: None}


def test_update_and_destroy(spark):
    q = query(spark, "post")
    done = update_query(q.filter(exists("comments")), {"score": agg("count", "comments") + 1})
    assert {r["id"]: r["score"] for r in done.rows.collect()} == {1: 4, 2: 3, 3: 1, 4: 3}
    done = update_query(q.filter(ref("score") > 1), {"title": call("concat", ref("title"), "!")})
    assert sorted((r["id"], r["title"]) for r in done.changed.collect()) == [(1, "alpha!"), (4, None)]
    assert sorted(r["id"] for r in destroy_query(q.sort("id").limit(1)).rows.collect()) == [2, 3, 4]
    with pytest.raises(StaleRecord):
        destroy(q.filter(ref("id") == 99))
    with pytest.raises(StaleRecord):
        update(q.filter(ref("id") == 99), {"score": ref("score")})
    with pytest.raises(PlanError):
        update_query(q, {"id": ref("id") + 1})


def test_references_on_delete(spark):
    with pytest.raises(ConstraintError):
        destroy_query(query(spark, "author").filter(ref("id") == 1))
    gone = destroy_query(query(spark, "post").filter(ref("id") == 1)).changed
    assert sorted(r["id"] for r in cascade(engine(spark), "post", gone)["comment"].collect()) == [4, 5, 6]


def test_store(spark, tmp_path):
    store = VersionedStore(spark, f"file://{tmp_path}")
    rows = spark.createDataFrame([(1, "a")], "id long, name string")
    assert store.write("t", rows) == 1
    assert store.append("t", spark.createDataFrame([(2, "b")], "id long, name string")) == 2
    assert store.read("t").count() == 2 and store.read("t", 1).count() == 1
    with pytest.raises(PlanError):
        store.write("t", rows, based_on=1)
    resource = infer("t", "t", store.read("t"), ("id",))
    e = Engine(spark, Domain((resource,)), {"default": store.loader()})
    from tessera.plans.query import Query

    store.write("t", update_query(Query(e, "t").filter(ref("id") == 1), {"name": ref("name")}).rows, based_on=2)
    assert store.versions("t")[-1][0] == 3
    with pytest.raises(PlanError):
        store.read("nothing")
    store.create_tenant("one")
    store.rename_tenant("one", "two")
    with pytest.raises(PlanError):
        store.rename_tenant("one", "three")


def test_inference(spark):
    make = lambda ddl: spark.createDataFrame([], ddl)
    posts = infer("post", "posts", make("id long, title string, api_key string, tags array<string>, d decimal(9,2)"), ("id",))
    tags = infer("tag", "tags", make("id long, name string"), ("id",))
    both = infer("post_tag", "post_tags", make("post_id long, tag_id long"), ("post_id", "tag_id"), {"post_id": ("post", "id"), "tag_id": ("tag", "id")})
    assert [(a.name, a.type, a.select) for a in posts.attributes][2:] == [("api_key", "string", False), ("tags", "array<string>", True), ("d", "decimal(9,2)", True)]
    found = {r.name: r for r in with_reverse([posts, tags, both])}
    assert {r.name: r.kind for r in found["post"].relationships} == {"post_tags": "has_many", "tags": "many_to_many"}
    assert sensitive("user_password") and not sensitive("spinach")
    assert diff(make("a int, b int").schema, make("a long, c int").schema) == [("add", "c", "int"), ("alter", "a", "int", "bigint"), ("remove", "b")]


def test_create_one(spark):
    done = create(engine(spark), "post", id=9, title=call("concat", "a", "b"))
    assert [(r["id"], r["title"]) for r in done.changed.collect()] == [(9, "ab")]


def test_stream_of_upserts(spark, tmp_path):
    from tessera.streaming.upserts import upsert_stream

    store = VersionedStore(spark, f"file://{tmp_path}/store")
    store.write("t", spark.createDataFrame([(1, "a")], "id long, name string"))
    e = Engine(spark, Domain((infer("t", "t", store.read("t"), ("id",)),)), {"default": store.loader()})
    spark.createDataFrame([(1, "b"), (2, "c")], "id long, name string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id long, name string").parquet(f"{tmp_path}/in")
    assert upsert_stream(stream, e, store, "t", f"{tmp_path}/checkpoint").awaitTermination(120)
    assert sorted(map(tuple, store.read("t").collect())) == [(1, "b"), (2, "c")]


def _broken(change) -> list[str]:
    with pytest.raises(ConstraintError) as e:
        change()
    return [x["field"] for x in e.value.errors]


@pytest.mark.parametrize(("field", "value"), [("score", -5), ("status", "odd"), ("author_id", 77)])
def test_every_mutation_keeps_the_constraints(spark, field, value):
    e, q = engine(spark), query(spark, "post").filter(ref("id") == 1)
    kind = "string" if isinstance(value, str) else "long"
    given = spark.createDataFrame([(1, value)], f"id long, {field} {kind}")
    assert _broken(lambda: upsert(e, "post", given)) == [field]
    assert _broken(lambda: upsert(e, "post", given.selectExpr("id + 50 AS id", field))) == [field]
    assert _broken(lambda: update_many(e, "post", given)) == [field]
    assert _broken(lambda: update_query(q, {field: call("type", value, to=kind)})) == [field]


def test_identities_after_updates(spark):
    e = engine(spark)
    both = spark.createDataFrame([(2, "Ada", "L")], "id long, first_name string, last_name string")
    assert _broken(lambda: update_many(e, "author", both)) == ["first_name"]
    assert _broken(lambda: update_query(query(spark, "author"), {"first_name": call("type", "x", to="string"), "last_name": call("type", "y", to="string")})) == ["first_name"]
    assert _broken(lambda: upsert(e, "author", both.withColumn("id", both.id + 50))) == ["first_name"]
    # an identity whose attributes stay isn't looked at, and swapping two rows is no conflict
    swapped = spark.createDataFrame([(1, "Bob", None), (2, "Ada", "L")], "id long, first_name string, last_name string")
    assert update_many(e, "author", swapped).rows.count() == 3


def _with(spark, **changes):
    from dataclasses import replace

    base = engine(spark)
    resources = tuple(replace(r, **changes.get(r.name, {}), _index={}) for r in base.domain.resources)
    return base.with_values(domain=Domain(resources))


def test_defaults_of_each_row(spark):
    from tessera.schema import Attribute

    title = Attribute("title", source="title_column", default=call("uuid"))
    own = tuple(title if a.name == "title" else a for a in engine(spark).domain["post"].attributes)
    done = bulk_create(_with(spark, post={"attributes": own}), "post", spark.range(10, 13).toDF("id"))
    assert len({r["title"] for r in done.changed.collect()}) == 3
    late = tuple(Attribute("score", "integer", update_default=ref("score") + 1) if a.name == "score" else a for a in engine(spark).domain["post"].attributes)
    from tessera.plans.query import Query

    done = update_query(Query(_with(spark, post={"attributes": late}), "post").filter(ref("id") == 1), {"title": call("type", "t", to="string")})
    assert [(r["title"], r["score"]) for r in done.changed.collect()] == [("t", 4)]


def test_exclusions(spark):
    from pyspark.sql import functions as F

    from tessera.functions.ranges import make
    from tessera.schema import Attribute, Exclusion, Resource

    stays = lambda *rows: spark.createDataFrame(rows, "id long, room string, a long, b long").select("id", "room", make(F.col("a"), F.col("b")).alias("stay"))
    have = stays((1, "x", 0, 5), (2, "x", 5, 9), (3, "y", 0, None))
    booking = Resource("booking", (Attribute("id", "integer", primary_key=True), Attribute("room"), Attribute("stay", "map")), table="bookings", exclusions=(Exclusion("no_overlap", ("room",), "stay"),))
    e = Engine(spark, Domain((booking,)), {"default": lambda table, tenant: have})
    assert bulk_create(e, "booking", stays((4, "x", 9, 12), (5, "z", 0, 9), (6, None, 0, 9), (7, "x", 3, 3))).rows.count() == 7
    for bad in [(4, "x", 4, 6)], [(4, "y", 100, 101)], [(4, "z", 1, 3), (5, "z", 2, 4)], [(4, "x", None, 1)]:
        assert _broken(lambda bad=bad: bulk_create(e, "booking", stays(*bad))) == ["stay"]


def test_write_policies(spark):
    from tessera.expr import actor
    from tessera.plans.query import Query

    e = _with(spark, post={"write_policy": ref("author_id") == actor("id")}).with_values(actor={"id": 1})
    assert sorted(r["id"] for r in update_query(Query(e, "post"), {"title": call("type", "t", to="string")}).changed.collect()) == [1, 2]
    assert sorted(r["id"] for r in destroy_query(Query(e, "post")).changed.collect()) == [1, 2]
    own = spark.createDataFrame([(9, 1)], "id long, author_id long")
    assert bulk_create(e, "post", own).rows.count() == 5
    assert _broken(lambda: bulk_create(e, "post", own.withColumn("author_id", own.author_id + 1))) == [""]
    over = _with(spark, post={"write_policy": ref("author.first_name") == "Ada"})
    assert bulk_create(over, "post", own).rows.count() == 5
    assert _broken(lambda: bulk_create(over, "post", own.withColumn("author_id", own.author_id + 1))) == [""]


def test_optimistic_locks(spark):
    from tessera.operators.mutate import optimistic

    q = query(spark, "post").filter(ref("id") == 1)
    assert update(*optimistic(q, "score", 3)).changed.first()["score"] == 4
    with pytest.raises(StaleRecord):
        update(*optimistic(q, "score", 2))
    with pytest.raises(StaleRecord):
        destroy(optimistic(q, "score", 2)[0])


def test_reads_and_mutations_from_two_repos(spark):
    e = _with(spark, post={"mutate_repo": "primary"})
    rows = e.repos["default"]("posts", None)
    e = e.with_values(repos={**e.repos, "primary": lambda table, tenant: rows.filter("id < 3") if table == "posts" else e.repos["default"](table, tenant)})
    from tessera.plans.query import Query

    assert Query(e, "post").to_df().count() == 4
    assert update_query(Query(e, "post").filter(ref("id") > 1), {"title": call("type", "t", to="string")}).changed.count() == 1


def test_order_of_many_partitions(spark):
    given = spark.range(1000, 1100, numPartitions=7).toDF("id")
    done = in_input_order(bulk_create(engine(spark), "post", given)).orderBy("_ordinal").collect()
    assert [(r["id"], r["_ordinal"]) for r in done] == [(1000 + k, k) for k in range(100)]
