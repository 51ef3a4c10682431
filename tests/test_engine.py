"""Semantics that need nulls: filters, sorts, aggregates, loads, combinations, tenants."""

import pytest

from tessera.errors import PlanError
from tessera.expr import Agg, Lazy, actor, agg, call, cond, context, exists, fragment, map_of, parent, ref
from tessera.operators.load import load_related, summarise_related
from tessera.plans.query import Query
from tessera.schema import Attribute, Resource
from tests.blog import engine, ids, query


def value(spark, expression):
    return engine(spark).evaluate(expression)


def test_source_name_and_default_projection(spark):
    assert query(spark, "post").to_df().columns == ["id", "title", "score", "author_id", "category", "status"]
    assert "bio" not in query(spark, "author").to_df().columns


def test_null_order(spark):
    by = lambda key: ids(query(spark, "post").sort(key, "id").to_df())
    assert by("score") == [3, 1, 4, 2]
    assert by("-score") == [2, 1, 4, 3]
    assert by(("score", "asc_nils_first")) == [2, 3, 1, 4]
    assert by(("score", "desc_nils_last")) == [1, 4, 3, 2]


def test_is_nil_takes_no_zero(spark):
    assert ids(query(spark, "comment").filter(ref("likes").is_nil()).to_df()) == [2]
    assert sorted(ids(query(spark, "comment").filter(~ref("likes").is_nil()).to_df())) == [1, 3, 4, 5, 6]


def test_to_one_path_keeps_rows_without_a_relative_under_or(spark):
    found = query(spark, "post").filter((ref("author.first_name") == "Bob") | ref("author_id").is_nil()).sort("id").to_df()
    assert ids(found) == [3, 4]


def test_several_matching_children_give_the_row_once(spark):
    assert ids(query(spark, "post").filter(ref("comments.likes") > 1).sort("id").to_df()) == [1, 2]


def test_exists_kinds(spark):
    q = query(spark, "post")
    assert ids(q.filter(~exists("comments")).sort("id").to_df()) == [3, 4]
    assert ids(q.filter(exists("comments", ref("likes") > parent("score"))).to_df()) == [1]
    assert ids(q.filter(exists("higher")).to_df()) == [3]
    assert ids(q.filter(exists("linked", ref("title") == "gamma")).sort("id").to_df()) == [1, 2]
    assert [r["busy"] for r in q.sort("id").select("id", "busy").to_df().collect()] == [True, True, False, False]


def test_aggregates_with_nulls(spark):
    out = (
        query(spark, "post").sort("id").select("id").aggregate(
            n=agg("count", "comments"), likes=agg("count", "comments", "likes"), total=agg("sum", "comments", "likes"),
            none=agg("sum", "comments", "likes", default=0), first=agg("first", "comments", "title", sort=("title",)),
            first_nil=agg("first", "comments", "title", sort=(("title", "asc_nils_first"),), include_nil=True),
            titles=agg("list", "comments", "title", sort=("-title",)), with_nil=agg("list", "comments", "title", sort=("id",), include_nil=True),
            any=agg("exists", "comments", where=ref("likes") > 5), popular=agg("count", "popular"),
        ).to_df().collect()
    )
    assert [r["n"] for r in out] == [3, 2, 0, 0]
    assert [r["likes"] for r in out] == [2, 2, 0, 0]
    assert [r["total"] for r in out] == [7, 7, None, None]
    assert [r["none"] for r in out] == [7, 7, 0, 0]
    assert [r["first"] for r in out] == ["a", "a", None, None]
    assert [r["first_nil"] for r in out] == ["a", None, None, None]
    assert [r["titles"] for r in out] == [["c", "b", "a"], ["a"], [], []]
    assert [r["with_nil"] for r in out] == [["c", "a", "b"], [None, "a"], [], []]
    assert [r["any"] for r in out] == [False, True, False, False]
    assert [r["popular"] for r in out] == [2, 1, 0, 0]


def test_aggregates_of_one_path_share_a_join(spark):
    q = query(spark, "post").aggregate(a=agg("count", "comments"), b=agg("sum", "comments", "likes"), c=agg("max", "comments", "likes"))
    plan = q.to_df()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_two_paths_do_not_multiply(spark):
    out = query(spark, "post").filter(ref("id") == 1).aggregate(a=agg("count", "comments"), b=agg("count", "linked")).select("id").to_df().first()
    assert (out["a"], out["b"]) == (3, 2)


def test_nested_and_related_aggregates(spark):
    out = query(spark, "author").sort("id").aggregate(best=agg("max", "posts", "score"), comments=agg("count", "posts.comments")).select("id", "post_count").to_df().collect()
    assert [(r["post_count"], r["best"], r["comments"]) for r in out] == [(2, 3, 5), (1, 1, 0), (0, None, 0)]
    out = query(spark, "post").sort("id").select("id").calculate(n=ref("author.post_count")).to_df().collect()
    assert [r["n"] for r in out] == [2, 2, 1, 0]


def test_query_aggregates(spark):
    row = query(spark, "comment").sort("id").limit(3).summarise(n=Agg("count"), likes=agg("sum", of="likes"), lots=agg("count", where=ref("likes") > 4)).first()
    assert row.asDict() == {"n": 3, "likes": 7, "lots": 1}


def test_loads(spark):
    q = query(spark, "post")
    rows = load_related(q, "comments", Query(q.engine, "comment").sort("-likes").limit(2).select("id"))
    found = {(r["__source_id"], r["__order__"]): r["id"] for r in rows.collect()}
    assert found == {(1, 1): 2, (1, 2): 1, (2, 1): 5, (2, 2): 4}
    nested = query(spark, "author").sort("id").select("id").load("posts", Query(q.engine, "post").sort("id").select("id").load("comments", Query(q.engine, "comment").sort("id").select("id")))
    first, second, third = nested.to_df().collect()
    assert [p["id"] for p in first["posts"]] == [1, 2]
    assert [[c["id"] for c in p["comments"]] for p in first["posts"]] == [[1, 2, 3], [4, 5]]
    assert third["posts"] == []
    one = load_related(query(spark, "author"), "first_post")
    assert sorted((r["__source_id"], r["id"]) for r in one.collect()) == [(1, 1), (2, 3)]
    higher = load_related(q, "higher", Query(q.engine, "post").sort("-score", "id").limit(1).select("id"))
    assert [(r["__source_id"], r["id"]) for r in higher.collect()] == [(3, 1)]


def test_no_key_is_an_error(spark):
    with pytest.raises(PlanError):
        load_related(query(spark, "view"), "posts")
    with pytest.raises(PlanError):
        Resource("x", (Attribute("a"),), table="x").row_key()


def test_distinct_rules(spark):
    q = query(spark, "post").filter(~ref("score").is_nil()).distinct("score")
    assert ids(q.distinct_sort("-title").sort("negative_score").to_df()) == [4, 3]
    assert ids(q.distinct_sort("title").sort("negative_score").to_df()) == [1, 3]
    assert ids(q.sort(("title", "desc_nils_last")).limit(1).to_df()) == [3]


def test_keyset_with_nulls(spark):
    q = query(spark, "post").sort("score", "id")
    assert ids(q.after(3, 1).to_df()) == [4, 2]
    assert ids(q.after(None, 1).to_df()) == [2]
    assert ids(query(spark, "post").sort("-score", "id").after(None, 2).to_df()) == [1, 4, 3]


def test_combinations(spark):
    q = query(spark, "post").select("id")
    low, high = q.filter(ref("id") < 3), q.filter(ref("id") > 1)
    assert sorted(ids(low.union_all(high).to_df())) == [1, 2, 2, 3, 4]
    assert sorted(ids(low.union(high).to_df())) == [1, 2, 3, 4]
    assert ids(low.intersect(high).to_df()) == [2]
    assert ids(low.except_(high).to_df()) == [1]
    assert sorted(ids(low.union(high).except_(low).to_df())) == [3, 4]
    assert ids(low.union(high).filter(ref("title") == "gamma").to_df()) == [3]
    with pytest.raises(PlanError):
        low.union(query(spark, "post").select("title")).to_df()


def test_tenants_and_tables(spark):
    assert [r["body"] for r in query(spark, "note", tenant="b").to_df().collect()] == ["two"]
    assert [r["body"] for r in query(spark, "memo", tenant="t2").to_df().collect()] == ["second"]
    for bad in (None, "../x"):
        with pytest.raises(PlanError):
            query(spark, "memo", tenant=bad).to_df()
    with pytest.raises(PlanError):
        query(spark, "rating").to_df()
    assert [r["score"] for r in query(spark, "rating", tables={"rating": "post_ratings"}).to_df().collect()] == [5]


def test_templates_and_lazy(spark):
    q = query(spark, "post", actor={"id": 2}, context={"least": 0})
    assert ids(q.filter((ref("author_id") == actor("id")) & (ref("score") > context("least"))).to_df()) == [3]
    assert ids(q.filter(ref("id") == Lazy(lambda: 4)).to_df()) == [4]
    with pytest.raises(PlanError):
        q.filter(ref("id") == actor("name")).to_df()


def test_hidden_calculations_are_in_a_struct(spark):
    row = query(spark, "author").filter(ref("id") == 1).calculate(secret=ref("secret")).select("id", "full_name").to_df().first()
    assert row["full_name"] == "Ada L" and row["calculations"]["secret"] == 3


def test_strings(spark):
    assert value(spark, call("string_position", "alpha", "a")) == 0
    assert value(spark, call("string_position", "alpha", "pha")) == 2
    assert value(spark, call("string_position", "alpha", "zzz")) is None
    assert value(spark, call("string_position", call("ci", "Alpha"), "PHA")) == 2
    assert value(spark, call("string_split", " a  b ", trim=True)) == ["a", "", "b"]
    assert value(spark, call("string_split", "  ", trim=True)) == []
    assert value(spark, call("string_split", "a.b", separator=".")) == ["a", "b"]
    assert value(spark, call("string_join", "a", None, "b", sep=", ")) == "a, b"
    assert value(spark, call("concat", "a", None)) is None
    assert value(spark, call("starts_with", "a%b", "a%")) is True
    assert value(spark, call("starts_with", "axb", "a%")) is False


def test_lists_and_logic(spark):
    assert value(spark, call("length", call("list"))) == 0
    assert value(spark, call("count_nils", call("list", 1, None, None))) == 2
    assert value(spark, call("at", call("list", 1, 2), 1)) == 2
    assert value(spark, call("at", call("list", 1, 2), 5)) is None
    assert value(spark, call("or_else", None, 3)) == 3
    assert value(spark, call("or_else", False, 3 == 3)) is False
    assert value(spark, call("truthy_or", False, True)) is True
    assert value(spark, call("and_then", None, 3)) is None
    assert value(spark, map_of(a=1, b=map_of(c=2))["b"]["c"]) == 2
    assert value(spark, call("round", call("type", "-2.50", to="decimal(4,2)"))) == -3
    assert value(spark, call("idiv", -7, 2)) == -3
    assert value(spark, fragment("concat(?, '\\?')", "x")) == "x?"


def test_errors_in_expressions(spark):
    assert value(spark, cond((call("is_nil", 1), call("error", "no")), otherwise=2)) == 2
    assert value(spark, call("required", False)) is False
    for bad in (call("error", "boom"), call("required", None, name="x")):
        with pytest.raises(Exception, match="boom|x is required"):
            value(spark, bad)


def test_time(spark):
    day = lambda s: call("type", s, to="timestamp")
    assert str(value(spark, call("datetime_add", day("2024-01-31"), 1, unit="month")))[:10] == "2024-02-29"
    assert str(value(spark, call("date_add", call("type", "2024-03-01", to="date"), -1, unit="day"))) == "2024-02-29"
    assert str(value(spark, call("start_of_day", day("2024-06-01 02:00:00"), zone="America/New_York"))) == "2024-05-31 04:00:00"
    assert value(spark, call("lt", call("ago", days=1, hours=2), call("now"))) is True


def test_ranges(spark):
    r = lambda a, b, **o: call("range", a, b, **o)
    assert value(spark, call("range_overlaps", r(1, 4), r(4, 6))) is False
    assert value(spark, call("range_overlaps", r(1, 4, upper_inc=True), r(4, 6))) is True
    assert value(spark, call("range_overlaps", r(None, None), r(4, 6))) is True
    assert value(spark, call("range_overlaps", r(5, 5), r(4, 6))) is False
    assert value(spark, call("range_contains", r(1, None), 10**6)) is True
    assert value(spark, call("range_contains_range", r(1, 9), r(2, 9))) is True
    assert value(spark, call("range_contains_range", r(1, 9), r(2, 9, upper_inc=True))) is False
    assert value(spark, call("range_contains_range", r(2, 3), r(5, 5))) is True
    assert value(spark, call("range_adjacent", r(1, 4), r(4, 6))) is True
    assert value(spark, call("range_adjacent", r(1, 4), r(5, 6))) is False
    assert value(spark, call("range_upper", r(1, 4, upper_inc=True, discrete=True))) == 5


def test_similarity_vectors_and_paths(spark):
    assert value(spark, call("trigram_similarity", "abcde", "abcdef")) == 0.625
    assert value(spark, call("vector_l2_distance", [0.0, 3.0], [4.0, 0.0])) == 5.0
    assert value(spark, call("vector_cosine_distance", [1.0, 0.0], [0.0, 2.0])) == 1.0
    assert value(spark, call("vector_cosine_distance", [0.0], [1.0])) is None
    path = lambda *s: call("list", *s)
    assert value(spark, call("path_is_ancestor", path("a"), path("a", "b"))) is True
    assert value(spark, call("path_is_ancestor", path("a", "c"), path("a", "b"))) is False
    assert value(spark, call("path_shared_root", path("a", "b", "c"), path("a", "b", "d"))) == ["a", "b"]
    assert value(spark, call("path_unescape", call("path_escape", "a b_ü"))) == "a b_ü"


def test_definition_errors(spark):
    with pytest.raises(PlanError):
        Resource("x", (Attribute("a"), Attribute("a")), table="x")
    with pytest.raises(PlanError):
        query(spark, "post").filter(ref("nothing") == 1).to_df()
    with pytest.raises(PlanError):
        query(spark, "post").filter(call("nothing", 1)).to_df()
    with pytest.raises(PlanError):
        query(spark, "post").calculate(x=ref("comments.likes") + 1).to_df()


def test_limit_comes_before_late_aggregates(spark):
    plan = query(spark, "post").sort("id").limit(1).aggregate(n=agg("count", "comments")).to_df()
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" in text.split("Join", 1)[1]
    assert plan.select("n").first()["n"] == 3




def test_case_insensitive_strings(spark):
    q = query(spark, "post")
    assert sorted(ids(q.filter(ref("category") == "NEWS").to_df())) == [1, 2]
    assert sorted(ids(q.filter(call("contains", ref("category"), "EW")).to_df())) == [1, 2]
    assert q.filter(~ref("category").is_nil()).distinct("category").to_df().count() == 2


def test_many_to_many_through_a_limited_join(spark):
    q = query(spark, "post")
    rows = load_related(q, "last_linked", Query(q.engine, "post").select("id")).collect()
    assert sorted((r["__source_id"], r["id"]) for r in rows) == [(1, 3), (2, 3)]


def test_aggregates_of_limited_loads(spark):
    q = query(spark, "post")
    out = summarise_related(q, "comments", Query(q.engine, "comment").sort("id").limit(2), n=agg("count"), likes=agg("sum", of="likes"))
    assert {r["__source_id"]: (r["n"], r["likes"]) for r in out.collect()} == {1: (2, 5), 2: (2, 7), 3: (0, None), 4: (0, None)}


def test_more_functions(spark):
    assert value(spark, call("trigram_word_similarity", "word", "two words")) == 0.8
    assert value(spark, call("text_match", "A quick fox, a dog", query="fox & (cat | dog) & !bird")) is True
    assert value(spark, call("text_match", "A quick fox", query="fox & cat")) is False
    with pytest.raises(ValueError, match="no text query"):
        value(spark, call("text_match", "x", query="a &"))
    later = call("type", "2024-01-31 00:00:00", to="timestamp") + call("duration", months=1, hours=1)
    assert str(value(spark, later)) == "2024-02-29 01:00:00"
    row = query(spark, "post").filter(ref("id") == 1).calculate(b=fragment("to_json(?)", call("binding"))).select("id").to_df().first()
    assert '"title":"alpha"' in row["b"]


def test_locks_are_accepted(spark):
    assert query(spark, "post").lock("for update nowait").to_df().count() == 4
    with pytest.raises(PlanError):
        query(spark, "post").lock("for fun")


def test_types(spark):
    from pyspark.sql import functions as F

    from tessera.types import enum_from_storage, enum_to_storage, spark_type

    assert spark_type("array<integer>") == "array<bigint>" and spark_type("decimal(9,2)") == "decimal(9,2)"
    with pytest.raises(PlanError):
        spark_type("nothing")
    codes = {"open": 0, "closed": 1}
    row = spark.range(1).select(enum_to_storage(F.lit("closed"), codes).alias("a"), enum_from_storage(F.lit(0), codes).alias("b")).first()
    assert (row["a"], row["b"]) == (1, "open")


def test_conditions_on_one_path_share_the_row(spark):
    q = query(spark, "post")
    c, likes = ref("comments.title"), ref("comments.likes")
    assert ids(q.filter((c == "a") & (likes > 1)).to_df()) == [2]
    assert ids(q.filter(c == "a", likes > 1).to_df()) == [2]
    assert ids(q.filter(c == "a").filter(likes > 1).to_df()) == [2]
    assert ids(q.filter((c == "c") & (likes == 2)).to_df()) == []
    # a condition that holds without a related row keeps rows that have none
    assert sorted(ids(q.filter((likes > 6) | (ref("score") == 1)).to_df())) == [2, 3]
    assert sorted(ids(q.filter(likes.is_nil()).to_df())) == [1, 2 + 1, 4]
    assert sorted(ids(q.filter(~(c == "a")).to_df())) == [1]


def test_exists_at_a_path_means_the_row_of_its_siblings(spark):
    q = query(spark, "post")
    linked = ref("linked.title")
    assert ids(q.filter(linked == "beta", exists("comments", ref("likes") > 6, at="linked")).to_df()) == [1]
    assert ids(q.filter(linked == "gamma", exists("comments", at="linked")).to_df()) == []
    assert sorted(ids(q.filter(linked == "gamma", ~exists("comments", at="linked")).to_df())) == [1, 2]
    assert sorted(ids(query(spark, "comment").filter(exists("linked", at="post")).to_df())) == [1, 2, 3, 4, 5]


def test_average_of_distinct_values(spark):
    out = query(spark, "author").sort("id").aggregate(a=agg("avg", "posts", "score", uniq=True), b=agg("avg", "posts", "score")).select("id").to_df().collect()
    assert [(r["a"], r["b"]) for r in out] == [(3.0, 3.0), (1.0, 1.0), (None, None)]
    one = query(spark, "comment").summarise(a=agg("avg", of=cond((ref("likes") > 1, 4), otherwise=0), uniq=True)).first()["a"]
    assert one == 2.0


def test_integer_division_is_exact(spark):
    assert value(spark, call("idiv", 9007199254740993, 1)) == 9007199254740993
    assert value(spark, call("idiv", -9007199254740993, 2)) == -4503599627370496
