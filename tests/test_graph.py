"""Goldens on small graphs: predicates, traversals, aggregates, combinations, loads."""

import pytest

from meshlark import Aggregate as A
from meshlark import Attribute, Calculation, Domain, Graph, Query, Relationship, Resource, attr, calc, combine, exists, func, traverse
from meshlark.errors import UnresolvableTraversal

BLOG = Domain("Blog")
AUTHOR = Resource("Author", (Attribute("id"), Attribute("name"), Attribute("pen_name", source="writerAlias")), domain=BLOG, relationships=(Relationship("posts", "Post", "many", "WROTE"),))
POST = Resource(
    "Post", (Attribute("id"), Attribute("title"), Attribute("score", "integer"), Attribute("author_id", source="author_uuid")), domain=BLOG,
    relationships=(Relationship("author", "Author", "one", "WROTE", "in", "author_id"), Relationship("comments", "Comment", "many", "BELONGS_TO", "in"), Relationship("tags", "Tag", "many", "TAGS", "in")),
    calculations=(Calculation("double", lambda c: c("score") * 2),),
)
COMMENT = Resource("Comment", (Attribute("id"), Attribute("title"), Attribute("score", "integer"), Attribute("post_id", source="post_uuid")), domain=BLOG, relationships=(Relationship("post", "Post", "one", "BELONGS_TO", "out", "post_id"),))
TAG = Resource("Tag", (Attribute("id"), Attribute("value", "ci_string")), domain=BLOG, relationships=(Relationship("posts", "Post", "many", "TAGS"),))


@pytest.fixture(scope="module")
def blog(spark):
    g = Graph(spark)
    g.add(AUTHOR, spark.createDataFrame([("a1", "Alice", "Ghost"), ("a2", "Bob", None), ("a3", "Carol", None)], "uuid string, name string, writerAlias string"))
    g.add(POST, spark.createDataFrame([("p1", "post1", 90, "a1"), ("p2", "post2", 10, "a2"), ("p3", "post3", None, "a2"), ("p4", "loose", 5, None)], "uuid string, title string, score long, author_uuid string"))
    g.add(COMMENT, spark.createDataFrame([("c1", "alpha", 10, "p1"), ("c2", "beta", 25, "p1"), ("c3", "alpha", 100, "p2"), ("c4", None, None, "p2")], "uuid string, title string, score long, post_uuid string"))
    g.add(TAG, spark.createDataFrame([("t1", "Red"), ("t2", "blue")], "uuid string, value string"))
    g.pair_edge("WROTE", "Author", "Post", g.frame("Post").where("author_uuid is not null").selectExpr("author_uuid as src", "uuid as dst"))
    g.key_edge("BELONGS_TO", "Comment", "Post", "post_uuid")
    return g.pair_edge("TAGS", "Tag", "Post", spark.createDataFrame([("t1", "p1"), ("t2", "p1"), ("t2", "p2")], "src string, dst string"))


def ids(q):
    df = q.df() if isinstance(q, Query) else q
    return sorted(r["id"] for r in df.select("id").collect())


def test_predicates(blog):
    p = Query(blog, "Post")
    assert ids(p.filter(attr("score") != 10)) == ["p1", "p4"]
    assert ids(p.filter(attr("title").isin(["post1", "post2"]))) == ["p1", "p2"]
    assert ids(p.filter(attr("title") > "post1")) == ["p2", "p3"]
    assert ids(p.filter(attr("score").is_nil())) == ["p3"]
    assert ids(p.filter((attr("score") < 6) | (attr("score") > 50))) == ["p1", "p4"]
    assert ids(p.filter(attr("title").isin([]))) == []
    assert ids(Query(blog, "Tag").filter(attr("value") == "RED")) == ["t1"]
    assert ids(Query(blog, "Tag").filter(attr("value").isin(["red", "BLUE"]))) == ["t1", "t2"]
    assert ids(p.filter(calc("double") > 15)) == ["p1", "p2"]


def test_sort_null_order_offset_limit(blog):
    p = Query(blog, "Post")
    assert [r["id"] for r in p.sort("score").df().collect()] == ["p4", "p2", "p1", "p3"]
    assert [r["id"] for r in p.sort(("score", "desc")).df().collect()] == ["p3", "p1", "p2", "p4"]
    assert [r["id"] for r in p.sort(("score", "desc_nulls_last")).offset(1).limit(2).df().collect()] == ["p2", "p4"]
    assert [r["id"] for r in p.sort((calc("double"), "asc_nulls_first"), "id").limit(1).df().collect()] == ["p3"]


def test_traversals(blog):
    a, p = Query(blog, "Author"), Query(blog, "Post")
    assert ids(a.filter(traverse("posts").field("score") > 50)) == ["a1"]
    assert ids(a.filter(traverse("posts", "comments").field("score") == 100)) == ["a2"]
    assert ids(a.filter(traverse("posts").exists())) == ["a1", "a2"]
    assert ids(a.filter(~traverse("posts").exists())) == ["a3"]
    assert ids(a.filter(traverse("posts").count() == 0)) == ["a3"]
    assert ids(a.filter(traverse("posts").sum("score") < 20)) == ["a2", "a3"]
    assert ids(a.filter(traverse("posts").min("score") > 0)) == ["a1", "a2"]
    assert ids(a.filter(traverse("posts").max("score") <= 50)) == ["a2"]
    assert ids(p.filter(traverse(("reverse", ("WROTE", "Author"))).field("pen_name") == "Ghost")) == ["p1"]
    assert ids(p.filter(traverse("author").field("pen_name") == "Ghost")) == ["p1"]
    assert ids(p.filter(~(traverse("comments").field("title") == "alpha") & (attr("score") < 50))) == ["p4"]
    assert ids(p.filter((traverse("tags").count() > 1) | (attr("title") == "loose"))) == ["p1", "p4"]
    assert ids(p.filter(exists("comments", (attr("title") == "alpha") & (attr("score") > 50)))) == ["p2"]


def test_an_edge_is_used_once(blog):
    # a tag's posts' tags: the way back over the same edge does not count
    assert ids(Query(blog, "Tag").filter(traverse("posts", "tags").field("value") == "blue")) == ["t1"]
    assert ids(Query(blog, "Post").filter(traverse("tags", "posts").exists())) == ["p1", "p2"]
    assert ids(Query(blog, "Comment").filter(traverse("post", "comments").exists())) == ["c1", "c2", "c3", "c4"]
    # one comment alone cannot reach itself
    one = Query(blog, "Comment").filter((attr("id") == "c3") & (traverse("post", "comments").field("id") == "c3"))
    assert ids(one) == []


@pytest.mark.parametrize(
    ("test", "reason"),
    [(traverse("nothing").exists(), "unresolved_hop"), (traverse().exists(), "empty_chain"), (traverse(("forward", ("WROTE", "Nobody"))).exists(), "unresolved_reached"), (traverse("posts").field("nothing") == 1, "unmapped_property")],
)
def test_unresolvable(blog, test, reason):
    with pytest.raises(UnresolvableTraversal) as e:
        Query(blog, "Author").filter(test).df()
    assert e.value.reason == reason


def test_aggregates(blog):
    aggs = [A("n", "count", ("comments",)), A("any", "exists", ("comments",)), A("s", "sum", ("comments",), "score"), A("alpha", "count", ("comments",), filter=attr("title") == "alpha"), A("titles", "list", ("comments",), "title"), A("first", "first", ("comments",), "title"), A("e", "sum", ("comments",), expr=attr("score") + 1), A("mean", "avg", ("comments",), "score")]
    rows = {r["id"]: r for r in Query(blog, "Post").aggregate(*aggs).df().collect()}
    p1, p2, p4 = rows["p1"], rows["p2"], rows["p4"]
    assert (p1["n"], p1["any"], p1["s"], p1["alpha"], p1["titles"], p1["first"], p1["e"], p1["mean"]) == (2, True, 35, 1, ["alpha", "beta"], "alpha", 37, 17.5)
    assert (p2["n"], p2["s"], p2["titles"]) == (2, 100, ["alpha"])
    assert (p4["n"], p4["any"], p4["s"], p4["alpha"], p4["titles"], p4["first"], p4["e"], p4["mean"]) == (0, False, 0, 0, [], None, None, None)


def test_totals(blog):
    r = Query(blog, "Post").filter(attr("score") > 7).total(A("n", "count", ("comments",)), A("m", "max", ("comments",), "score"), A("posts", "count")).first()
    assert (r["n"], r["m"], r["posts"]) == (4, 100, 2)
    r = Query(blog, "Post").filter(attr("score") > 1000).total(A("any", "exists", ("comments",)), A("found", "exists")).first()
    assert (r["any"], r["found"]) == (False, False)


def test_combinations(blog):
    a = Query(blog, "Author")
    alice, bob = a.filter(attr("name") == "Alice"), a.filter(attr("name") == "Bob")
    assert ids(combine(("base", alice), ("union", bob), ("except", alice))) == ["a2"]
    assert ids(combine(("base", alice), ("union_all", alice))) == ["a1"]
    assert ids(combine(("base", alice), ("union_all", alice), raw=True)) == ["a1", "a1"]
    assert ids(combine(("base", a), ("intersect", bob))) == ["a2"]
    with pytest.raises(ValueError):
        combine(("union", alice))


def test_loads_and_projection(blog):
    rows = {r["id"]: r for r in Query(blog, "Post").load("author", "comments").project("by", (("forward", "author"),)).df().collect()}
    assert rows["p1"]["author"]["name"] == "Alice" and [c["id"] for c in rows["p1"]["comments"]] == ["c1", "c2"]
    assert rows["p4"]["author"] is None and rows["p4"]["comments"] == [] and rows["p4"]["by"] is None
    assert rows["p1"]["by"]["status"] == "concrete" and rows["p1"]["by"]["resource"] == "Author"


def test_plans_are_joins_that_push_down(spark, capsys, tmp_path):
    from meshlark import testgraph

    g = testgraph.load(spark, "/root/testdata/sf0.001")
    q = Query(g, "Customer").filter(traverse("orders", "items").field("quantity") >= 49)
    q.df().select("id").explain("formatted")
    text = capsys.readouterr().out
    assert "LeftSemi" in text and "GreaterThanOrEqual(l_quantity,49" in text and "l_comment" not in text
    assert q.df().count() == 116
    Query(g, "Nation").filter(traverse("region").field("name") == "ASIA").df().explain()
    assert capsys.readouterr().out.count("FileScan parquet") == 2
    Query(g, "Order").sort(("total", "desc"), "id").limit(3).df().explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_func_and_keys(blog, spark):
    from pyspark.sql import functions as F

    q = Query(blog, "Post").by_keys(spark.createDataFrame([("p1",), ("p9",)], "id string")).calculate(t=func(F.upper, attr("title")))
    assert [r["t"] for r in q.df().collect()] == ["POST1"]
    assert blog.sql("SELECT count(*) AS n FROM Post WHERE score > :s", s=50).first()["n"] == 1
