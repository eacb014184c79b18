"""Partial results along chains against counting all paths, the sizes of plans, and what few rows read."""

import random

import pytest
from pyspark.sql import functions as F

from meshlark import Aggregate as A
from meshlark import Attribute, Domain, Graph, Query, Relationship, Resource, attr, traverse
from meshlark.operators import aggregates, factored
from meshlark.operators.paths import Path, repeats, resolve

D = Domain("D")
ONE = Resource("One", (Attribute("id", "integer", "id"), Attribute("mid_id", "integer", "mid_id")), domain=D, relationships=(Relationship("mid", "Mid", "one", "IN_MID", "out", "mid_id"),))
MID = Resource("Mid", (Attribute("id", "integer", "id"),), domain=D, relationships=(Relationship("many", "Many", "many", "OF_MID", "in"), Relationship("ones", "One", "many", "IN_MID", "in")))
MANY = Resource("Many", (Attribute("id", "integer", "id"), Attribute("mid_id", "integer", "mid_id")), domain=D, relationships=(Relationship("far", "Far", "many", "FAR"), Relationship("mid", "Mid", "one", "OF_MID", "out", "mid_id")))
FAR = Resource("Far", (Attribute("id", "integer", "id"), Attribute("v", "float"), Attribute("w", "integer"), Attribute("name"), Attribute("last_id", "string", "last_id")), domain=D, relationships=(Relationship("last", "Last", "one", "TO_LAST", "out", "last_id"),))
LAST = Resource("Last", (Attribute("id", "string", "id"), Attribute("size", "integer")), domain=D)


@pytest.fixture(scope="module")
def tables():
    r = random.Random(3)
    ones = [(k, r.choice([None, *range(6)])) for k in range(60)]
    many = [(k, r.choice([None, *range(5)])) for k in range(40)]
    last = [(f"l{k}", r.choice([None, 1, 2, 3])) for k in range(9)]
    far = [(k * 37 - 90, r.choice([None, float(r.randint(-9, 9))]), r.choice([None, r.randint(0, 5)]), r.choice([None, "x", "y"]), r.choice([None, "l1", "l2", "l7"])) for k in range(30)]
    pairs = [(r.randrange(40), r.choice(far)[0]) for _ in range(150)]
    return ones, [(k,) for k in range(7)], many, far, last, pairs


@pytest.fixture(scope="module")
def graph(spark, tables):
    ones, mids, many, far, last, pairs = tables
    g = Graph(spark)
    g.add(ONE, spark.createDataFrame(ones, "id long, mid_id long")).add(MID, spark.createDataFrame(mids, "id long")).add(MANY, spark.createDataFrame(many, "id long, mid_id long"))
    g.add(FAR, spark.createDataFrame(far, "id long, v double, w long, name string, last_id string")).add(LAST, spark.createDataFrame(last, "id string, size long"))
    g.key_edge("IN_MID", "One", "Mid", "mid_id").key_edge("OF_MID", "Many", "Mid", "mid_id").key_edge("TO_LAST", "Far", "Last", "last_id")
    return g.pair_edge("FAR", "Many", "Far", spark.createDataFrame(pairs, "src long, dst long"))


def walked(tables, to_last=False):
    """For each of ones the far (or last) rows at the ends of its paths, repeats included."""
    ones, _, many, far, last, pairs = tables
    rows, lasts = {f[0]: f for f in far}, {x[0]: x for x in last}
    out = {k: [rows[d] for m, own in many if mid is not None and own == mid for s, d in pairs if s == m] for k, mid in ones}
    return {k: [lasts[f[4]] for f in ends if f[4] is not None] for k, ends in out.items()} if to_last else out


PATH = ("mid", "many", "far")


def test_every_measure_is_that_of_all_paths(graph, tables):
    aggs = [
        A("n", "count", PATH), A("u", "count", PATH, uniq=True), A("some", "count", PATH, filter=attr("w") > 2), A("us", "count", PATH, filter=attr("w") > 2, uniq=True), A("has", "exists", PATH, filter=attr("name") == "y"),
        A("s", "sum", PATH, "v"), A("e", "sum", PATH, expr=attr("w") * 2), A("a", "avg", PATH, "w"), A("lo", "min", PATH, "v"), A("hi", "max", PATH, "name"), A("f", "first", PATH, "name"), A("l", "list", PATH, "w"), A("su", "sum", PATH, "w", uniq=True),
    ]
    found = {r["id"]: r for r in Query(graph, "One").aggregate(*aggs).df().collect()}
    assert len(found) == 60
    for k, ends in walked(tables).items():
        r, v, w = found[k], [f[1] for f in ends if f[1] is not None], [f[2] for f in ends if f[2] is not None]
        names = sorted((f[0], f[3]) for f in ends if f[3] is not None)
        assert (r["n"], r["u"]) == (len(ends), len({f[0] for f in ends}))
        assert (r["some"], r["us"]) == (sum(x > 2 for x in w), len({f[0] for f in ends if f[2] is not None and f[2] > 2}))
        assert r["has"] == any(f[3] == "y" for f in ends) and r["s"] == sum(v) and r["e"] == (2 * sum(w) if w else None)
        assert (r["a"] is None) == (not w) and (not w or abs(r["a"] - sum(w) / len(w)) < 1e-9)
        assert r["lo"] == min(v, default=None) and r["hi"] == max((x for _, x in names), default=None) and r["f"] == (names[0][1] if names else None)
        assert sorted(r["l"]) == sorted(w) and r["su"] == sum(set(w))


def test_hops_to_owners_at_the_end_and_keys_that_are_text(graph, tables):
    path = (*PATH, "last")
    found = {r["id"]: r for r in Query(graph, "One").aggregate(A("n", "count", path), A("u", "count", path, uniq=True), A("z", "max", path, "size")).df().collect()}
    for k, ends in walked(tables, True).items():
        assert (found[k]["n"], found[k]["u"], found[k]["z"]) == (len(ends), len({x[0] for x in ends}), max((x[1] for x in ends if x[1] is not None), default=None))


def test_totals_filters_and_traversals(graph, tables):
    ends = walked(tables)
    kept = [k for k, mid in tables[0] if mid is not None and mid >= 2]
    all_ends = [f for k in kept for f in ends[k]]
    q = Query(graph, "One").filter(attr("mid_id") >= 2)
    total = q.total(A("n", "count", PATH), A("s", "sum", PATH, "v"), A("a", "avg", PATH, "w"), A("f", "first", PATH, "name")).first()
    w = [f[2] for f in all_ends if f[2] is not None]
    assert total["n"] == len(all_ends) and total["s"] == sum(f[1] for f in all_ends if f[1] is not None) and abs(total["a"] - sum(w) / len(w)) < 1e-9
    assert total["f"] == min((f[0], f[3]) for f in all_ends if f[3] is not None)[1]
    none = Query(graph, "One").filter(attr("id") < 0).total(A("n", "count", PATH), A("s", "sum", PATH, "v"), A("m", "max", PATH, "v")).first()
    assert tuple(none) == (0, 0, None)
    ids = lambda q: sorted(r["id"] for r in q.df().select("id").collect())
    assert ids(Query(graph, "One").filter(traverse(*PATH).count() > 9)) == sorted(k for k, e in ends.items() if len({f[0] for f in e}) > 9)
    assert ids(Query(graph, "One").filter(traverse(*PATH).count() == 0)) == sorted(k for k, e in ends.items() if not e)
    means = {k: [f[2] for f in e if f[2] is not None] for k, e in ends.items()}
    assert ids(Query(graph, "One").filter(traverse(*PATH).avg("w") > 2.4)) == sorted(k for k, w in means.items() if w and sum(w) / len(w) > 2.4)
    assert {r["id"]: r["n"] for r in q.aggregate(A("n", "count", PATH)).df().collect()} == {k: len(ends[k]) for k in kept}


def metrics(df):
    """Rows that each step of the executed plan gave."""
    df.collect()
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
        if node.metrics().contains("numOutputRows"):
            out.append((name, node.metrics().apply("numOutputRows").value()))
    return out


def test_no_step_has_more_rows_than_a_hop_has_edges(spark):
    """200 sources share 2 middles, each with 200 of many, each with 5 far nodes: 200,000 paths, 2,000 edges at most."""
    g = Graph(spark)
    g.add(ONE, spark.range(200).selectExpr("id", "id % 2 as mid_id")).add(MID, spark.range(2).toDF("id")).add(MANY, spark.range(400).selectExpr("id", "id % 2 as mid_id"))
    g.add(FAR, spark.range(50).selectExpr("id", "cast(id as double) as v", "id as w", "'x' as name", "cast(null as string) as last_id")).add(LAST, spark.createDataFrame([], "id string, size long"))
    g.key_edge("IN_MID", "One", "Mid", "mid_id").key_edge("OF_MID", "Many", "Mid", "mid_id").key_edge("TO_LAST", "Far", "Last", "last_id")
    g.pair_edge("FAR", "Many", "Far", spark.range(2000).selectExpr("id % 400 as src", "id % 50 as dst"))
    df = Query(g, "One").aggregate(A("n", "count", PATH), A("s", "sum", PATH, "v"), A("u", "count", PATH, uniq=True)).df()
    made = metrics(df)
    assert made and max(n for _, n in made) <= 2000, made
    assert df.agg(F.sum("n")).first()[0] == 200_000 and {r["u"] for r in df.select("u").collect()} == {25}
    assert factored.applies(Path(g, "One", resolve(g, "One", tuple(("forward", h) for h in PATH))[0]).steps)


def test_chains_that_use_an_edge_twice_are_followed(graph, tables):
    steps = resolve(graph, "One", (("forward", "mid"), ("forward", "ones")))[0]
    assert not factored.applies(steps) and not factored.applies(resolve(graph, "One", (("forward", "mid"),))[0])
    mids = dict(tables[0])
    found = {r["id"]: r["n"] for r in Query(graph, "One").aggregate(A("n", "count", ("mid", "ones"))).df().collect()}
    assert found == {k: sum(m == mid and j != k for j, m in mids.items()) if mid is not None else 0 for k, mid in mids.items()}


def test_few_rows_read_only_their_edges(graph, tables):
    df = Query(graph, "Mid").sort("id").offset(1).limit(2).aggregate(A("n", "count", ("many",))).load("many").load_along("far", "many", "far", limit=2).df()
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 3 and "broadcast" in plan
    pairs, many = tables[5], tables[2]
    for r in df.collect():
        own = [k for k, m in many if m == r["id"]]
        assert r["n"] == len(own) and [x["id"] for x in r["many"]] == sorted(own)
        assert [x["id"] for x in r["far"]] == sorted({d for s, d in pairs if s in own})[:2]


def test_ties_at_a_limit_are_settled_by_keys(spark):
    g = Graph(spark)
    g.add(MID, spark.range(500).repartition(7).toDF("id")).add(MANY, spark.range(2000).repartition(5).selectExpr("id", "id % 500 as mid_id")).key_edge("OF_MID", "Many", "Mid", "mid_id")
    for q in (Query(g, "Mid").limit(20), Query(g, "Mid").sort((attr("id") * 0, "asc")).limit(20)):
        assert {r["id"]: r["n"] for r in q.aggregate(A("n", "count", ("many",))).df().collect()} == dict.fromkeys(range(20), 4)


def test_duplicates_are_looked_for_only_where_chains_can_repeat_a_node(graph):
    way = lambda resource, *hops: resolve(graph, resource, tuple(("forward", h) for h in hops))[0]
    assert not repeats(way("One", "mid", "many")) and not repeats(way("Mid", "many")) and repeats(way("Many", "far")) and repeats(way("Mid", "ones", "mid"))
    plan = Query(graph, "Mid").load_along("x", "many", limit=2).df()._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Aggregate") == 1
    assert aggregates.moves(A("n", "count", PATH)) and not aggregates.moves(A("n", "list", PATH, "w"))


def test_kinds_of_ones_own_move_along_chains(graph, tables):
    from meshlark.functions import sketches
    from meshlark.schema import Mergeable

    widest = Mergeable(lambda v: F.struct(F.min(v).alias("a"), F.max(v).alias("b")), lambda s: F.struct(F.min(s["a"]).alias("a"), F.max(s["b"]).alias("b")), lambda s: s["b"] - s["a"])
    ends = walked(tables)
    for path, steps in ((PATH, ends), (("mid", "many"), None)):
        if steps is None:
            many, mids = tables[2], dict(tables[0])
            found = {r["id"]: r["w"] for r in Query(graph, "One").aggregate(A("w", widest, path, "id")).df().collect()}
            for k, mid in mids.items():
                own = [m for m, x in many if mid is not None and x == mid]
                assert found[k] == (max(own) - min(own) if own else None)
            continue
        aggs = A("w", widest, path, "v"), A("q", sketches.quantile(0.5), path, "v"), A("d", sketches.distinct(), path, "w")
        rows = {r["id"]: r for r in Query(graph, "One").aggregate(*aggs).df().collect()}
        for k, e in steps.items():
            v, w = sorted(f[1] for f in e if f[1] is not None), {f[2] for f in e if f[2] is not None}
            assert rows[k]["w"] == (v[-1] - v[0] if v else None) and (rows[k]["d"] or 0) == len(w)
            assert (rows[k]["q"] is None) == (not v) and (not v or v[max(0, (len(v) - 1) // 2 - 1)] <= rows[k]["q"] <= v[min(len(v) - 1, len(v) // 2 + 1)])
    total = Query(graph, "One").total(A("w", widest, PATH, "v"), A("d", sketches.distinct(), PATH, "w")).first()
    every = [f for e in ends.values() for f in e]
    assert total["w"] == max(f[1] for f in every if f[1] is not None) - min(f[1] for f in every if f[1] is not None) and total["d"] == len({f[2] for f in every if f[2] is not None})
