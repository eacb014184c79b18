"""Joins by time, interval and place against brute force: ties, nulls, repeats, hot keys, poles and the date line."""

import random
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meshlark.functions import geo, shapes
from meshlark.operators import dealt, spatial
from meshlark.operators.asof import as_of
from meshlark.operators.intervals import overlapping
from meshlark.operators.nearest import nearest
from meshlark.operators.spatial import areas_meeting


@pytest.mark.parametrize("strict", [False, True])
def test_as_of(spark, strict):
    r = random.Random(1)
    day = datetime(2024, 1, 1)
    when = lambda: r.choice([None, *[day + timedelta(days=k) for k in range(12)]])
    # One key has most rows, so that it spans ranges, and some of these have left rows only.
    key = lambda: r.choice([None, "b", "hot", "hot", "hot", "hot", "z"])
    left = [(k, key(), when()) for k in range(400)] + [(1000 + k, "hot", day + timedelta(days=40, seconds=k)) for k in range(300)] + [(7, "b", day)] * 2
    right = [(key(), when(), r.choice([None, 1, 2, 3]), [str(k)]) for k in range(150)] + [("only", day, 1, ["x"])]
    a, b = spark.createDataFrame(left, "id long, k string, t timestamp"), spark.createDataFrame(right, "key string, at timestamp, n int, tags array<string>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = as_of(a, b, {"k": "key"}, ("t", "at"), "last", ("n", "tags"), strict).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    def expected(k, t):
        fits = [x for x in right if None not in (k, t, x[0], x[1]) and x[0] == k and (x[1] < t if strict else x[1] <= t)]
        return max(fits, key=lambda x: (x[1], x[2] is not None, x[2] or 0, x[3]), default=None)

    assert sorted((x.id, x.k, x.t, tuple(x.last) if x.last else None) for x in found if x.k and x.t) == sorted((i, k, t, expected(k, t)) for i, k, t in left if k and t)
    assert len(found) == len(left) and all(x.last is None for x in found if not (x.k and x.t))
    assert as_of(a, b.limit(0), {"k": "key"}, ("t", "at"), "last").where("last is not null").count() == 0 and as_of(a.limit(0), b, {"k": "key"}, ("t", "at"), "last").count() == 0


def test_dealt_join(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, x string")
    right = spark.range(500).selectExpr("if(id < 400, 1, cast(id % 4 as int)) as k", "id as y")
    want = sorted(map(tuple, left.join(right, ["k"]).collect()))
    assert sorted(map(tuple, dealt.dealt_join(left, right, ["k"], 50).collect())) == want and sorted(map(tuple, dealt.dealt_join(left, right, ["k"]).collect())) == want


@pytest.mark.parametrize("closed", [True, False])
def test_intervals_that_overlap(spark, monkeypatch, closed):
    monkeypatch.setattr(dealt, "ROWS", 20)
    monkeypatch.setattr(dealt.dealt_join, "__defaults__", (20,))
    r = random.Random(2)

    def rows(n, first):
        out = [(first + k, r.choice("ab"), a := r.choice([None, r.randint(-50, 300)]), None if a is None or r.random() < 0.05 else a + r.choice([0, 0, 1, 3, 17, 60, -2])) for k in range(n)]
        return out + [(first + n, "a", -10_000, 2**40), (first + n + 1, None, 0, 10), (first + n + 2, "b", 5, 9), (first + n + 2, "b", 5, 9)]

    left, right = rows(90, 0), rows(70, 1000)
    a, b = spark.createDataFrame(left, "id long, k string, lo long, hi long"), spark.createDataFrame(right, "id long, k string, `from.` long, lo long")
    meet = lambda x, y: None not in (*x[1:], *y[1:]) and x[2] <= x[3] and y[2] <= y[3] and (x[2] <= y[3] and y[2] <= x[3] if closed else x[2] < y[3] and y[2] < x[3])
    found = overlapping(a, b, ("lo", "hi"), ("from.", "lo"), {"k": "k"}, closed, name=("x", "y"))
    assert sorted((p.x.id, p.y.id) for p in found.collect()) == sorted((x[0], y[0]) for x in left for y in right if meet(x, y) and x[1] == y[1])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_intervals_of_fractions_and_days(spark):
    r = random.Random(3)
    left = [(k, a := round(r.uniform(-3, 3), 3), a + r.choice([0.0, 0.25, 2.0])) for k in range(60)]
    df = spark.createDataFrame(left, "id long, a double, b double")
    found = overlapping(df, df, ("a", "b"), ("a", "b"), unit=0.125, name=("x", "y"))
    assert sorted((p.x.id, p.y.id) for p in found.collect()) == sorted((x[0], y[0]) for x in left for y in left if x[1] <= y[2] and y[1] <= x[2])
    days = df.selectExpr("id", "date_add(date'2024-01-01', cast(a * 10 as int)) as a", "date_add(date'2024-01-01', cast(b * 10 as int)) as b")
    got, rows = overlapping(days, days, ("a", "b"), ("a", "b"), closed=False, name=("x", "y")).collect(), days.collect()
    assert sorted((p.x.id, p.y.id) for p in got) == sorted((x.id, y.id) for x in rows for y in rows if x.a < y.b and y.a < x.b)


def test_nearest_at_poles_and_the_date_line(spark, monkeypatch):
    monkeypatch.setattr(dealt.dealt_join, "__defaults__", (50,))
    r = random.Random(4)
    place = lambda: r.choice([(r.uniform(-180, 180), r.uniform(-90, 90)), (r.uniform(179, 181) % 360 - (360 if r.random() < 0.5 else 0), r.uniform(-2, 2)), (r.uniform(-180, 180), r.choice([89.9, -89.95, 90.0, -90.0])), (10 + r.gauss(0, 0.01), 50 + r.gauss(0, 0.01))])
    wrap = lambda p: ((p[0] + 180) % 360 - 180, p[1])
    left = [(k, *wrap(place())) for k in range(120)] + [(500, None, 1.0), (501, 180.0, 0.0), (502, -180.0, 0.0), (503, 0.0, 90.0)]
    right = [(k, *wrap(place())) for k in range(300)] + [(900, 1.0, None), (901, 10.0, 50.0), (902, 10.0, 50.0)]
    a, b = spark.createDataFrame(left, "id long, lng double, lat double"), spark.createDataFrame(right, "id long, lng double, lat double")
    got = {}
    for x in nearest(a, b, ("lng", "lat"), ("lng", "lat"), 4, ("id",)).collect():
        got.setdefault(x.id, []).append((x["rank"], x.near.id, x.meters))
    assert set(got) == {x[0] for x in left if x[1] is not None}
    for i, lng, lat in left:
        if lng is None:
            continue
        want = sorted((geo.meters((lng, lat), y[1:]), y[0]) for y in right if None not in y)[:4]
        mine = sorted(got[i])
        assert [n for n, *_ in mine] == [1, 2, 3, 4] and all(abs(m[2] - w[0]) < 1e-5 for m, w in zip(mine, want, strict=True))
        assert [m[1] for m in mine] == [w[1] for w in want] or len({round(w[0], 5) for w in want}) < 4
    assert nearest(a, b.limit(2), ("lng", "lat"), ("lng", "lat"), 4, ("id",)).groupBy("id").count().where("count <> 2").count() == 0
    assert nearest(a, b.limit(0), ("lng", "lat"), ("lng", "lat"), 4, ("id",)).count() == 0


def star(r, x, y, size, n):
    """A ring around a place, concave at most corners."""
    import math

    ps = [(x + size * f * math.cos(2 * math.pi * k / n), y + size * f * math.sin(2 * math.pi * k / n)) for k in range(n) for f in [r.uniform(0.3, 1)]]
    return [*ps, ps[0]]


def shape(r):
    x, y, size = r.uniform(-9, 9), r.uniform(-9, 9), r.choice([0.05, 1, 4, 9])
    ring = star(r, x, y, size, r.randint(3, 9))
    hole = [(x + (a - x) * 0.5, y + (b - y) * 0.5) for a, b in ring]
    kind = r.choice(["Point", "LineString", "MultiPoint", "Polygon", "Polygon", "MultiPolygon", "MultiLineString"])
    value = {"Point": (x, y), "LineString": ring[:-1], "MultiPoint": ring[:3], "Polygon": [ring, hole] if r.random() < 0.5 else [ring], "MultiPolygon": [[ring, hole], [star(r, x + 9, y, 2, 4)]], "MultiLineString": [ring[:2], hole[1:]]}[kind]
    return geo.geometry(kind, value)


def test_many_shapes_at_once_are_tested_as_one_by_one(monkeypatch):
    r = random.Random(5)
    shapes_a = [shape(r) for _ in range(500)]
    shapes_b = [shape(r) for _ in range(500)]
    square = lambda a, b: geo.geometry("Polygon", [[(a, a), (b, a), (b, b), (a, b), (a, a)]])
    holed = geo.geometry("Polygon", [square(0, 9)["parts"][0][0] and [(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(2, 2), (7, 2), (7, 7), (2, 7), (2, 2)]])
    for x, y in ((holed, square(3, 4)), (holed, square(2, 4)), (square(3, 4), holed), (square(0, 1), square(1, 2)), (square(0, 9), square(3, 4)), (square(0, 1), geo.geometry("Point", (1, 0.5)))):
        shapes_a.append(x)
        shapes_b.append(y)
    want = [geo.intersects(x, y) for x, y in zip(shapes_a, shapes_b, strict=True)]
    kind = pa.struct([("kind", pa.string()), ("srid", pa.int32()), ("parts", pa.list_(pa.list_(pa.list_(pa.struct([(c, pa.float64()) for c in "xyz"])))))])
    a, b = pa.array(shapes_a, kind), pa.array(shapes_b, kind)
    assert shapes.intersect(a, b).tolist() == want and 30 < sum(want) < 400
    assert shapes.intersect(a.slice(100, 80), b.slice(100, 80)).tolist() == want[100:180] and shapes.intersect(a.slice(0, 0), b.slice(0, 0)).tolist() == []
    monkeypatch.setattr(shapes, "AT_ONCE", 7)  # every pair by itself, most by sweeping
    monkeypatch.setattr(shapes, "SLAB", 3)
    assert shapes.intersect(a, b).tolist() == want


def test_areas_that_meet(spark, monkeypatch):
    monkeypatch.setattr(dealt.dealt_join, "__defaults__", (30,))
    r = random.Random(6)
    left, right = [(k, shape(r)) for k in range(120)] + [(200, None)], [(k, shape(r)) for k in range(100)] + [(300, None)]
    make = lambda rows: spark.createDataFrame([(k, None if g is None else (g["kind"], g["srid"], [[[(p["x"], p["y"], p["z"]) for p in line] for line in part] for part in g["parts"]])) for k, g in rows], f"id long, area {geo.GEOMETRY_DDL}")
    found = areas_meeting(make(left), make(right), ("area", "area"), ("x", "y")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    assert sorted(map(tuple, found.collect())) == sorted((i, j) for i, g in left for j, h in right if geo.intersects(g, h))


def _counted(spark, test):
    """A test of two columns that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def run(*given):
        calls.add(1)
        return test(*given)

    return F.udf(run, "boolean"), calls


@pytest.mark.parametrize("rows", [4, 100_000])
def test_equal_geometries_are_tested_once(spark, monkeypatch, rows):
    monkeypatch.setattr(dealt.dealt_join, "__defaults__", (rows,))
    square = lambda x, y, h: ("Polygon", 4326, [[[(x + i * h, y + j * h, None) for i, j in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]]])
    here, there = [square(0.0, 0.0, 1.0), square(1.5, 0.0, 1.0), square(9.0, 9.0, 0.5)], [square(0.5, 0.5, 0.25), square(-0.0, 0.0, 1.0)]
    left, right = [(k, here[k % 3]) for k in range(30)] + [(99, None)], [(k, there[k % 2]) for k in range(20)] + [(98, None)]
    a, b = spark.createDataFrame(left, f"i long, area {geo.GEOMETRY_DDL}"), spark.createDataFrame(right, f"k long, shape {geo.GEOMETRY_DDL}")
    test, calls = _counted(spark, lambda g, h: True)  # of boxes that meet
    found = areas_meeting(a, b, ("area", "shape"), ("x", "y"), test=lambda g, h: test(g["kind"], h["kind"])).select("x.i", "y.k").collect()
    meet = {(0, 0), (0, 1), (1, 0), (1, 1)}
    assert sorted(map(tuple, found)) == sorted((i, k) for i in range(30) for k in range(20) if (i % 3, k % 2) in meet)
    assert calls.value <= 4

    holds, calls = _counted(spark, lambda kind, x, y: True)  # of places in the box
    monkeypatch.setattr(spatial.geo, "contains_point", lambda area, x, y: holds(area["kind"], x, y))
    spots = [(0.5, 0.5), (1.25, 0.0), (-0.0, 0.0), (0.0, 0.0), (None, 0.0), (7.0, float("nan"))]
    points = spark.createDataFrame([(k, *spots[k % 6]) for k in range(60)], "p long, lng double, lat double")
    found = spatial.points_in_areas(points, a, "lng", "lat", "area").select("p", "i").collect()
    inside = {(0, 0), (0, 1), (1, 1), (2, 0), (3, 0)}
    assert sorted(map(tuple, found)) == sorted((p, i) for p in range(60) for i in range(30) if (p % 6, i % 3) in inside)
    assert calls.value <= 4


@pytest.mark.parametrize("rows", [3, 100_000])
def test_hops_of_any_number(spark, rows):
    from meshlark.operators.depth import hops_from

    r = random.Random(7)
    pairs = [(r.randrange(60), r.randrange(60)) for _ in range(90)] + [(0, k) for k in range(30, 50)] + [(5, 5), (None, 1), (2, None), (0, 31), (100, 101), (101, 102), (102, 100)]
    edges, sources = spark.createDataFrame(pairs, "src int, dst int"), spark.createDataFrame([(3,), (3,), (100,), (None,), (77,)], "x int")

    def brute(starts, most=None):
        hops, todo = {s: 0 for s in starts}, list(starts)
        for n in todo:
            for a, b in pairs:
                if a == n and b is not None and b not in hops and (most is None or hops[n] < most):
                    hops[b] = hops[n] + 1
                    todo.append(b)
        return sorted(hops.items())

    assert sorted(map(tuple, hops_from(edges, sources, rows=rows).collect())) == brute([3, 100, 77])
    assert sorted(map(tuple, hops_from(edges, sources, 2, rows=rows).collect())) == brute([3, 100, 77], 2)
    assert sorted(map(tuple, hops_from(edges, sources, apart=True, rows=rows).collect())) == sorted((s, *x) for s in (3, 77, 100) for x in brute([s]))
    assert hops_from(edges, sources.limit(0)).count() == 0 and hops_from(edges.limit(0), sources).count() == 3
