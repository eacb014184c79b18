"""Geometry and vectors: goldens, and agreement of Columns with plain Python."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meshlark.errors import GeoDimensionMismatch, Unsupported3DGeometry
from meshlark.functions import geo, vector
from meshlark.operators import spatial

P = lambda *c: geo.geometry("Point", c)
SQUARE = geo.geometry("Polygon", [[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(3, 3), (7, 3), (7, 7), (3, 7), (3, 3)]])
TRIANGLE = geo.geometry("Polygon", [[(0, 0), (10, 0), (0, 10), (0, 0)]])
LINE = geo.geometry("LineString", [(151, -33), (152, -33)])


def box(lo, hi):
    return geo.geometry("Polygon", [[(lo, lo), (hi, lo), (hi, hi), (lo, hi), (lo, lo)]])


def test_distances():
    assert abs(geo.distance(P(151.2093, -33.8688), P(144.9631, -37.8136)) - 714_226.685) < 0.01
    assert abs(geo.distance(P(151, -33, 0), P(151, -34, 1000)) - 111_332.76) < 0.5
    assert abs(geo.distance(P(151, -33, 0), P(151, -33, 1000)) - 1000) < 0.001
    assert 10_900 < geo.distance(LINE, P(151.5, -33.1)) < 11_300
    assert geo.distance(SQUARE, P(1, 1)) == 0.0 and geo.distance(None, P(1, 1)) is None and geo.distance(LINE, SQUARE) is None
    assert abs(geo.distance(SQUARE, P(5, 5)) - geo.meters((5, 5), (5, 3))) < 900
    foot = geo.closest_point(LINE, P(151.5, -33.1))["parts"][0][0][0]
    assert abs(foot["x"] - 151.5) < 1e-6 and foot["y"] == -33
    assert geo.closest_point(LINE, P(150.5, -33))["parts"][0][0][0]["x"] == 151


def test_containment():
    assert geo.contains(SQUARE, P(1, 1)) and not geo.contains(SQUARE, P(5, 5)) and not geo.contains(SQUARE, P(0, 5))
    assert geo.contains(TRIANGLE, P(1, 1)) and not geo.contains(TRIANGLE, P(9, 9))
    assert geo.contains(box(0, 10), box(2, 3)) and geo.contains(box(0, 10), box(0, 10)) and not geo.contains(box(0, 10), box(5, 11))
    assert not geo.contains(SQUARE, box(2, 8)) and not geo.contains(SQUARE, box(4, 6))
    assert geo.contains(box(0, 10), geo.geometry("LineString", [(0, 0), (10, 10)])) and not geo.contains(box(0, 10), geo.geometry("LineString", [(0, 0), (10, 0)]))
    assert geo.contains(geo.geometry("MultiPolygon", [[[(p["x"], p["y"]) for p in box(0, 1)["parts"][0][0]]], [[(p["x"], p["y"]) for p in box(5, 6)["parts"][0][0]]]]), P(5.5, 5.5))
    assert not geo.contains(box(0, 10), geo.geometry("MultiPoint", [(1, 1), (20, 20)]))
    assert geo.contains(None, P(1, 1)) is False and geo.contains(LINE, P(1, 1)) is None
    with pytest.raises(GeoDimensionMismatch):
        geo.contains(SQUARE, P(1, 1, 1))
    assert geo.contains(SQUARE, geo.force_2d(P(1, 1, 1)))


def test_intersection():
    assert geo.intersects(box(0, 5), box(5, 10)) and not geo.intersects(box(0, 5), box(6, 10)) and not geo.intersects(None, LINE)
    assert geo.intersects(box(0, 10), box(4, 5)) and geo.intersects(geo.geometry("LineString", [(-1, 5), (11, 5)]), SQUARE)
    assert not geo.intersects(SQUARE, P(5, 5))


def test_values():
    assert geo.to_geojson(geo.geometry("LineString", [(151.21, -33.87), (151.78, -32.93)])).startswith('{"bbox": [151.21, -33.87, 151.78, -32.93]')
    for g in (P(1, 2), SQUARE, LINE, P(1, 2, 3)):
        assert geo.from_geojson(geo.to_geojson(g)) == g
    with pytest.raises(GeoDimensionMismatch):
        geo.check_writable(P(1, 2, 3), 2)
    with pytest.raises(Unsupported3DGeometry):
        geo.check_writable(geo.geometry("LineString", [(0, 0, 1), (1, 1, 1)]), 3)


def test_columns_agree_with_python(spark):
    import random

    r = random.Random(3)
    pts = [(r.uniform(-2, 12), r.uniform(-2, 12)) for _ in range(60)]
    df = spark.createDataFrame([(float(x), float(y)) for x, y in pts], "x double, y double").withColumn("p", geo.point(F.col("x"), F.col("y")))
    for g in (SQUARE, TRIANGLE, LINE, geo.geometry("MultiPoint", [(1, 1), (5, 9)])):
        c = geo.literal(g)
        out = df.select("x", "y", geo.st_contains(c, F.col("p")).alias("c"), geo.st_distance(F.col("p"), c).alias("d"), geo.st_dwithin(c, F.col("p"), 300_000).alias("w"), geo.st_intersects(c, F.col("p")).alias("i")).collect()
        for row in out:
            p = P(row["x"], row["y"])
            assert row["c"] == geo.contains(g, p) and row["i"] == geo.intersects(g, p)
            assert math.isclose(row["d"], geo.distance(g, p), rel_tol=1e-9, abs_tol=1e-6)
            assert row["w"] == (geo.distance(g, p) <= 300_000)
    row = df.limit(1).select(geo.st_contains(geo.literal(None), F.col("p")).alias("c"), geo.st_distance(geo.literal(None), F.col("p")).alias("d"), geo.st_intersects(F.col("p"), geo.literal(None)).alias("i"), geo.st_dwithin(geo.literal(None), F.col("p"), 5).alias("w")).first()
    assert (row["c"], row["d"], row["i"], row["w"]) == (False, None, False, False)
    near = df.select(geo.st_closest_point(geo.literal(LINE), F.lit(None).cast(geo.GEOMETRY_DDL)).alias("n")).first()
    assert near["n"] is None


@settings(max_examples=300, deadline=None)
@given(st.floats(-179, 179), st.floats(-89, 89), st.floats(-179.9, 179.9), st.floats(-89.9, 89.9), st.floats(1, 5_000_000))
def test_distance_band_never_drops(px, py, x, y, n):
    margin = math.degrees(n / geo.RADIUS) * (1 + 1e-9) + 1e-9
    if geo.meters((px, py), (x, y)) <= n:
        assert py - margin <= y <= py + margin
        if py - margin > -90 and py + margin < 90 and margin < 90:
            reach = math.degrees(math.asin(min(1.0, math.sin(math.radians(margin)) / math.cos(math.radians(py)))))
            assert min(abs(x - px), 360 - abs(x - px)) <= reach + 1e-9


def test_vectors(spark):
    rows = [([1.0, 0.0, 0.0],), ([0.0, 1.0, 0.0],), ([-1.0, 0.0, 0.0],), ([1.0, 0.0],), ([],), (None,), ([0.0, 0.0, 0.0],)]
    df = spark.createDataFrame(rows, "v array<double>")
    q = [1.0, 0.0, 0.0]
    out = df.select(vector.vector_similarity(F.col("v"), q).alias("s"), vector.vector_cosine_distance(F.col("v"), q).alias("d")).collect()
    assert [r["s"] for r in out] == [1.0, 0.5, 0.0, None, None, None, 0.5] and [r["d"] for r in out][:3] == [0.0, 1.0, 2.0]
    with pytest.raises(ValueError):
        vector.check_dimensions([1], 2)


def test_bench_grid_join(spark):
    """Donuts on a grid: the served point is in, the hole and the gap are not."""
    half, hole = 0.01, 0.0025
    areas, points = [], []
    for k in range(64):
        x, y = 151 + 0.03 * (k % 8), -33 + 0.03 * (k // 8)
        ring = lambda h: [(x - h, y - h), (x + h, y - h), (x + h, y + h), (x - h, y + h), (x - h, y - h)]  # noqa: E731, B023
        areas.append((k, geo.geometry("Polygon", [ring(half), ring(hole)])))
        points += [(k, "in", x + 0.006, y), (k, "hole", x, y), (k, "out", x + 0.015, y)]
    a = spark.createDataFrame(areas, f"area_id long, area {geo.GEOMETRY_DDL}")
    p = spark.createDataFrame(points, "k long, kind string, lng double, lat double")
    out = spatial.points_in_areas(p, a, "lng", "lat", "area", 0.02).collect()
    assert sorted((r["k"], r["area_id"], r["kind"]) for r in out) == [(k, k, "in") for k in range(64)]


def test_spatial_files_have_ranges(spark, tmp_path):
    df = spark.range(2000).withColumn("g", geo.point(F.col("id") % 100 * 1.0, F.col("id") / 100.0))
    spatial.write_spatial(df, str(tmp_path / "s"), "g", 5.0)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.where("g_x between 10 and 12 and g_y < 3").count() == df.where("id % 100 between 10 and 12 and id / 100.0 < 3").count()
