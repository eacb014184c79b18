"""Geometry: spherical distances and planar predicates.

A geometry is a struct of kind, srid and parts; a part is a list of rings or lines, those are lists of points.
A point is one part of one line of one point. Points against points, segments and polygons are Column
expressions; predicates between lines and areas are Arrow UDFs, to which only geometries whose bounding boxes allow
the answer to be true are sent.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import GeoDimensionMismatch, Unsupported3DGeometry

#: Fixed value: the equatorial radius of WGS 84 in metres.
RADIUS = 6_378_137.0
KINDS = ("Point", "LineString", "Polygon", "MultiPoint", "MultiLineString", "MultiPolygon")
AREAS = ("Polygon", "MultiPolygon")

POINT = T.StructType([T.StructField(c, T.DoubleType()) for c in "xyz"])
GEOMETRY = T.StructType([T.StructField("kind", T.StringType()), T.StructField("srid", T.IntegerType()), T.StructField("parts", T.ArrayType(T.ArrayType(T.ArrayType(POINT))))])
GEOMETRY_DDL = "struct<kind:string,srid:int,parts:array<array<array<struct<x:double,y:double,z:double>>>>>"


# Python values ---------------------------------------------------------------------------------------------------

def geometry(kind: str, coordinates: list | tuple) -> dict:
    """A geometry from nested coordinates, longitude first; three coordinates make it 3D."""
    def point(p):
        return {"x": float(p[0]), "y": float(p[1]), "z": float(p[2]) if len(p) > 2 else None}

    def line(ps):
        return [point(p) for p in ps]

    parts = {
        "Point": lambda c: [[[point(c)]]], "LineString": lambda c: [[line(c)]], "Polygon": lambda c: [[line(r) for r in c]],
        "MultiPoint": lambda c: [[[point(p)]] for p in c], "MultiLineString": lambda c: [[line(x)] for x in c], "MultiPolygon": lambda c: [[line(r) for r in p] for p in c],
    }[kind](coordinates)
    flat = [p["z"] is not None for part in parts for ring in part for p in ring]
    if any(flat) and not all(flat):
        raise GeoDimensionMismatch("the points of a geometry have two or three coordinates, not both")
    return {"kind": kind, "srid": 4979 if any(flat) else 4326, "parts": parts}


def check_writable(g: dict | None, dimensions: int = 2) -> dict | None:
    """A geometry as it may be stored in an attribute of so many dimensions."""
    if g is not None:
        if g["srid"] == 4979 and g["kind"] != "Point":
            raise Unsupported3DGeometry(g["kind"])
        if (g["srid"] == 4979) != (dimensions == 3):
            raise GeoDimensionMismatch(f"a {3 if g['srid'] == 4979 else 2}D value for a {dimensions}D attribute")
    return g


def _points(g: dict) -> list[tuple[float, float]]:
    return [(p["x"], p["y"]) for part in g["parts"] for ring in part for p in ring]


def bbox(g: dict) -> list[float]:
    """West, south, east, north."""
    ps = _points(g)
    return [min(x for x, _ in ps), min(y for _, y in ps), max(x for x, _ in ps), max(y for _, y in ps)]


def force_2d(g: dict | None) -> dict | None:
    if g is None or g["srid"] == 4326:
        return g
    return {"kind": g["kind"], "srid": 4326, "parts": [[[{**p, "z": None} for p in ring] for ring in part] for part in g["parts"]]}


def to_geojson(g: dict | None) -> str | None:
    """RFC 7946 with a bbox, without a crs; keys in order."""
    if g is None:
        return None
    def point(p):
        return [p["x"], p["y"]] + ([p["z"]] if p["z"] is not None else [])

    lines = [[[point(p) for p in ring] for ring in part] for part in g["parts"]]
    c = {"Point": lambda: lines[0][0][0], "LineString": lambda: lines[0][0], "Polygon": lambda: lines[0], "MultiPoint": lambda: [x[0][0] for x in lines], "MultiLineString": lambda: [x[0] for x in lines], "MultiPolygon": lambda: lines}[g["kind"]]()
    return json.dumps({"bbox": bbox(g), "coordinates": c, "type": g["kind"]}, sort_keys=True)


def from_geojson(text: str | None) -> dict | None:
    if text is None:
        return None
    o = json.loads(text) if isinstance(text, str) else text
    return geometry(o["type"], o["coordinates"])


def meters(p: tuple[float, ...], q: tuple[float, ...]) -> float:
    """Great-circle distance; with heights, the arc at the mean height and the difference in height by Pythagoras."""
    (x1, y1), (x2, y2) = p[:2], q[:2]
    u, v = math.radians(y2 - y1) / 2, math.radians(x2 - x1) / 2
    a = math.sin(u) ** 2 + math.cos(math.radians(y1)) * math.cos(math.radians(y2)) * math.sin(v) ** 2
    arc = 2 * RADIUS * math.atan2(math.sqrt(a), math.sqrt(1 - a))
    if len(p) == 3 and len(q) == 3:
        return math.hypot(arc * (RADIUS + (p[2] + q[2]) / 2) / RADIUS, q[2] - p[2])
    return arc


def foot(p, a, b) -> tuple[float, float]:
    """The point of segment ab nearest to p, in a plane with longitudes scaled at the segment's mean latitude."""
    s = math.cos(math.radians((a[1] + b[1]) / 2))
    dx, dy = (b[0] - a[0]) * s, b[1] - a[1]
    n = dx * dx + dy * dy
    t = min(1.0, max(0.0, ((p[0] - a[0]) * s * dx + (p[1] - a[1]) * dy) / n)) if n else 0.0
    return a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])


def _segments(g: dict):
    for part in g["parts"]:
        for ring in part:
            ps = [(p["x"], p["y"]) for p in ring]
            yield from zip(ps, ps[1:] or ps)


def _side(a, b, p) -> float:
    return (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])


def _on(a, b, p) -> bool:
    return _side(a, b, p) == 0 and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]) and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])


def _meet(a, b, c, d) -> bool:
    """Whether closed segments have a point in common."""
    s, t, u, v = _side(a, b, c), _side(a, b, d), _side(c, d, a), _side(c, d, b)
    return (s > 0) != (t > 0) and (u > 0) != (v > 0) and 0 not in (s, t, u, v) or _on(a, b, c) or _on(a, b, d) or _on(c, d, a) or _on(c, d, b)


def _where(part: list, p) -> int:
    """1 inside a polygon, 0 on its boundary, -1 outside."""
    odd = False
    for ring in part:
        ps = [(q["x"], q["y"]) for q in ring]
        for a, b in zip(ps, ps[1:]):
            if _on(a, b, p):
                return 0
            if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
                odd = not odd
    return 1 if odd else -1


def _cuts(a, b, part: list) -> list[float]:
    """Where segment ab meets edges of a polygon, as shares of its length."""
    out = {0.0, 1.0}
    n = (b[0] - a[0]) ** 2 + (b[1] - a[1]) ** 2
    if not n:
        return [0.0]
    for c, d in _segments({"parts": [part]}):
        s, t = _side(a, b, c), _side(a, b, d)
        if s != t and (s >= 0) != (t >= 0) or 0 in (s, t):
            for q, z in ((c, s), (d, t)):
                if z == 0:
                    out.add(((q[0] - a[0]) * (b[0] - a[0]) + (q[1] - a[1]) * (b[1] - a[1])) / n)
            if 0 not in (s, t):
                k = s / (s - t)
                q = (c[0] + k * (d[0] - c[0]), c[1] + k * (d[1] - c[1]))
                out.add(((q[0] - a[0]) * (b[0] - a[0]) + (q[1] - a[1]) * (b[1] - a[1])) / n)
    return sorted(k for k in out if 0 <= k <= 1)


def _inner_point(ring: list) -> tuple[float, float] | None:
    """A point inside a ring: on a level halfway between two heights of vertices, midway between crossings."""
    ps = [(p["x"], p["y"]) for p in ring]
    heights = sorted({y for _, y in ps})
    if len(heights) < 2:
        return None
    low, high = max(zip(heights, heights[1:]), key=lambda h: h[1] - h[0])
    y = (low + high) / 2
    xs = sorted(a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in zip(ps, ps[1:]) if (a[1] > y) != (b[1] > y))
    west, east = max(zip(xs[::2], xs[1::2]), key=lambda x: x[1] - x[0])
    return (west + east) / 2, y


def _part_contains(part: list, g: dict) -> bool:
    inner = False
    for ring_part in g["parts"]:
        for ring in ring_part:
            ps = [(p["x"], p["y"]) for p in ring]
            if any(_where(part, p) < 0 for p in ps):
                return False
            inner = inner or any(_where(part, p) > 0 for p in ps)
            for a, b in zip(ps, ps[1:]):
                cuts = _cuts(a, b, part)
                for lo, hi in zip(cuts, cuts[1:]):
                    mid = (a[0] + (lo + hi) / 2 * (b[0] - a[0]), a[1] + (lo + hi) / 2 * (b[1] - a[1]))
                    w = _where(part, mid) if hi - lo > 1e-12 else 0
                    if w < 0:
                        return False
                    inner = inner or w > 0
    if g["kind"] in AREAS:
        # its boundary enters no hole, so a hole lies in it as a whole or not at all: one inner point of the hole decides
        return not any(_where(own, p) > 0 for hole in part[1:] if (p := _inner_point(hole)) for own in g["parts"])
    return inner


def contains(a: dict | None, b: dict | None) -> bool | None:
    """Whether area a contains b: no point of b outside, some inside. False for null, null for an a that is no area.

    A MultiPolygon contains what one of its polygons contains: an area across two that touch is not contained. Each
    member of a Multi geometry b must be contained, by any of a's polygons.
    """
    if a is None or b is None:
        return False
    if a["kind"] not in AREAS:
        return None
    if a["srid"] != b["srid"]:
        raise GeoDimensionMismatch("containment is planar; use force_2d")
    if b["kind"].startswith("Multi"):
        single = b["kind"][5:]
        return all(contains(a, {**b, "kind": single, "parts": [p]}) for p in b["parts"])
    return any(_part_contains(part, b) for part in a["parts"])


def intersects(a: dict | None, b: dict | None) -> bool:
    """Whether the geometries have a point in common, touching included; false for null."""
    if a is None or b is None:
        return False
    if a["srid"] != b["srid"]:
        raise GeoDimensionMismatch("intersection is planar; use force_2d")
    p, q = bbox(a), bbox(b)
    if p[0] > q[2] or q[0] > p[2] or p[1] > q[3] or q[1] > p[3]:
        return False
    if any(_meet(*s, *t) for s in _segments(a) for t in _segments(b)):
        return True
    for x, y in ((a, b), (b, a)):
        if x["kind"] in AREAS and any(_where(part, pt) >= 0 for part in x["parts"] for pt in _points(y)):
            return True
    return False


def distance(a: dict | None, b: dict | None) -> float | None:
    """Metres between geometries of which one is a point; 0 inside an area; null for null and for other pairs."""
    if a is None or b is None:
        return None
    if a["kind"] != "Point":
        a, b = b, a
    if a["kind"] != "Point":
        return None
    if a["srid"] != b["srid"]:
        raise GeoDimensionMismatch("distances are between geometries of equal dimension")
    p = a["parts"][0][0][0]
    if b["kind"] == "Point":
        q = b["parts"][0][0][0]
        three = p["z"] is not None
        return meters((p["x"], p["y"]) + ((p["z"],) if three else ()), (q["x"], q["y"]) + ((q["z"],) if three else ()))
    here = (p["x"], p["y"])
    if b["kind"] in AREAS and any(_where(part, here) >= 0 for part in b["parts"]):
        return 0.0
    return min(meters(here, foot(here, s, t)) for s, t in _segments(b))


def closest_point(g: dict | None, p: dict | None) -> dict | None:
    """The point of a line, or the member of a MultiPoint, nearest to point p."""
    if g is None or p is None:
        return None
    here = _points(p)[0]
    if g["kind"] == "MultiPoint":
        found = min(_points(g), key=lambda q: meters(here, q))
    elif g["kind"] in ("LineString", "MultiLineString"):
        found = min((foot(here, s, t) for s, t in _segments(g)), key=lambda q: meters(here, q))
    else:
        return None
    return geometry("Point", found)


# Columns ---------------------------------------------------------------------------------------------------------

def of_kind(c: Column, kind: str) -> Column:
    """The column, known to hold geometries of one kind only, so that plans need not provide for others."""
    c.__dict__["_kind"] = kind
    return c


def kind_of(c: Column) -> str | None:
    return c.__dict__.get("_kind")


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v)) if isinstance(v, (int, float)) else F.lit(v)


def haversine(lng1, lat1, lng2, lat2) -> Column:
    lng1, lat1, lng2, lat2 = map(_c, (lng1, lat1, lng2, lat2))
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return F.lit(2 * RADIUS) * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def haversine_3d(lng1, lat1, h1, lng2, lat2, h2) -> Column:
    h1, h2 = _c(h1), _c(h2)
    arc = haversine(lng1, lat1, lng2, lat2) * (RADIUS + (h1 + h2) / 2) / RADIUS
    return F.sqrt(arc * arc + (h2 - h1) * (h2 - h1))


def near_box(lng: Column, lat: Column, p: tuple[float, float], n: float) -> Column:
    """Plain ranges of latitude and longitude that hold all points within n metres of p; scans can skip by them."""
    margin = math.degrees(n / RADIUS) * (1 + 1e-9) + 1e-9
    south, north = p[1] - margin, p[1] + margin
    box = lat.between(south, north)
    if south <= -90 or north >= 90 or margin >= 90:
        return box
    reach = math.degrees(math.asin(min(1.0, math.sin(math.radians(margin)) / math.cos(math.radians(p[1])))))
    west, east = p[0] - reach, p[0] + reach
    if west < -180 or east > 180:
        return box & ((lng >= (west + 360 if west < -180 else west)) | (lng <= (east - 360 if east > 180 else east)))
    return box & lng.between(west, east)


def dwithin_xy(lng: Column, lat: Column, p: tuple[float, float], n: float) -> Column:
    """Whether a point column lies within n metres of p; false for null."""
    return F.coalesce(near_box(lng, lat, p, n) & (haversine(lng, lat, *p) <= n), F.lit(False))


def point(lng, lat, z=None) -> Column:
    """A point geometry; null where a coordinate is."""
    p = F.struct(_c(lng).cast("double").alias("x"), _c(lat).cast("double").alias("y"), (F.lit(None) if z is None else _c(z)).cast("double").alias("z"))
    g = F.struct(F.lit("Point").alias("kind"), F.lit(4326 if z is None else 4979).alias("srid"), F.array(F.array(F.array(p))).alias("parts"))
    return of_kind(F.when(_c(lng).isNotNull() & _c(lat).isNotNull(), g), "Point")


def literal(g: dict | None) -> Column:
    if g is None:
        return F.lit(None).cast(GEOMETRY_DDL)
    def p(q):
        return F.struct(F.lit(q["x"]).alias("x"), F.lit(q["y"]).alias("y"), F.lit(q["z"]).cast("double").alias("z"))

    parts = F.array(*[F.array(*[F.array(*[p(q) for q in ring]) for ring in part]) for part in g["parts"]])
    return of_kind(F.struct(F.lit(g["kind"]).alias("kind"), F.lit(g["srid"]).alias("srid"), parts.alias("parts")), g["kind"])


def flat(g: Column) -> Column:
    """The geometry without heights; null for null."""
    parts = F.transform(g["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(None).cast("double").alias("z")))))
    return F.when(g.isNotNull(), F.struct(g["kind"].alias("kind"), F.lit(4326).alias("srid"), parts.alias("parts")))


def geojson(g: Column) -> Column:
    """RFC 7946 with a bbox, without a crs, in compact form with keys in order; null for null."""
    def at(p):
        return F.filter(F.array(p["x"], p["y"], p["z"]), lambda v: v.isNotNull())

    def first(c):
        return F.get(c, F.lit(0))

    lines = F.transform(g["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, at)))
    box = box_columns(g)
    shapes = {
        "Point": first(first(first(lines))), "LineString": first(first(lines)), "Polygon": first(lines), "MultiPoint": F.transform(lines, lambda x: first(first(x))),
        "MultiLineString": F.transform(lines, first), "MultiPolygon": lines,
    }
    out = F.lit(None).cast("string")
    for kind, c in shapes.items():
        out = F.when(g["kind"] == kind, F.to_json(F.struct(F.array(*box.values()).alias("bbox"), c.alias("coordinates"), g["kind"].alias("type")))).otherwise(out)
    return out


def parse_geojson(text: Column) -> Column:
    """The geometry of a GeoJSON text; null for null, other types and texts that are none."""
    kind, c = F.get_json_object(text, "$.type"), F.get_json_object(text, "$.coordinates")

    def nested(n):
        return F.from_json(c, "array<" * n + "double" + ">" * n)

    def p(a):
        return F.struct(F.get(a, F.lit(0)).alias("x"), F.get(a, F.lit(1)).alias("y"), F.get(a, F.lit(2)).alias("z"))

    def line(a):
        return F.transform(a, p)

    shapes = {
        "Point": F.array(F.array(F.array(p(nested(1))))), "LineString": F.array(F.array(line(nested(2)))), "Polygon": F.array(F.transform(nested(3), line)),
        "MultiPoint": F.transform(nested(2), lambda q: F.array(F.array(p(q)))), "MultiLineString": F.transform(nested(3), lambda x: F.array(line(x))),
        "MultiPolygon": F.transform(nested(4), lambda part: F.transform(part, line)),
    }
    parts = F.lit(None).cast("array<array<array<struct<x:double,y:double,z:double>>>>")
    for name, shape in shapes.items():
        parts = F.when(kind == name, shape).otherwise(parts)
    v = F.get(F.get(F.get(parts, F.lit(0)), F.lit(0)), F.lit(0))
    return F.when(v["x"].isNotNull() & v["y"].isNotNull(), F.struct(kind.alias("kind"), F.when(v["z"].isNotNull(), F.lit(4979)).otherwise(F.lit(4326)).alias("srid"), parts.alias("parts")))


def vertex(g: Column) -> Column:
    """The first vertex: of a point, itself."""
    return F.get(F.get(F.get(g["parts"], F.lit(0)), F.lit(0)), F.lit(0))


def box_columns(g: Column) -> dict[str, Column]:
    """west, south, east, north of a geometry column: scalar companions that Parquet keeps ranges of."""
    ps = F.flatten(F.flatten(g["parts"]))
    xs, ys = F.transform(ps, lambda p: p["x"]), F.transform(ps, lambda p: p["y"])
    return {"west": F.array_min(xs), "south": F.array_min(ys), "east": F.array_max(xs), "north": F.array_max(ys)}


def _in_rings(rings: Column, lng: Column, lat: Column) -> Column:
    """Crossing count over all rings: holes come out by themselves."""
    def crossed(odd, ring):
        n = F.size(ring)
        edges = F.zip_with(F.slice(ring, F.lit(1), n - 1), F.slice(ring, F.lit(2), n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

        def edge(o, e):
            a, b = e["a"], e["b"]
            at = (b["x"] - a["x"]) * (lat - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
            return o != (((a["y"] > lat) != (b["y"] > lat)) & F.coalesce(lng < at, F.lit(False)))

        return odd != F.aggregate(edges, F.lit(False), edge)

    return F.aggregate(rings, F.lit(False), crossed)


def contains_point(area: Column, lng: Column, lat: Column) -> Column:
    """Whether any polygon of an area holds the point; false for null; boxes are tested first."""
    box = box_columns(area)
    inside = (lng >= box["west"]) & (lng <= box["east"]) & (lat >= box["south"]) & (lat <= box["north"])
    return F.coalesce(area["kind"].isin(*AREAS) & inside & F.exists(area["parts"], lambda part: _in_rings(part, lng, lat)), F.lit(False))


def segment_meters(a: Column, b: Column, lng: Column, lat: Column) -> Column:
    """Metres from a point to a segment between two vertex structs."""
    f = segment_foot(a, b, lng, lat)
    return haversine(lng, lat, f["x"], f["y"])


def segment_foot(a: Column, b: Column, lng: Column, lat: Column) -> Column:
    s = F.cos(F.radians((a["y"] + b["y"]) / 2))
    dx, dy = (b["x"] - a["x"]) * s, b["y"] - a["y"]
    t = F.coalesce(((lng - a["x"]) * s * dx + (lat - a["y"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0)), F.lit(0.0))
    t = F.least(F.lit(1.0), F.greatest(F.lit(0.0), t))
    return F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["y"] + t * dy).alias("y"))


def _edges(line: Column) -> Column:
    n = F.size(line)
    pairs = F.zip_with(F.slice(line, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(line, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    one = F.transform(F.slice(line, F.lit(1), F.lit(1)), lambda a: F.struct(a.alias("a"), a.alias("b")))
    return F.when(n == 1, one).otherwise(pairs)


def st_distance(a: Column, b: Column) -> Column:
    """Metres; one side is a point. 3D where both are 3D points; null for null, other pairs and mixed dimensions."""
    def one_way(p: Column, g: Column) -> Column:
        v, w = vertex(p), vertex(g)
        flat, tall = haversine(v["x"], v["y"], w["x"], w["y"]), haversine_3d(v["x"], v["y"], v["z"], w["x"], w["y"], w["z"])
        lines = F.flatten(g["parts"])
        near = F.array_min(F.flatten(F.transform(lines, lambda line: F.transform(_edges(line), lambda e: segment_meters(e["a"], e["b"], v["x"], v["y"])))))
        inside = contains_point(g, v["x"], v["y"])
        return F.when(g["kind"] == "Point", F.when(p["srid"] == 4979, tall).otherwise(flat)).otherwise(F.when(inside, F.lit(0.0)).otherwise(near))

    same = a["srid"] == b["srid"]
    return F.when(same & (a["kind"] == "Point"), one_way(a, b)).when(same & (b["kind"] == "Point"), one_way(b, a))


st_distance_in_meters = st_distance


def st_dwithin(a: Column, b: Column, n) -> Column:
    return F.coalesce(st_distance(a, b) <= _c(n), F.lit(False))


def st_closest_point(g: Column, p: Column) -> Column:
    """The nearest point of a line or MultiPoint to a point; null for null and other kinds."""
    v = vertex(p)
    feet = F.flatten(F.transform(F.flatten(g["parts"]), lambda line: F.transform(_edges(line), lambda e: segment_foot(e["a"], e["b"], v["x"], v["y"]))))
    ranked = F.array_min(F.transform(feet, lambda f: F.struct(haversine(v["x"], v["y"], f["x"], f["y"]).alias("d"), f["x"].alias("x"), f["y"].alias("y"))))
    return F.when(v.isNotNull() & g["kind"].isin("MultiPoint", "LineString", "MultiLineString"), point(ranked["x"], ranked["y"]))


def _pairwise(test):
    @F.arrow_udf(T.BooleanType())
    def each(a: pa.Array, b: pa.Array) -> pa.Array:
        at = np.flatnonzero(np.asarray(a.is_valid()) & np.asarray(b.is_valid()))
        out: list = [None] * len(a)
        for k, x, y in zip(at.tolist(), a.take(pa.array(at)).to_pylist(), b.take(pa.array(at)).to_pylist(), strict=True):
            out[k] = test(x, y)
        return pa.array(out, pa.bool_())

    return each


@F.arrow_udf(T.BooleanType())
def _intersecting(a: pa.Array, b: pa.Array) -> pa.Array:
    from . import shapes

    at = np.flatnonzero(np.asarray(a.is_valid()) & np.asarray(b.is_valid()))
    out, rows = np.zeros(len(a), bool), pa.array(at)
    if len(at):
        out[at] = shapes.intersect(a.take(rows), b.take(rows))
    return pa.array(out)


def st_contains(a: Column, b: Column) -> Column:
    """Whether area a contains b, both 2D; false for null, null where a is no area.

    Points are tested by expressions. A b that is known to be points (see ``of_kind``) leaves no Python in the plan;
    of others only pairs whose boxes allow it have their geometries sent, all else is sent as null.
    """
    v = vertex(b)
    points = contains_point(a, v["x"], v["y"])
    areas = F.when(a.isNull() | b.isNull(), F.lit(False)).when(~a["kind"].isin(*AREAS), F.lit(None))
    if kind_of(b) == "Point":
        return areas.otherwise(points)
    p, q = box_columns(a), box_columns(b)
    boxes = (p["west"] <= q["west"]) & (p["south"] <= q["south"]) & (p["east"] >= q["east"]) & (p["north"] >= q["north"]) & (b["kind"] != "Point")
    exact = F.coalesce(boxes, F.lit(False)) & _pairwise(contains)(F.when(boxes, a), F.when(boxes, b))
    return areas.otherwise(exact) if kind_of(b) else areas.when(b["kind"] == "Point", points).otherwise(exact)


def st_within(a: Column, b: Column) -> Column:
    return st_contains(b, a)


def st_intersects(a: Column, b: Column) -> Column:
    """Whether two 2D geometries have a point in common; false for null. Geometries whose boxes do not meet are sent as null."""
    p, q = box_columns(a), box_columns(b)
    boxes = F.coalesce((p["west"] <= q["east"]) & (q["west"] <= p["east"]) & (p["south"] <= q["north"]) & (q["south"] <= p["north"]), F.lit(False))
    return boxes & _intersecting(F.when(boxes, a), F.when(boxes, b))
