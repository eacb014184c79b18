"""Joins of points with areas and with each other, and storage that scans can skip by place."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..sources import commit
from .dealt import dealt_join


def _flat_name(geometry: str) -> str:
    """The name of a geometry, nested ones included, as a prefix of columns and folders."""
    return geometry.replace(".", "_")


def with_companions(df: DataFrame, *geometries: str) -> DataFrame:
    """Adds <name>_west, _south, _east and _north for each geometry, and <name>_x, _y (and _z) of points; a nested
    geometry, by its path, has _ for each dot."""
    cols = {}
    for g in geometries:
        name, c = _flat_name(g), F.col(g)
        cols |= {f"{name}_{k}": x for k, x in geo.box_columns(c).items()}
        v = geo.vertex(c)
        cols |= {f"{name}_{k}": F.when(c["kind"] == "Point", v[k]) for k in "xyz"}
    return df.withColumns(cols)


def write_spatial(df: DataFrame, path: str, geometry: str, cell: float = 1.0, mode: str = "errorifexists") -> None:
    """Writes with companions, ordered by grid cell, so that row groups cover little ground."""
    df, name = with_companions(df, geometry), _flat_name(geometry)
    key = [F.floor(F.col(f"{name}_{k}") / cell) for k in ("west", "south")]
    df.repartitionByRange(*key).sortWithinPartitions(*key).write.mode(mode).parquet(path)


# an index is a copy of a table in cell order, in a folder below the table that scans of the table do not see

def _index_path(path: str, geometry: str) -> str:
    return f"{path}/_spatial/{_flat_name(geometry)}"


def create_index(spark: SparkSession, path: str, geometry: str, cell: float = 1.0, recreate: bool = False, dry_run: bool = False) -> list[str]:
    """Indexes a Parquet table by a geometry, which may be nested; returns what is done, or would be.

    An index that exists is kept, or with ``recreate`` written anew.
    """
    at = _index_path(path, geometry)
    there = commit.exists(spark, f"{at}/_SUCCESS")  # what has none is the rest of one that was never finished
    steps = ([f"drop {at}"] if there and recreate else []) + ([f"write {at} by cells of {cell:g} degrees of {geometry}"] if recreate or not there else [])
    if not dry_run and steps:
        write_spatial(spark.read.parquet(path), at, geometry, cell, "overwrite")
    return steps


def drop_index(spark: SparkSession, path: str, geometry: str, dry_run: bool = False) -> list[str]:
    at = _index_path(path, geometry)
    steps = [f"drop {at}"] if commit.exists(spark, at) else []
    if steps and not dry_run:
        commit.delete(spark, at)
    return steps


def open_index(spark: SparkSession, path: str, geometry: str) -> DataFrame:
    """The indexed table with its companions: filters on these skip files and row groups."""
    return spark.read.parquet(_index_path(path, geometry))


def cells(west: Column, south: Column, east: Column, north: Column, size: Column | float) -> Column:
    """The grid cells that a box touches, as an array of structs."""
    def span(lo: Column, hi: Column) -> Column:
        return F.sequence(F.floor(lo / size), F.floor(hi / size))

    return F.flatten(F.transform(span(west, east), lambda i: F.transform(span(south, north), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def _shape_key(geometry: Column) -> Column:
    """What equal geometries share and others do not: 256 bits of their JSON, which has every digit."""
    return F.unhex(F.sha2(F.to_json(geometry), 256))


def _shapes(df: DataFrame, geometry: str, key: str, shape: str) -> DataFrame:
    """Each different geometry once, with its key, a written table; in as many parts as the session shuffles into, however
    few bytes these have, as tests of geometries take time."""
    own, n = F.col(f"`{geometry}`"), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = df.select(_shape_key(own).alias(key), own.alias(shape)).where(F.col(shape).isNotNull()).groupBy(key).agg(F.first(shape).alias(shape))
    return commit.written(each, "shapes").repartition(n, key)


def points_in_areas(points: DataFrame, areas: DataFrame, lng: str, lat: str, area: str, cell: float = 1.0) -> DataFrame:
    """Each point with each area that holds it: an equi-join on grid cells, then boxes, then exact, of each different place
    with each different area once; then each pair's rows by equi-joins, in which places and areas of very many rows are dealt.

    An area is in the cells of the level at which it spans four of them at most, each level's being twice as wide as those
    of the level before; so it is repeated at most 25 times however large it is. A place is in one cell of each level that
    areas have (which is asked for first; there are some twenty), so no pair comes twice. Columns of the two sides must
    have different names.
    """
    spread = with_boxes(_shapes(areas, area, "_key", "_area"), "_area").where(F.col("_west").isNotNull())
    span = F.greatest(F.col("_east") - F.col("_west"), F.col("_north") - F.col("_south"))
    spread = spread.withColumn("_level", F.greatest(F.lit(0), F.ceil(F.coalesce(F.log2(F.nullif(span, F.lit(0.0)) / (4 * cell)), F.lit(0.0))).cast("int")))
    levels = sorted(r[0] for r in spread.select("_level").distinct().collect()) or [0]
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_level"))
    x, y = F.col("_x"), F.col("_y")
    places = points.select(F.col(lng).alias("_x"), F.col(lat).alias("_y")).where(x.isNotNull() & y.isNotNull()).distinct()
    keyed = places.withColumn("_at", F.explode(F.array(*[F.lit(k) for k in levels])))
    at = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_at"))
    keyed = keyed.withColumns({"_i": F.floor(x / at), "_j": F.floor(y / at)})
    spread = spread.withColumn("_cell", F.explode(cells(F.col("_west"), F.col("_south"), F.col("_east"), F.col("_north"), size)))
    box = x.between(F.col("_west"), F.col("_east")) & y.between(F.col("_south"), F.col("_north"))
    on = (F.col("_at") == F.col("_level")) & (F.col("_i") == F.col("_cell.i")) & (F.col("_j") == F.col("_cell.j")) & box
    pairs = keyed.join(spread, on).where(geo.contains_point(F.col("_area"), x, y)).select("_x", "_y", "_key")
    out = dealt_join(pairs, areas.withColumn("_key", _shape_key(F.col(area))), ["_key"])
    out = dealt_join(out, points.withColumns({"_x": F.col(lng), "_y": F.col(lat)}), ["_x", "_y"])
    return out.select(*[F.col(f"`{c}`") for c in [*points.columns, *areas.columns]])


def with_boxes(df: DataFrame, geometry: str) -> DataFrame:
    return df.withColumns({f"_{k}": c for k, c in geo.box_columns(F.col(geometry)).items()})


def areas_meeting(left: DataFrame, right: DataFrame, areas: tuple[str, str], name: tuple[str, str] = ("left", "right"), cell: float = 1 / 64, test=geo.st_intersects) -> DataFrame:
    """Pairs (two columns, named ``name``, of records) of a left and a right row whose geometries meet, once each; or for
    which another ``test`` of two geometries holds that only those whose boxes meet can pass.

    Geometries are in the one to four cells that they touch at the level at which a cell is as wide as they are, each
    level's being twice as wide as those of the level before. There the smaller ones of the other side look for them, in
    their one to four cells of that level, and a pair is reported in the cell of the south-western corner of what their
    boxes share. Each different geometry is looked for and tested once; the rows of those that meet come by equi-joins, in
    which geometries of very many rows are dealt. Rows without a geometry meet nothing; rows that repeat are rows of their own.
    """
    def laid(df: DataFrame, area: str, own: str) -> DataFrame:
        boxes = geo.box_columns(F.col(own))
        out = _shapes(df, area, f"_{own}_key", own).select("*", *[c.alias(f"_{own}_{k}") for k, c in boxes.items()]).where(F.col(f"_{own}_west").isNotNull())
        span = F.greatest(F.col(f"_{own}_east") - F.col(f"_{own}_west"), F.col(f"_{own}_north") - F.col(f"_{own}_south"))
        return out.withColumn(f"_{own}_level", F.greatest(F.lit(0), F.ceil(F.coalesce(F.log2(F.nullif(span, F.lit(0.0)) / cell), F.lit(0.0))).cast("int")))

    def put(df: DataFrame, own: str, level: Column) -> DataFrame:
        df = df.withColumn("_level", level)
        size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_level"))
        return df.withColumn("_cell", F.explode(cells(*[F.col(f"_{own}_{k}") for k in ("west", "south", "east", "north")], size)))

    def looking(df: DataFrame, own: str, levels: list[int], higher: bool) -> DataFrame:
        mine = F.col(f"_{own}_level")
        return put(df, own, F.explode(F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: (x > mine) if higher else (x >= mine))))

    a, b = laid(left, areas[0], "x"), laid(right, areas[1], "y")
    of_a, of_b = (sorted(r[0] for r in df.select(c).distinct().collect()) for df, c in ((a, "_x_level"), (b, "_y_level")))  # some thirty at most
    size = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col("_level"))
    corner = (F.floor(F.greatest("_x_west", "_y_west") / size) == F.col("_cell.i")) & (F.floor(F.greatest("_x_south", "_y_south") / size) == F.col("_cell.j"))
    meet = (F.col("_x_west") <= F.col("_y_east")) & (F.col("_y_west") <= F.col("_x_east")) & (F.col("_x_south") <= F.col("_y_north")) & (F.col("_y_south") <= F.col("_x_north"))
    on = ["_level", "_cell"]
    larger_a = dealt_join(put(a, "x", F.col("_x_level")), looking(b, "y", of_a, False), on).where(corner & meet)
    larger_b = dealt_join(put(b, "y", F.col("_y_level")), looking(a, "x", of_b, True), on).where(corner & meet)
    kept = ["_x_key", "_y_key", "x", "y"]
    pairs = larger_a.select(*kept).unionByName(larger_b.select(*kept)).where(test(F.col("x"), F.col("y"))).select("_x_key", "_y_key")
    rows = lambda df, area, key, own: df.select(_shape_key(F.col(f"`{area}`")).alias(key), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(own))
    pairs = dealt_join(pairs, rows(right, areas[1], "_y_key", "y"), ["_y_key"])
    return dealt_join(pairs, rows(left, areas[0], "_x_key", "x"), ["_x_key"]).select(F.col("x").alias(name[0]), F.col("y").alias(name[1]))


def near_pairs(left: DataFrame, right: DataFrame, lng: tuple[str, str], lat: tuple[str, str], meters: float) -> DataFrame:
    """Pairs of rows of two tables whose points lie within so many metres of each other.

    Bands of latitude as wide as the distance are cut into cells about as wide as it at the band's middle, counted around
    the globe. A right row is in one cell; a left row in those that its reach touches, a few but near a pole; then exact.
    """
    size = math.degrees(max(meters, 1.0) / geo.RADIUS) * (1 + 1e-9) + 1e-9
    last = math.ceil(180 / size) - 1

    def band_of(c: Column) -> Column:
        return F.least(F.lit(last), F.floor((c + 90) / size)).cast("int")

    def cells_in(band: Column) -> Column:
        middle = F.least(F.lit(90.0), (band + 0.5) * size - 90)
        return F.greatest(F.lit(1), F.floor(F.cos(F.radians(middle)) * 360 / size)).cast("long")

    x, y = F.col(lng[0]), F.col(lat[0])
    reach = F.when(F.abs(y) + size < 90, F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians(F.lit(size))) / F.cos(F.radians(y))))) * (1 + 1e-9) + 1e-9).otherwise(F.lit(180.0))
    a = left.withColumn("_band", F.explode(F.filter(F.transform(F.array(*[F.lit(k) for k in (-1, 0, 1)]), lambda k: band_of(y) + k), lambda k: k.between(0, last))))
    n = cells_in(F.col("_band"))
    low, high = F.floor((x + 180 - reach) / 360 * n), F.floor((x + 180 + reach) / 360 * n)
    a = a.withColumn("_cell", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.least(high - low, n - 1)), lambda k: F.pmod(low + k, n))))
    b = right.withColumn("_band", band_of(F.col(lat[1])))
    n = cells_in(F.col("_band"))
    b = b.withColumn("_cell", F.least(n - 1, F.floor(F.pmod(F.col(lng[1]) + 180, F.lit(360.0)) / 360 * n)))
    out = a.join(b, ["_band", "_cell"]).where(geo.haversine(x, y, F.col(lng[1]), F.col(lat[1])) <= meters)
    return out.drop("_band", "_cell")
