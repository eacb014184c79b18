"""The k nearest rows by place, for every row of another table.

Places are points of the unit sphere in space, so that poles and the date line are like anywhere else, and cells are cubes
that are halved from level to level. A left row looks first in its own cell at the finest level at which that cell has k
right rows: so cells are small where right rows are dense, and the k-th of these is a bound on what is near. If the bound
reaches beyond the cell, and only then, the row looks a second time, in all cells that a ball of that radius touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..sources import commit
from .dealt import dealt_join

#: The finest level, at which a cell is some 12 metres wide; cells with k rows that are sent to every task at most.
LEVELS, SENT_CELLS = 20, 200_000


def _space(lng: Column, lat: Column) -> list[Column]:
    """The point of the unit sphere, moved to where all coordinates are from 0 to 2."""
    x, y = F.radians(lng), F.radians(lat)
    return [1 + F.cos(y) * F.cos(x), 1 + F.cos(y) * F.sin(x), 1 + F.sin(y)]


def _width(level: Column) -> Column:
    return F.pow(F.lit(2.0), 1 - level)


def _index(v: Column, level: Column) -> Column:
    """The number of the cell of a coordinate, along one axis."""
    return F.least(F.greatest(F.floor(v / _width(level)), F.lit(0)), F.pow(F.lit(2.0), level).cast("long") - 1)


def _cell(indices: list[Column]) -> Column:
    i, j, k = indices
    return (i * (1 << 21) + j) * (1 << 21) + k


def nearest(
    left: DataFrame, right: DataFrame, left_place: tuple[str, str], right_place: tuple[str, str], k: int, ties: tuple[str, ...], name: str = "near",
) -> DataFrame:
    """left's rows, each with its first k of right's rows: ``name``, their record, ``meters`` and ``rank``, from 1.

    Places are columns (longitude, latitude). Of rows as far away those come first that are least by ``ties``, columns of
    right which tell its rows apart. Left rows without a place give no rows, right rows without one are near nothing; if
    right has fewer than k rows, all are returned. Left rows that repeat are rows of their own.
    """
    lng, lat = (F.col(f"`{c}`").cast("double") for c in left_place)
    a = left.where(lng.isNotNull() & lat.isNotNull()).select(F.monotonically_increasing_id().alias("_id"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"), lng.alias("_lng"), lat.alias("_lat"))
    a = commit.written(a, "nearest")  # ids stay as they are
    b_lng, b_lat = (F.col(f"`{c}`").cast("double") for c in right_place)
    b = right.where(b_lng.isNotNull() & b_lat.isNotNull()).select(F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("_right"), b_lng.alias("_rlng"), b_lat.alias("_rlat"))
    b = b.withColumns({f"_r{n}": c for n, c in enumerate(_space(F.col("_rlng"), F.col("_rlat")))})
    points = a.select("_id", "_lng", "_lat", *[c.alias(f"_v{n}") for n, c in enumerate(_space(F.col("_lng"), F.col("_lat")))])

    def at(prefix: str, level: Column) -> Column:
        return _cell([_index(F.col(f"{prefix}{n}"), level) for n in range(3)])

    def ranked(pairs: DataFrame, *kept: str) -> DataFrame:
        """Of pairs the k nearest of each left row."""
        far = pairs.withColumn("meters", geo.haversine(F.col("_lng"), F.col("_lat"), F.col("_rlng"), F.col("_rlat")))
        order = Window.partitionBy("_id").orderBy("meters", *[F.col(f"_right.`{c}`") for c in ties])
        return far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("_id", "_right", "meters", "rank", *kept)

    # The finest level at which a left row's cell has k right rows; the whole globe is one cell.
    level = F.col("_level")
    leveled = b.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    full = leveled.groupBy("_level", at("_r", level).alias("_cell")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select("_level", "_cell")
    full = commit.written(full, "full-cells")
    n_full = full.count()
    looked = points.select("_id", *[f"_v{n}" for n in range(3)]).withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))))
    looked = looked.select("_id", "_level", at("_v", level).alias("_cell")).join(F.broadcast(full) if n_full <= SENT_CELLS else full, ["_level", "_cell"], "left_semi")
    finest = looked.groupBy("_id").agg(F.max("_level").alias("_level"))
    first = points.join(finest, "_id", "left").withColumn("_level", F.coalesce("_level", F.lit(0)))
    first = commit.written(first.withColumn("_cell", at("_v", level)), "nearest")

    def among(rows: DataFrame) -> DataFrame:
        """Rows with their level and cell, with all right rows that are in it."""
        levels = sorted(r[0] for r in rows.select("_level").distinct().collect()) or [0]  # a few
        there = b.withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels])))
        return dealt_join(rows, there.withColumn("_cell", at("_r", level)), ["_level", "_cell"])

    found = commit.written(ranked(among(first)), "nearest")
    chord = 2 * F.sin(F.least(F.col("meters") / (2 * geo.RADIUS), F.lit(1.5707963267948966)))
    bound = found.groupBy("_id").agg(F.max("meters").alias("meters")).select("_id", (chord * (1 + 1e-9) + 1e-12).alias("_r"))
    border = F.least(*[F.least(F.col(f"_v{n}") - _index(F.col(f"_v{n}"), level) * _width(level), (_index(F.col(f"_v{n}"), level) + 1) * _width(level) - F.col(f"_v{n}")) for n in range(3)])
    open_ = first.join(bound, "_id").where((level > 0) & (F.col("_r") >= border))
    # Cells as wide as the radius: the ball touches three along an axis at most.
    wide = F.least(F.lit(LEVELS), F.greatest(F.lit(0), F.floor(1 - F.log2("_r")))).cast("int")
    open_ = commit.written(open_.withColumn("_level", wide).drop("_cell"), "nearest")

    def reached(n: int) -> Column:
        v = F.col(f"_v{n}")
        return F.sequence(_index(v - F.col("_r"), level), _index(v + F.col("_r"), level))

    cells = F.flatten(F.transform(reached(0), lambda i: F.flatten(F.transform(reached(1), lambda j: F.transform(reached(2), lambda m: _cell([i, j, m]))))))
    again = among(open_.withColumn("_cell", F.explode(cells)))
    apart = sum((F.col(f"_v{n}") - F.col(f"_r{n}")) * (F.col(f"_v{n}") - F.col(f"_r{n}")) for n in range(3))
    again = ranked(again.where(F.sqrt(apart) <= F.col("_r")))
    out = found.join(open_.select("_id"), "_id", "left_anti").unionByName(again)
    return out.join(a.select("_id", "_left"), "_id").select("_left.*", F.col("_right").alias(name), "meters", "rank")
