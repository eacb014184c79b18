"""Joins of intervals that overlap, as equi-joins on dyadic cells.

An interval's level is the least at which a cell is longer than it, so that it touches two cells there at most. It is
found there by the intervals of lower levels, which look for it in the one or two cells that they touch at that level, and
in turn looks for those of higher levels. Two that overlap share the cell in which their overlap begins; they are reported
in that one alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dealt import dealt_join


def _position(c: Column, kind: T.DataType, unit: float) -> Column:
    """A value as a whole number, in order: days, microseconds, or as many units."""
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_timestamp(c))
    return F.floor(c / F.lit(unit)).cast("long") if unit != 1 or isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)) else c.cast("long")


def overlapping(
    left: DataFrame, right: DataFrame, left_ends: tuple[str, str], right_ends: tuple[str, str], on: dict[str, str] | None = None, closed: bool = True, unit: float = 1, name: tuple[str, str] = ("left", "right"),
) -> DataFrame:
    """Pairs (two columns, named ``name``, of records) of a left and a right row whose intervals overlap and whose columns
    ``on`` (left's to right's) are equal.

    Ends are whole numbers, dates, timestamps or, in cells of ``unit``, other numbers; ``closed`` intervals that touch
    overlap, others must share more than an end. Rows with a null end or key, or that end before they begin, overlap
    nothing; rows that repeat are rows of their own. However long an interval is, it is one or two rows on its own side;
    a row is found by longer ones once or twice for each level that these have. Cells with very many rows are dealt.
    """
    on = on or {}

    def laid(df: DataFrame, ends: tuple[str, str], keys: list[str], own: str) -> DataFrame:
        lo, hi = (_position(F.col(f"`{c}`"), df.schema[c].dataType, unit) for c in ends)
        out = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(own), *[F.col(f"`{c}`").alias(f"_k{n}") for n, c in enumerate(keys)], F.col(f"`{ends[0]}`").alias(f"_{own}_lo"), F.col(f"`{ends[1]}`").alias(f"_{own}_hi"), lo.alias(f"_{own}_a"), hi.alias(f"_{own}_b"))
        out = out.where(F.col(f"_{own}_lo") <= F.col(f"_{own}_hi"))
        length = F.col(f"_{own}_b") - F.col(f"_{own}_a")
        return out.withColumn(f"_{own}_level", F.when(length <= 0, 0).otherwise(F.length(F.bin(length))).cast("int"))

    a, b = laid(left, left_ends, list(on), "x"), laid(right, right_ends, list(on.values()), "y")
    shift = lambda c, level: F.call_function("shiftright", c, level)

    def cells(df: DataFrame, own: str, level: Column) -> DataFrame:
        df = df.withColumn("_level", level)
        return df.withColumn("_cell", F.explode(F.sequence(shift(F.col(f"_{own}_a"), F.col("_level")), shift(F.col(f"_{own}_b"), F.col("_level")))))

    def visiting(df: DataFrame, own: str, levels: list[int], higher: bool) -> DataFrame:
        mine = F.col(f"_{own}_level")
        wanted = F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: (x > mine) if higher else (x >= mine))
        return cells(df, own, F.explode(wanted))

    # There are some sixty levels at most.
    of_a, of_b = (sorted(r[0] for r in df.select(c).distinct().collect()) for df, c in ((a, "_x_level"), (b, "_y_level")))
    keys = [*[f"_k{n}" for n in range(len(on))], "_level", "_cell"]
    begin = shift(F.greatest("_x_a", "_y_a"), F.col("_level"))
    overlap = (F.col("_x_lo") <= F.col("_y_hi")) & (F.col("_y_lo") <= F.col("_x_hi")) if closed else (F.col("_x_lo") < F.col("_y_hi")) & (F.col("_y_lo") < F.col("_x_hi"))
    kept = (begin == F.col("_cell")) & overlap
    longer_a = dealt_join(cells(a, "x", F.col("_x_level")), visiting(b, "y", of_a, False), keys).where(kept)
    longer_b = dealt_join(cells(b, "y", F.col("_y_level")), visiting(a, "x", of_b, True), keys).where(kept)
    pair = [F.col("x").alias(name[0]), F.col("y").alias(name[1])]
    return longer_a.select(*pair).unionByName(longer_b.select(*pair))
