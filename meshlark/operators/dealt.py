"""Equi-joins whose hot keys are dealt to several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one key that meet in one task at most, about; keys beyond are sent to every task, up to so many.
ROWS, SENT_KEYS = 100_000, 100_000


def hot_keys(right: DataFrame, on: list[str], rows: int = ROWS) -> DataFrame | None:
    """Keys with over ``rows`` rows, with the ``_parts`` that they need; None where there are none."""
    hot = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(*on, F.ceil(F.col("_n") / rows).cast("int").alias("_parts"))
    few = hot.limit(SENT_KEYS + 1).count()
    return None if not few else F.broadcast(hot) if few <= SENT_KEYS else hot


def in_parts(right: DataFrame, on: list[str], hot: DataFrame | None) -> DataFrame:
    """right with a ``_part`` by a hash of the row."""
    if hot is None:
        return right.withColumn("_part", F.lit(0))
    return right.join(hot, on, "left").withColumn("_part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right.columns]), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")


def to_parts(left: DataFrame, on: list[str], hot: DataFrame | None) -> DataFrame:
    """left, its rows of hot keys once for each ``_part``."""
    if hot is None:
        return left.withColumn("_part", F.lit(0))
    return left.join(hot, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")


def dealt_join(left: DataFrame, right: DataFrame, on: list[str], rows: int = ROWS) -> DataFrame:
    """The inner join on columns that both have. Of a key with over ``rows`` rows on the right, these are dealt to as many
    parts as they need, by a hash of the row, and the left rows of that key go to each of them. Null keys match nothing."""
    hot = hot_keys(right, on, rows)
    if hot is None:
        return left.join(right, on)
    return to_parts(left, on, hot).join(in_parts(right, on, hot), [*on, "_part"]).drop("_part")
