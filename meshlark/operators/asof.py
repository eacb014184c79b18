"""As-of joins: to each row the last row of another table before it, of the same key.

Both tables are laid out as one, in ranges of key and time, and each range is merged in order; what a range ends with is
carried to the next one, so that neither a key nor a time has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import commit

#: States of ranges, a row each, that are sent to every task at most.
SENT_ROWS = 10_000


def _merge(keys: int):
    """Rows (k0.., right?, l, r) in order: left rows with the last right row of their key so far, and at the end a row with
    the state of the range. Left rows that the range before may still have something for are marked as open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = held = None  # keys as one-row arrays, and the last right row of the key
        single, names = True, None

        def out(l, r, open_, key, state):
            n = len(l)
            cols = [pa.array(np.full(n, part, np.int32)), pa.array(open_), pa.array(np.full(n, state)), *key, l, r]
            return pa.RecordBatch.from_arrays(cols, names=["part", "open", "state", *[f"f{k}" for k in range(keys)], *[f"k{k}" for k in range(keys)], "l", "r"])

        for b in batches:
            n = b.num_rows
            if not n:
                continue
            cols, right, l, r = b.columns[:keys], np.asarray(b.column(keys).to_numpy(zero_copy_only=False), bool), b.column(keys + 1), b.column(keys + 2)
            names = b.schema
            if first is None:
                first = [c.slice(0, 1) for c in cols]
            new = np.zeros(n, bool)
            for k, c in enumerate(cols):
                before = pa.concat_arrays([last[k] if last else c.slice(0, 1), c.slice(0, n - 1)])
                new |= pc.fill_null(pc.not_equal(c, before), True).to_numpy(zero_copy_only=False)
            at = np.arange(n)
            begin = np.maximum.accumulate(np.where(new, at, 0))
            found = np.maximum.accumulate(np.where(right, at, -1))
            found = np.where(found >= begin, found, np.where((begin == 0) & ~new[0] & (held is not None), n, -1))
            pool = pa.concat_arrays([r, held]) if held is not None else r
            in_first = (begin == 0) & ~new[0] if single else np.zeros(n, bool)
            single = single and not new.any()
            rows = np.flatnonzero(~right)
            if len(rows):
                take = pa.array(found[rows], mask=found[rows] < 0)
                key = [c.take(pa.array(rows)) for c in cols]
                yield out(l.take(pa.array(rows)), pool.take(take), (found[rows] < 0) & in_first[rows], [*[c.take(pa.array(np.zeros(len(rows), np.int64))) for c in first], *key], False)
            last = [c.slice(n - 1, 1) for c in cols]
            held = pool.slice(int(found[-1]), 1) if found[-1] >= 0 else None
        if first is not None:
            none = pa.nulls(1, names.field(keys + 1).type)
            yield out(none, held if held is not None else pa.nulls(1, names.field(keys + 2).type), np.zeros(1, bool), [*first, *last], True)

    return run


def as_of(
    left: DataFrame, right: DataFrame, on: dict[str, str], at: tuple[str, str], name: str, ties: tuple[str, ...] = (), strict: bool = False,
) -> DataFrame:
    """left's rows, each with a column ``name``: the record of the last row of right whose key is the same (``on``: left's
    columns to right's) and whose time is not after its own (``strict``: is before); ``at`` are the columns of time, any type
    with an order. Of several right rows at one time the greatest by ``ties`` (nulls lowest) is the last; any of those that
    are alike in these too. Null where there is none, and for rows with a null key or time; right rows with a null key or
    time match nothing. Right's keys and times are cast to left's types.
    """
    spark = left.sparkSession
    n = len(on)
    keys = [f"k{k}" for k in range(n)]
    quoted = lambda c: F.col(f"`{c}`")
    known = lambda cols: reduce(lambda a, b: a & b, [quoted(c).isNotNull() for c in cols])

    def laid(df: DataFrame, cols: list[str], time: str, is_right: bool) -> DataFrame:
        own = F.struct(*[quoted(c) for c in df.columns])
        rank = F.struct(*[quoted(c) for c in ties]) if is_right and ties else F.lit(None).cast(rank_kind)
        mine, other = ("r", "l") if is_right else ("l", "r")
        return df.where(known([*cols, time])).select(*[quoted(c).cast(kinds[k]).alias(f"k{k}") for k, c in enumerate(cols)], quoted(time).cast(time_kind).alias("t"), F.lit(is_right).alias("right"), rank.alias("rank"), own.alias(mine), F.lit(None).cast(schemas[other]).alias(other))

    kinds = [left.schema[c].dataType for c in on]
    time_kind = left.schema[at[0]].dataType
    rank_kind = T.StructType([right.schema[c] for c in ties]) if ties else T.StructType([T.StructField("x", T.IntegerType())])
    schemas = {"l": T.StructType(left.schema.fields), "r": T.StructType(right.schema.fields)}
    rows = laid(right, list(on.values()), at[1], True).unionByName(laid(left, list(on), at[0], False))
    # At one time right rows come first, or last if they must be before. Hashes part rows that are alike in all else.
    order: list[Column] = [*[F.col(k) for k in keys], F.col("t"), F.col("right") if strict else ~F.col("right"), F.col("rank"), F.xxhash64("l", "r")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*keys, "right", "l", "r")
    schema = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("open", T.BooleanType()), T.StructField("state", T.BooleanType())]
        + [T.StructField(f"{p}{k}", kinds[k]) for p in "fk" for k in range(n)] + [T.StructField("l", schemas["l"]), T.StructField("r", schemas["r"])]
    )
    merged = commit.written(rows.mapInArrow(_merge(n), schema), "as-of")

    # What each range begins with: the last right row of its first key in the ranges before, if these end with that key.
    states = merged.where("state")
    after = Window.partitionBy(*keys).orderBy("part")
    states = states.withColumn("now", F.last("r", ignorenulls=True).over(after))
    before = Window.orderBy("part")  # a row to each range
    same = F.lit(True)
    for k in range(n):
        same = same & (F.lag(f"k{k}").over(before) == F.col(f"f{k}"))
    carried = states.select("part", F.when(same, F.lag("now").over(before)).alias("carried")).where("carried is not null")
    small = states.count() <= SENT_ROWS
    matched = merged.where("not state")
    opened = matched.where("open").join(F.broadcast(carried) if small else carried, "part", "left").select("l", F.col("carried").alias("r"))
    rows = matched.where("not open").select("l", "r").unionByName(opened)
    out = rows.select("l.*", F.col("r").alias(name))
    without = left.where(~known([*on, at[0]])).withColumn(name, F.lit(None).cast(schemas["r"]))
    return out.unionByName(without)
