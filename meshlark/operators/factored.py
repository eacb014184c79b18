"""Aggregates over chains without their paths.

Partial results start at the far end of a chain and move towards its source hop by hop: those of a node's edges are added
up (or their least or greatest is taken) before the next hop, so that no step has more rows than the hop has edges,
however many paths there are. Distinct nodes move as bitmaps of 64 keys a row, which are or-ed at each hop.

That is the same as going over all paths where no path can use an edge twice: chains that name an edge type twice are
left to ``paths``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.graph import Graph
from .paths import Keys, Path, Step, match, only

#: How partial results of a name are put together.
SUM, MIN, MAX, OR = F.sum, F.min, F.max, F.bit_or


@dataclass(frozen=True)
class Stepwise:
    """Values are aggregated by one function at the far end, and what it gives by another at each hop."""

    step: Callable[[Column], Column]
    merge: Callable[[Column], Column]


@dataclass
class Table:
    """Partial results: ``entry`` are the columns that match ``join`` of the source's table. A source has one row, or one for
    each word of a bitmap."""

    frame: DataFrame
    entry: list[str]
    join: list[str]


def _far(steps: list[Step]) -> int:
    """The step with which the far end begins: hops to the owner of a key after it add no rows."""
    last = len(steps) - 1
    while last and steps[last].edge.columns and steps[last].outgoing:
        last -= 1
    return last


def applies(steps: list[Step]) -> bool:
    """Whether partial results cost less than paths, and say the same."""
    return _far(steps) > 0 and len({id(s.edge) for s in steps}) == len(steps)


def carry(
    graph: Graph, resource: str, steps: list[Step], start: Callable[[Path], dict[str, tuple[Column, Callable]]], by: Callable[[Path], Column] | None = None, keys: Keys | None = None,
) -> Table:
    """Partial results of a chain from ``resource``. ``start`` gives those of a row at the far end, by name, and how they
    are put together; ``by`` a further column to keep apart. ``keys``: the sources that count, if not all do."""
    at = [resource, *[s.destination for s in steps]]
    last = _far(steps)
    p = Path(graph, at[last], steps[last:])
    parts = start(p)
    word = by(p) if by else None
    names = {n: how for n, (_, how) in parts.items()}

    def grouped(hop: Path, frame: DataFrame, values: dict[str, Column], word: Column | None, n: int) -> Table:
        entry = [f"_f{n}_{k}" for k in range(len(hop.entry))]
        frame = only(hop, keys, frame) if n == 0 else frame
        ends = [F.col(c).alias(x) for c, x in zip(hop.entry, entry, strict=True)]
        frame = frame.select(*ends, *([word.alias("_word")] if by else []), *[c.alias(x) for x, c in values.items()])
        first = steps[n]
        if not (first.edge.columns and first.outgoing):  # else the entry is the key of one node
            how = lambda f: f if not isinstance(f, Stepwise) else f.step if n == last else f.merge
            frame = frame.groupBy(*entry, *(["_word"] if by else [])).agg(*[how(f)(F.col(x)).alias(x) for x, f in names.items()])
        return Table(frame, entry, hop.join)

    out = grouped(p, p.frame, {n: c for n, (c, _) in parts.items()}, word, last)
    for n in range(last - 1, -1, -1):
        hop = Path(graph, at[n], [steps[n]])
        own = hop.key if out.join == graph.keys(at[n + 1]) else [hop.load().have[c] for c in out.join]
        frame = hop.frame.join(out.frame, match(own, out.entry))
        out = grouped(hop, frame, {x: F.col(x) for x in names}, F.col("_word"), n)
    return out


def bitmap(p: Path) -> tuple[Column, Column]:
    """(word, bits) of the reached node's key: 64 whole-number keys share a word; other keys have one each."""
    kinds = dict(p.frame.dtypes)
    if len(p.key) == 1 and kinds[p.key[0]] in ("tinyint", "smallint", "int", "bigint"):
        k = F.col(p.key[0]).cast("long")
        return F.call_function("shiftright", k, F.lit(6)), F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    return F.struct(*p.key), F.lit(1).cast("long")


def distinct(graph: Graph, resource: str, steps: list[Step], live: dict[str, Callable[[Path], Column]], keys: Keys | None = None) -> Table:
    """Counts, by name, of the different nodes that each source reaches and for which ``live`` holds."""
    def start(p: Path) -> dict[str, tuple[Column, Callable]]:
        return {n: (F.when(test(p), bitmap(p)[1]).otherwise(F.lit(0).cast("long")), OR) for n, test in live.items()}

    out = carry(graph, resource, steps, start, lambda p: bitmap(p)[0], keys)
    return Table(out.frame.groupBy(*out.entry).agg(*[F.sum(F.bit_count(n)).alias(n) for n in live]), out.entry, out.join)


def reached(p: Path) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in p.key])


def summable(c: Column, df: DataFrame) -> Column:
    """A value as it is averaged: decimals stay, other numbers are doubles."""
    return c if isinstance(df.select(c.alias("v")).schema["v"].dataType, T.DecimalType) else c.cast("double")
