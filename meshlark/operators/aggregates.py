"""Aggregates over what a path reaches: per record, over a whole result, or over the rows themselves.

Aggregates of one path share one scan and one shuffle. Chains of several hops move partial results hop by hop
(``factored``); of a limited result only the rows that are left are followed. Counts are of paths (distinct nodes if uniq); sums of
nothing are 0 for a field and null for an expression; exists of nothing is false; list is in order of the
reached keys, first is the value of the smallest; nulls are skipped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.expr import Attr, Expr, column
from ..schema import Aggregate, Mergeable
from ..sources.graph import Graph
from . import factored
from .paths import Keys, Path, Step, only, paths, resolve

KINDS = ("count", "exists", "sum", "avg", "min", "max", "list", "first")


def measure(a: Aggregate, scope, key: list[str]) -> Column:
    """The aggregate as a Column over rows of a scope whose nodes have this key."""
    if a.kind not in KINDS and not isinstance(a.kind, Mergeable):
        raise ValueError(f"aggregate kind {a.kind} is not supported")
    live = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in key])
    if a.filter is not None:
        live = live & F.coalesce(column(a.filter, scope), F.lit(False))
    node = F.when(live, F.struct(*key))
    if a.kind in ("count", "exists"):
        n = F.count_distinct(node) if a.uniq and a.kind == "count" else F.count(F.when(live, F.lit(1)))
        return n.cast("long") if a.kind == "count" else n > 0
    v = F.when(live, column(a.expr if a.expr is not None else Attr(a.field), scope))
    if isinstance(a.kind, Mergeable):
        return a.kind.finish(a.kind.step(v))
    if a.kind == "sum":
        s = F.sum_distinct(v) if a.uniq else F.sum(v)
        return s if a.expr is not None else F.coalesce(s, F.lit(0))
    if a.kind == "avg":
        return F.sum_distinct(v) / F.count_distinct(v) if a.uniq else F.avg(v)
    if a.kind in ("min", "max"):
        return getattr(F, a.kind)(v)
    if a.kind == "first":
        return F.min_by(v, F.when(v.isNotNull(), node))
    found = F.transform(F.array_sort(F.collect_list(F.when(v.isNotNull(), F.struct(node.alias("k"), v.alias("v"))))), lambda x: x["v"])
    return F.array_distinct(found) if a.uniq else found


def default(a: Aggregate, c: Column) -> Column:
    """The value for a record that reaches nothing."""
    if a.kind == "count" or a.kind == "sum" and a.expr is None:
        return F.coalesce(c, F.lit(0))
    if a.kind == "exists":
        return F.coalesce(c, F.lit(False))
    return c


def _filled(a: Aggregate, joined: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    if a.kind == "list":
        return F.coalesce(c, F.array().cast(joined.schema[name].dataType))
    return default(a, c)


def by_path(aggs: list[Aggregate]) -> dict[tuple, list[Aggregate]]:
    out: dict[tuple, list[Aggregate]] = {}
    for a in aggs:
        out.setdefault(a.path, []).append(a)
    return out


def _chain(graph: Graph, resource: str, path: tuple) -> list[Step]:
    found = resolve(graph, resource, tuple(("forward", n) for n in path))
    if len(found) != 1:
        raise ValueError(f"path {path} leads to several resources")
    return found[0]


def _live(a: Aggregate, p: Path) -> Column:
    test = factored.reached(p)
    return test if a.filter is None else test & F.coalesce(column(a.filter, p), F.lit(False))


def moves(a: Aggregate) -> bool:
    """Whether partial results of the aggregate can be put together hop by hop."""
    return isinstance(a.kind, Mergeable) or a.kind in ("count", "exists", "min", "max", "first") or a.kind in ("sum", "avg") and not a.uniq


def _partials(a: Aggregate, name: str, p: Path) -> dict[str, tuple[Column, object]]:
    """What a row at the far end adds to an aggregate."""
    live, none = _live(a, p), F.lit(None)
    if a.kind in ("count", "exists"):
        return {name: (F.when(live, 1).otherwise(0).cast("long"), factored.SUM)}
    v = column(a.expr if a.expr is not None else Attr(a.field), p)
    if isinstance(a.kind, Mergeable):
        return {name: (F.when(live, v), factored.Stepwise(a.kind.step, a.kind.merge))}
    if a.kind == "sum":
        return {name: (F.when(live, v).otherwise(none), factored.SUM)}
    if a.kind == "avg":
        return {name: (F.when(live, factored.summable(v, p.frame)), factored.SUM), f"{name}_n": (F.when(live & v.isNotNull(), 1).otherwise(0).cast("long"), factored.SUM)}
    if a.kind in ("min", "max"):
        return {name: (F.when(live, v), factored.MIN if a.kind == "min" else factored.MAX)}
    return {name: (F.when(live & v.isNotNull(), F.struct(F.struct(*p.key).alias("k"), v.alias("v"))), factored.MIN)}


def _finished(a: Aggregate, name: str) -> Column:
    c = F.col(name)
    if isinstance(a.kind, Mergeable):
        return a.kind.finish(c)
    if a.kind == "exists":
        return c > 0
    if a.kind == "sum" and a.expr is None:
        return F.coalesce(c, F.lit(0))
    if a.kind == "avg":
        return c / F.nullif(F.col(f"{name}_n"), F.lit(0))
    return c["v"] if a.kind == "first" else c


def _tables(graph: Graph, resource: str, path: tuple, aggs: list[Aggregate], keys: Keys | None, few: bool) -> list[tuple[list[Aggregate], factored.Table]]:
    """The aggregates of a path with their values by source, in one table or several."""
    steps = _chain(graph, resource, path)
    if factored.applies(steps) and not few:
        sets = [a for a in aggs if a.kind == "count" and a.uniq]
        sums = [a for a in aggs if a not in sets and moves(a)]
    else:
        sets, sums = [], []
    out = []
    if sums:
        t = factored.carry(graph, resource, steps, lambda p: reduce(lambda x, y: x | y, [_partials(a, f"_v{n}", p) for n, a in enumerate(sums)]), keys=keys)
        t.frame = t.frame.select(*t.entry, *[_finished(a, f"_v{n}").alias(a.name) for n, a in enumerate(sums)])
        out.append((sums, t))
    if sets:
        t = factored.distinct(graph, resource, steps, {f"_v{n}": (lambda p, a=a: _live(a, p)) for n, a in enumerate(sets)}, keys)
        t.frame = t.frame.select(*t.entry, *[F.col(f"_v{n}").alias(a.name) for n, a in enumerate(sets)])
        out.append((sets, t))
    rest = [a for a in aggs if a not in sets and a not in sums]
    if rest:
        p = Path(graph, resource, steps)
        names = [f"_k{n}" for n in range(len(p.entry))]
        measured = [measure(a, p, p.key).alias(a.name) for a in rest]
        frame = only(p, keys).groupBy(*[F.col(c).alias(x) for c, x in zip(p.entry, names, strict=True)]).agg(*measured)
        out.append((rest, factored.Table(frame, names, p.join)))
    return out


def per_record(graph: Graph, resource: str, df: DataFrame, aggs: list[Aggregate], keys: Keys | None = None, few: bool = False) -> DataFrame:
    """df (a resource's rows, stored columns) with a column for each aggregate.

    ``keys`` gives, for columns of the resource's table, their values in the rows of df, where these are a part of the
    table: edges of other rows are left out by a semi-join. ``few``: they are so few that their paths are followed.
    """
    for path, some in by_path(aggs).items():
        for own, t in _tables(graph, resource, path, some, keys, few):
            names = [f"_k_{c}" for c in t.entry]
            table = t.frame.withColumnsRenamed(dict(zip(t.entry, names, strict=True)))
            on = reduce(lambda x, y: x & y, [F.col(f"`{c}`") == F.col(x) for c, x in zip(t.join, names, strict=True)])
            df = df.join(table, on, "left").drop(*names)
            df = df.withColumns({a.name: _filled(a, df, a.name) for a in own})
    return df


def total(graph: Graph, resource: str, df: DataFrame, aggs: list[Aggregate], scope, limited: bool = False) -> DataFrame:
    """One row: the aggregates over all rows of df together. scope: of df, for aggregates without a path. ``limited``: df
    has few rows, so that the paths that begin there are followed."""
    tables = []
    for path, some in by_path(aggs).items():
        if path and not limited and factored.applies(_chain(graph, resource, path)) and all(moves(a) and not (a.kind == "count" and a.uniq) for a in some):
            t = factored.carry(graph, resource, _chain(graph, resource, path), lambda p, some=some: reduce(lambda x, y: x | y, [_partials(a, f"_v{n}", p) for n, a in enumerate(some)]))
            names = [f"_s{n}" for n in range(len(t.join))]
            sources = df.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(t.join, names, strict=True)])
            rows = t.frame.join(sources, reduce(lambda x, y: x & y, [F.col(c) == F.col(x) for c, x in zip(t.entry, names, strict=True)]))
            put = {"min": F.min, "first": F.min, "max": F.max}
            rows = rows.agg(*[(a.kind.merge if isinstance(a.kind, Mergeable) else put.get(a.kind, F.sum))(F.col(c)).alias(c) for n, a in enumerate(some) for c in ([f"_v{n}", f"_v{n}_n"] if a.kind == "avg" else [f"_v{n}"])])
            tables.append(rows.select(*[default(a, _finished(a, f"_v{n}")).alias(a.name) for n, a in enumerate(some)]))
            continue
        if path:
            (p,) = paths(graph, resource, tuple(("forward", n) for n in path))
            measured = [default(a, measure(a, p, p.key)).alias(a.name) for a in some]
            names = [f"_s{n}" for n in range(len(p.join))]
            sources = df.select(*[F.col(f"`{c}`").alias(x) for c, x in zip(p.join, names, strict=True)])
            rows = p.frame.join(sources, reduce(lambda x, y: x & y, [F.col(c) == F.col(x) for c, x in zip(p.entry, names, strict=True)]))
        else:
            measured, rows = [default(a, measure(a, scope, graph.keys(resource))).alias(a.name) for a in some], df
        tables.append(rows.agg(*measured))
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t)  # one row each
    return out
