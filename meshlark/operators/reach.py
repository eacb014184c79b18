"""Tests of what chains reach, as semi-joins, anti-joins and joined measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.expr import OPS, Attr, Reach, column, wrap
from ..sources.graph import Graph
from . import factored
from .paths import Path, paths


def _on(p: Path, entry: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`") == F.col(f"`{x}`") for c, x in zip(p.join, entry, strict=True)])


def _existential(r: Reach) -> bool | None:
    """Whether the test asks for a match or for none; null if it measures."""
    if r.kind != "any":
        return None
    if r.value not in (True, False) or r.op not in ("==", "!="):
        raise ValueError("existence is compared with true or false")
    return r.value is (r.op == "==")


def _matches(r: Reach, p: Path) -> DataFrame:
    """Entry keys of the paths that meet the test; repeats do no harm to the joins they go into."""
    test = None if r.where is None else column(r.where, p)
    frame = p.frame if test is None else p.frame.where(test)
    return frame.select(*p.entry)


def _flag(graph: Graph, resource: str, df: DataFrame, r: Reach, name: str) -> DataFrame:
    """df with a column that says whether some path meets the test."""
    flags = []
    for k, p in enumerate(paths(graph, resource, r.hops)):
        entry = [f"{name}_{k}_{n}" for n in range(len(p.entry))]
        rows = _matches(r, p).select(*[F.col(c).alias(x) for c, x in zip(p.entry, entry, strict=True)]).distinct()
        df = df.join(rows, _on(p, entry), "left")
        flags.append((F.col(entry[0]).isNotNull(), entry))
    df = df.withColumn(name, reduce(lambda a, b: a | b, [f for f, _ in flags]))
    return df.drop(*[c for _, e in flags for c in e])


def _measured(graph: Graph, resource: str, df: DataFrame, r: Reach, name: str) -> DataFrame:
    """df with the measure of what the chain reaches: over paths, but for count, which is of distinct nodes."""
    found = paths(graph, resource, r.hops)
    if len({tuple(p.join) for p in found}) > 1:
        raise ValueError("the chain starts with several kinds of edges; type its hops")
    if len(found) == 1 and factored.applies(found[0].steps):
        return _carried(graph, resource, df, r, name, found[0].steps)
    entry = [f"{name}_{n}" for n in range(len(found[0].entry))]
    tables = []
    for p in found:
        value = F.struct(F.lit(p.at).alias("at"), F.to_json(F.struct(*p.key)).alias("key")) if r.kind == "count" and len(found) > 1 else F.struct(*p.key) if r.kind == "count" else p.column(r.field)
        tables.append(p.frame.select(*[F.col(c).alias(x) for c, x in zip(p.entry, entry, strict=True)], value.alias(name)))
    rows = reduce(lambda a, b: a.unionByName(b), tables)
    agg = {"count": F.count_distinct, "min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum}[r.kind](F.col(name))
    table = rows.groupBy(*entry).agg(agg.alias(name))
    df = df.join(table, _on(found[0], entry), "left").drop(*entry)
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(0))) if r.kind in ("count", "sum") else df


def _carried(graph: Graph, resource: str, df: DataFrame, r: Reach, name: str, steps: list) -> DataFrame:
    """The same of a chain whose partial results move hop by hop."""
    v, n = "_carried", "_carried_n"
    if r.kind == "count":
        t = factored.distinct(graph, resource, steps, {v: factored.reached})
        value = F.col(v)
    else:
        how = {"min": factored.MIN, "max": factored.MAX}.get(r.kind, factored.SUM)

        def start(p: Path) -> dict:
            c = p.column(r.field)
            parts = {v: (factored.summable(c, p.frame) if r.kind == "avg" else c, how)}
            return parts | ({n: (F.when(c.isNotNull(), 1).otherwise(0).cast("long"), factored.SUM)} if r.kind == "avg" else {})

        t = factored.carry(graph, resource, steps, start)
        value = F.col(v) / F.nullif(F.col(n), F.lit(0)) if r.kind == "avg" else F.col(v)
    entry = [f"{name}_{k}" for k in range(len(t.entry))]
    table = t.frame.select(*[F.col(c).alias(x) for c, x in zip(t.entry, entry, strict=True)], value.alias(name))
    on = reduce(lambda a, b: a & b, [F.col(f"`{c}`") == F.col(x) for c, x in zip(t.join, entry, strict=True)])
    df = df.join(table, on, "left").drop(*entry)
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(0))) if r.kind in ("count", "sum") else df


def keep(graph: Graph, resource: str, df: DataFrame, r: Reach) -> DataFrame:
    """df's rows that meet the test."""
    wanted = _existential(r)
    found = paths(graph, resource, r.hops) if wanted is not None else []
    if wanted is True and len(found) == 1:
        (p,) = found
        return df.join(_matches(r, p), _on(p, p.entry), "left_semi")
    if wanted is False:
        for p in found:
            df = df.join(_matches(r, p), _on(p, p.entry), "left_anti")
        return df
    name = "_reach"
    if wanted is True:
        return _flag(graph, resource, df, r, name).where(F.col(name)).drop(name)
    df = _measured(graph, resource, df, r, name)
    return df.where(OPS[r.op](F.col(name), column(wrap(r.value), _NoScope()))).drop(name)


def mark(graph: Graph, resource: str, df: DataFrame, r: Reach, name: str) -> tuple[DataFrame, Column]:
    """df with a helping column, and the test as a Column over it, for use under or and not."""
    wanted = _existential(r)
    if wanted is not None:
        return _flag(graph, resource, df, r, name), F.col(name) if wanted else ~F.col(name)
    return _measured(graph, resource, df, r, name), OPS[r.op](F.col(name), column(wrap(r.value), _NoScope()))


def connected(graph: Graph, resource: str, source: dict, hops: tuple, destination: str, match: dict) -> bool:
    """Whether hops lead from a node with these properties to a node with those, whatever lies between.

    A hop may name an edge type alone, so that the nodes it reaches are of any resource.
    """
    def having(name: str, properties: dict) -> DataFrame:
        r, df = graph.resource(graph.check(name)), graph.frame(name)
        return reduce(lambda d, kv: d.where(F.col(f"`{r.stored(kv[0])}`").eqNullSafe(F.lit(kv[1]))), properties.items(), df)

    for p in paths(graph, resource, hops):
        if p.at != destination:
            continue
        here = having(resource, source).select(*[F.col(f"`{c}`").alias(f"_h{n}") for n, c in enumerate(p.join)])
        there = having(destination, match).select(*[F.col(f"`{c}`").alias(f"_t{n}") for n, c in enumerate(graph.keys(destination))])
        found = p.frame.join(here, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_h{n}") for n, c in enumerate(p.entry)]), "left_semi")
        found = found.join(there, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_t{n}") for n, c in enumerate(p.key)]), "left_semi")
        if not found.isEmpty():
            return True
    return False


def related_pairs(graph: Graph, resource: str, ids: DataFrame, hops: tuple) -> DataFrame:
    """(source, node): each key of ids, a one-column table, with the record of each different node that hops lead to;
    a key that leads to none, or that no node has, comes once with a null node. Hops end at one resource."""
    found = paths(graph, resource, hops)
    if len(found) > 1:
        raise ValueError("the hops lead to several resources; type them")
    (p,), (key,) = found, graph.keys(resource)
    wanted = ids.toDF("source").distinct()
    here = graph.frame(resource).select(F.col(f"`{key}`").alias("_id"), *[F.col(f"`{c}`").alias(f"_j{n}") for n, c in enumerate(p.join)])
    r = graph.resource(p.at)
    record = F.struct(*[F.col(f"`{p.load().have[r.stored(a.name)]}`").alias(a.name) for a in r.attributes if a.name not in r.skip])
    rows = p.frame.withColumn("node", record).dropDuplicates([*p.entry, *p.key]).select(*p.entry, "node")
    pairs = wanted.join(here, F.col("source") == F.col("_id")).join(rows, reduce(lambda a, b: a & b, [F.col(f"_j{n}") == F.col(c) for n, c in enumerate(p.entry)]))
    return wanted.join(pairs.select(F.col("source").alias("_id"), "node"), F.col("source") == F.col("_id"), "left").select("source", "node")


class _NoScope:
    def column(self, name):
        raise TypeError(f"a measure is compared with values, not with {Attr(name)}")

    def is_ci(self, name):
        return False

    calculation = column
