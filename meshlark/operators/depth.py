"""Chains of any length: what can be reached over edges, and in how many hops.

Each round joins only the nodes that the round before reached first with the edges, and keeps what no round had reached;
so cycles end, every edge is followed once for each source, and hops are the fewest. A round is a table in the shared
folder: a lost task goes back to the round before.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import commit
from ..sources.graph import Graph
from . import dealt
from .paths import paths


def edges_of(graph: Graph, resource: str, *hops: str | tuple) -> DataFrame:
    """The different pairs (src, dst) of a node's key and the key of a node that hops lead to from it; keys of one column."""
    (p,) = paths(graph, resource, tuple(("forward", h) if isinstance(h, str) else h for h in hops))
    (key,) = graph.keys(resource)
    here = graph.frame(resource).select(F.col(f"`{key}`").alias("src"), *[F.col(f"`{c}`").alias(f"_j{n}") for n, c in enumerate(p.join)])
    on = reduce(lambda a, b: a & b, [F.col(f"_j{n}") == F.col(c) for n, c in enumerate(p.entry)])
    return p.frame.select(*p.entry, F.col(p.key[0]).alias("dst")).join(here, on).select("src", "dst").distinct()


def hops_from(edges: DataFrame, sources: DataFrame, most: int | None = None, apart: bool = False, rows: int = dealt.ROWS) -> DataFrame:
    """(node, hops) of all nodes that can be reached over edges (src, dst) from the sources, a one-column table, which are
    there with 0 hops themselves; hops are from the nearest source. ``apart``: (source, node, hops) for each source by
    itself. At most ``most`` hops, if that is given.

    Null ends and null sources are nothing; edges and sources that repeat count once. Edges of a node with over ``rows``
    of them are dealt to several tasks. Without sources there are no rows.
    """
    edges = commit.written(edges.select("src", "dst").where("src is not null and dst is not null and src <> dst").distinct(), "edges")
    kind = edges.schema["src"].dataType
    hot = dealt.hot_keys(edges, ["src"], rows)
    parted = dealt.in_parts(edges, ["src"], hot)
    keys = ["source", "node"] if apart else ["node"]
    start = sources.toDF("node").select(F.col("node").cast(kind).alias("node")).where("node is not null").distinct()
    if apart:
        start = start.select(F.col("node").alias("source"), "node")
    rounds = [commit.written(start.withColumn("hops", F.lit(0)), "hops")]
    while most is None or len(rounds) <= most:
        from_ = dealt.to_parts(rounds[-1].drop("hops").withColumnRenamed("node", "src"), ["src"], hot)
        found = from_.join(parted, ["src", "_part"]).select(*keys[:-1], F.col("dst").alias("node")).distinct()
        seen = reduce(DataFrame.unionByName, rounds).select(*keys)
        new = commit.written(found.join(seen, keys, "left_anti").withColumn("hops", F.lit(len(rounds))), "hops")
        if new.isEmpty():
            break
        rounds.append(new)
    return reduce(DataFrame.unionByName, rounds)
