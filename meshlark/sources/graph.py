"""A property graph over DataFrames: a table for each resource; edges as foreign keys or tables of pairs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import UnresolvableTraversal
from ..schema import Resource

LABELS = "_labels"


@dataclass(frozen=True, eq=False)
class Edge:
    """columns: of the source's table, holding the destination's key. pairs: a table of src and dst instead, for
    single-column keys (and edge_id, if two nodes may have several such edges)."""

    type: str
    source: str
    destination: str
    columns: tuple[str, ...] = ()
    pairs: DataFrame | None = None


class Graph:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.resources: dict[str, Resource] = {}
        self.frames: dict[str, DataFrame] = {}
        self.edges: list[Edge] = []

    def add(self, resource: Resource, df: DataFrame) -> Graph:
        resource.validate()
        self.resources[resource.own_label] = resource
        self.frames[resource.own_label] = df
        return self

    def key_edge(self, type: str, source: str, destination: str, *columns: str) -> Graph:
        """An edge kept as a foreign key, which names nodes that exist or is null."""
        self.edges.append(Edge(type, source, destination, columns))
        return self

    def pair_edge(self, type: str, source: str, destination: str, pairs: DataFrame) -> Graph:
        self.edges.append(Edge(type, source, destination, (), pairs))
        return self

    def resource(self, name: str) -> Resource:
        return self.resources[name]

    def frame(self, name: str) -> DataFrame:
        return self.frames[name]

    def keys(self, name: str) -> list[str]:
        r = self.resources[name]
        return [r.stored(k) for k in r.key]

    def find_edges(self, at: str, type: str, outgoing: bool, destination: str | None) -> list[tuple[Edge, str]]:
        """Edges of a type from or to a resource, with the resource at the other end."""
        out = []
        for e in self.edges:
            here, there = (e.source, e.destination) if outgoing else (e.destination, e.source)
            if e.type == type and here == at and destination in (None, there):
                out.append((e, there))
        return out

    def resource_for_label(self, label: str) -> Resource | None:
        found = [r for r in self.resources.values() if r.own_label == label]
        return found[0] if len(found) == 1 else None

    def labels_of(self, name: str, df: DataFrame | None = None) -> Column:
        """The labels of a resource's rows: their own column if the table has one."""
        df = self.frames[name] if df is None else df
        return F.col(LABELS) if LABELS in df.columns else F.array(*[F.lit(x) for x in self.resources[name].labels])

    def worlds(self, labels: Column) -> Column:
        """Of a node's labels: (domain, resource) of each domain's resource that has most labels, all of them the node's;
        in order of how many labels that are. Null labels give an empty array."""
        by_domain: dict[str, list[Resource]] = {}
        for r in self.resources.values():
            by_domain.setdefault(r.domain.name, []).append(r)
        found = []
        for domain, members in sorted(by_domain.items()):
            best = F.lit(None).cast("struct<n:int,domain:string,resource:string>")
            for r in sorted(members, key=lambda r: (len(r.labels), r.own_label)):
                hit = F.coalesce(F.size(F.array_except(F.array(*[F.lit(x) for x in r.labels]), labels)) == 0, F.lit(False))
                best = F.when(hit, F.struct(F.lit(-len(r.labels)).alias("n"), F.lit(domain).alias("domain"), F.lit(r.own_label).alias("resource"))).otherwise(best)
            found.append(best)
        ordered = F.array_sort(F.filter(F.array(*found), lambda x: x.isNotNull()))
        return F.transform(ordered, lambda x: F.struct(x["domain"].alias("domain"), x["resource"].alias("resource")))

    def sql(self, text: str, **args) -> DataFrame:
        """Spark SQL over the resources' tables, by label; values are bound, never pasted in."""
        for name, df in self.frames.items():
            df.createOrReplaceTempView(name)
        return self.spark.sql(text, args=args or None)

    def check(self, name: str) -> str:
        if name not in self.resources:
            raise UnresolvableTraversal("unresolved_reached", resource=name)
        return name
