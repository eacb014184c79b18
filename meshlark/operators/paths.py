"""Chains of hops as joins.

A path never uses an edge twice. Foreign keys make hops cheap: towards the key's owner a hop is one join, away
from it none, until something of the reached node is asked for. A chain that begins with a foreign key of the
source starts at the node which that key names, so the source's table is not read again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import UnresolvableTraversal
from ..functions import naming
from ..functions.geo import of_kind
from ..schema import Attribute, Geometry
from ..sources.graph import Edge, Graph


@dataclass(frozen=True)
class Step:
    edge: Edge
    outgoing: bool
    destination: str


def known(a: Attribute, c: Column) -> Column:
    """The column of an attribute; of a geometry that may only be points, marked as such."""
    return of_kind(c, "Point") if isinstance(a.type, Geometry) and a.type.kinds == ("Point",) else c


def resolve(graph: Graph, resource: str, hops: tuple) -> list[list[Step]]:
    """The typed chains of a chain of hops: several where an edge type leads to several resources."""
    if not hops:
        raise UnresolvableTraversal("empty_chain", resource=resource)
    chains: list[tuple[str, list[Step]]] = [(resource, [])]
    for direction, selector in hops:
        grown = []
        for at, steps in chains:
            if isinstance(selector, str):
                rel = graph.resource(at).relationship(selector)
                if rel is None:
                    raise UnresolvableTraversal("unresolved_hop", resource=at, hop=selector)
                way = rel.direction if direction == "forward" else naming.reverse(rel.direction)
                found = graph.find_edges(at, rel.type, way == "out", rel.destination if direction == "forward" else None)
            else:
                type, *to = selector
                way = "out" if direction == "forward" else "in"
                if to and graph.resource_for_label(to[0]) is None:
                    raise UnresolvableTraversal("unresolved_reached", destination=to[0])
                found = graph.find_edges(at, type, way == "out", to[0] if to else None)
            grown += [(there, [*steps, Step(e, way == "out", there)]) for e, there in found]
        if not grown:
            raise UnresolvableTraversal("unresolved_hop", resource=chains[0][0], hop=selector)
        chains = grown
    return [steps for _, steps in chains]


def match(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in zip(left, right, strict=True)])


class Path:
    """``frame`` has a row for each path; ``entry`` are its columns that match ``join`` of the source's table."""

    def __init__(self, graph: Graph, resource: str, steps: list[Step]):
        self.graph, self.steps = graph, steps
        self.uses: list[tuple[Edge, list[str]]] = []
        self.n = 0
        first = steps[0]
        again = any(s.edge is first.edge for s in steps[1:])
        e = first.edge
        if e.columns and first.outgoing and not again:
            self.at, self.join = first.destination, list(e.columns)
            self._open(first.destination)
            self.entry = list(self.key)
            rest = steps[1:]
        elif e.columns and not first.outgoing:
            self.at, self.join = first.destination, graph.keys(resource)
            self._open(first.destination)
            self.entry = [self.have[c] for c in e.columns]
            self._use(e)
            self.frame = self.frame.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in self.entry]))
            rest = steps[1:]
        else:
            self.at, self.join = resource, graph.keys(resource)
            if e.pairs is None:
                self._open(resource)
                self.entry = list(self.key)
            else:
                self.n += 1
                names = {c: f"e{self.n}_{c}" for c in e.pairs.columns}
                self.frame, self.have = e.pairs.select(*[F.col(c).alias(x) for c, x in names.items()]), None
                here, there = ("src", "dst") if first.outgoing else ("dst", "src")
                self.entry, self.key, self.at = [names[here]], [names[there]], first.destination
                self.uses.append((e, list(names.values())))
            rest = steps if e.pairs is None else steps[1:]
        for s in rest:
            self._hop(s)

    def _rows(self, name: str) -> tuple[DataFrame, dict[str, str]]:
        self.n += 1
        df = self.graph.frame(name)
        names = {c: f"n{self.n}_{c}" for c in df.columns}
        return df.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()]), names

    def _open(self, name: str) -> None:
        self.frame, self.have = self._rows(name)
        self.key = [self.have[k] for k in self.graph.keys(name)]

    def _use(self, edge: Edge) -> None:
        """Marks the edge that the current node owns as used: it must differ from others of the chain."""
        self._distinct(edge, [self.have[k] for k in self.graph.keys(edge.source)])

    def _distinct(self, edge: Edge, id: list[str]) -> None:
        for other, used in self.uses:
            if other is edge:
                same = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in zip(id, used, strict=True)])
                self.frame = self.frame.where(~same)
        self.uses.append((edge, id))

    def load(self) -> Path:
        """Joins the reached node's row, if only its key is known."""
        if self.have is None:
            rows, names = self._rows(self.at)
            self.frame = self.frame.join(rows, match(self.key, [names[k] for k in self.graph.keys(self.at)]))
            self.have = names
        return self

    def _hop(self, s: Step) -> None:
        e = s.edge
        if e.columns and s.outgoing:
            self.load()
            self._use(e)
            key = [self.have[c] for c in e.columns]
            self.frame = self.frame.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]))
            self.key, self.have = key, None
        elif e.columns:
            rows, names = self._rows(s.destination)
            self.frame = self.frame.join(rows, match(self.key, [names[c] for c in e.columns]))
            self.have, self.key = names, [names[k] for k in self.graph.keys(s.destination)]
            self._use(e)
        else:
            self.n += 1
            names = {c: f"e{self.n}_{c}" for c in e.pairs.columns}
            here, there = ("src", "dst") if s.outgoing else ("dst", "src")
            self.frame = self.frame.join(e.pairs.select(*[F.col(c).alias(x) for c, x in names.items()]), match(self.key, [names[here]]))
            self._distinct(e, list(names.values()))
            self.key, self.have = [names[there]], None
        self.at = s.destination

    # what expressions see of the reached node
    def column(self, name: str) -> Column:
        r = self.graph.resource(self.at)
        if r.attribute(name) is None or r.stored(name) not in self.load().have:
            raise UnresolvableTraversal("unmapped_property", resource=self.at, property=name)
        return known(r.attribute(name), F.col(f"`{self.have[r.stored(name)]}`").alias(name))

    def is_ci(self, name: str) -> bool:
        a = self.graph.resource(self.at).attribute(name)
        return bool(a and a.ci)

    def calculation(self, name: str) -> Column:
        c = self.graph.resource(self.at).calculation(name)
        if c is None:
            raise UnresolvableTraversal("unmapped_property", resource=self.at, property=name)
        return c.build(self.column)


def paths(graph: Graph, resource: str, hops: tuple) -> list[Path]:
    return [Path(graph, resource, steps) for steps in resolve(graph, resource, hops)]


#: For columns of a resource's table, their values in the rows that count.
Keys = Callable[[list[str]], DataFrame]


def only(p: Path, keys: Keys | None, frame: DataFrame | None = None) -> DataFrame:
    """The path's rows, or those of ``frame``, that begin at the sources that count; all without keys."""
    frame = p.frame if frame is None else frame
    if keys is None:
        return frame
    wanted = [f"_w{n}" for n in range(len(p.join))]
    return frame.join(keys(p.join).toDF(*wanted), match(p.entry, wanted), "left_semi")


def repeats(steps: list[Step]) -> bool:
    """Whether several paths of the chain may lead from a source to the same node: not if it goes to owners of keys first
    and then only to what holds a key."""
    down = False
    for s in steps:
        if s.edge.pairs is not None or s.outgoing and down:
            return True
        down = down or not s.outgoing
    return False
