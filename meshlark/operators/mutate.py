"""Changes to a graph as functions from snapshot to snapshot.

A snapshot is a set of DataFrames, so a change is a plan: nothing is written until ``save``, which writes a new
version beside the others and then names it the current one. A transaction that fails leaves the snapshot that it
began with. Nodes have single-column keys here; edges are tables of src and dst.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import EdgeConflict, GuardViolation, MissingNode, Rollback, SaveConflict, UnresolvableTraversal, UpsertConflict
from ..functions.geo import check_writable
from ..schema import Geometry, Guard, Resource, spark_type
from ..sources import commit
from ..sources.delta import Change, Store, difference
from ..sources.graph import LABELS, Graph

EDGE = T.StructType([T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())])
EdgeName = tuple[str, str, str]  # type, source, destination
#: Edges at most that two sets of properties may stand for in ``relate``; more are given as a table to ``relate_all``.
RELATE_ROWS = 100_000


@dataclass(frozen=True, eq=False)
class Snapshot:
    spark: SparkSession
    resources: dict[str, Resource]
    nodes: dict[str, DataFrame] = field(default_factory=dict)
    edges: dict[EdgeName, DataFrame] = field(default_factory=dict)
    base: int | None = None  # the number of the saved version that this snapshot comes from
    sandbox: bool = False  # nothing is ever saved
    origin: dict[str, DataFrame] = field(default_factory=dict)  # the tables of the store that this snapshot comes from

    # reading ---------------------------------------------------------------------------------------------------------

    def key(self, name: str) -> str:
        r = self.resources[name]
        return r.stored(r.key[0])

    def node(self, name: str) -> DataFrame:
        if name in self.nodes:
            return self.nodes[name]
        r = self.resources[name]
        fields = [T.StructField(r.stored(a.name), spark_type(a.type)) for a in r.attributes if a.name not in r.skip]
        return self.spark.createDataFrame([], T.StructType([*fields, T.StructField(LABELS, T.ArrayType(T.StringType()))]))

    def edge(self, e: EdgeName) -> DataFrame:
        return self.edges.get(e) if e in self.edges else self.spark.createDataFrame([], EDGE)

    def graph(self) -> Graph:
        g = Graph(self.spark)
        for name, r in self.resources.items():
            g.add(r, self.node(name))
        for e in self.edges:
            g.pair_edge(*e, self.edges[e])
        return g

    def _with_nodes(self, name: str, df: DataFrame) -> Snapshot:
        return replace(self, nodes={**self.nodes, name: df})

    def _with_edges(self, e: EdgeName, df: DataFrame) -> Snapshot:
        return replace(self, edges={**self.edges, e: df})

    def _match(self, name: str, properties: dict) -> Column:
        test = F.lit(True)
        for k, v in properties.items():
            c = F.col(self.resources[name].stored(k))
            test = test & (c.isNull() if v is None else c == F.lit(v))
        return F.coalesce(test, F.lit(False))

    def _rows(self, name: str, rows: list[dict]) -> DataFrame:
        """New rows with defaults and labels; geometries are checked."""
        r = self.resources[name]
        out = []
        for row in rows:
            if any(row.get(k) is None for k in r.key):
                raise ValueError(f"{name} needs its key {r.key}")
            for a in r.attributes:
                if isinstance(a.type, Geometry):
                    check_writable(row.get(a.name), a.type.dimensions)
                if not a.allow_nil and row.get(a.name) is None and a.default is None:
                    raise ValueError(f"{name}.{a.name} may not be nil")
            out.append(tuple(row.get(a.name, a.default() if callable(a.default) else a.default) for a in r.attributes if a.name not in r.skip))
        schema = T.StructType([T.StructField(r.stored(a.name), spark_type(a.type)) for a in r.attributes if a.name not in r.skip])
        return self.spark.createDataFrame(out, schema).withColumn(LABELS, F.array(*[F.lit(x) for x in r.labels]))

    # nodes -----------------------------------------------------------------------------------------------------------

    def create(self, name: str, *rows: dict) -> Snapshot:
        return self.create_all(name, self._rows(name, list(rows)))

    def create_all(self, name: str, df: DataFrame) -> Snapshot:
        """Adds the rows of a DataFrame in stored columns."""
        if LABELS not in df.columns:
            df = df.withColumn(LABELS, F.array(*[F.lit(x) for x in self.resources[name].labels]))
        return self._with_nodes(name, self.node(name).unionByName(df, allowMissingColumns=True) if name in self.nodes else df)

    def merge(self, name: str, *rows: dict) -> Snapshot:
        """Adds the rows that no node matches in all their given properties."""
        out = self
        for row in rows:
            new = out._rows(name, [row])
            there = out.node(name).where(out._match(name, row)).limit(1).select(F.lit(True).alias("_there"))
            out = out.create_all(name, new.join(there, F.lit(True), "left_anti"))
        return out

    def update(self, name: str, match: dict, set: dict | None = None, remove: tuple[str, ...] = ()) -> Snapshot:
        """Sets properties of the matching nodes; those removed, or set to nil, become null."""
        df, r, hit = self.node(name), self.resources[name], self._match(name, match)
        for a in r.attributes:
            if isinstance(a.type, Geometry):
                check_writable((set or {}).get(a.name), a.type.dimensions)
        values = {**dict.fromkeys(remove), **(set or {})}
        kinds = {f.name: f.dataType for f in df.schema.fields}
        cols = {r.stored(k): F.when(hit, F.lit(v).cast(kinds[r.stored(k)])).otherwise(F.col(r.stored(k))) for k, v in values.items()}
        return self._with_nodes(name, df.withColumns(cols) if cols else df)

    def update_all(self, name: str, changes: DataFrame, clear: tuple[str, ...] = ()) -> Snapshot:
        """Bulk update by key: columns of changes (stored names) replace the nodes' values; a null leaves the value as it is,
        but for the columns of ``clear``, where it takes it away. UpsertConflict where a key has several changes; those of
        no node, or without a key, change nothing."""
        key = self.key(name)
        if missing := [x for x in clear if x not in changes.columns]:
            raise ValueError(f"changes have no {missing}")
        several = changes.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).collect()
        if several:
            raise UpsertConflict(f"{several[0]['_n']} changes of {name} have the key {several[0][key]}")
        new = [c for c in changes.columns if c != key]
        c = changes.select(F.col(key).alias("_key"), F.lit(True).alias("_there"), *[F.col(x).alias(f"_new_{x}") for x in new])
        df = self.node(name).join(c, F.col(key) == F.col("_key"), "left")
        values = {x: F.when(F.col("_there"), F.col(f"_new_{x}")).otherwise(F.col(x)) if x in clear else F.coalesce(f"_new_{x}", x) for x in new}
        return self._with_nodes(name, df.withColumns(values).drop("_key", "_there", *[f"_new_{x}" for x in new]))

    def update_labels(self, name: str, match: dict, add: tuple[str, ...] = (), remove: tuple[str, ...] = ()) -> Snapshot:
        labels = F.array_except(F.array_union(F.col(LABELS), F.array(*[F.lit(x) for x in add]).cast("array<string>")), F.array(*[F.lit(x) for x in remove]).cast("array<string>"))
        return self._with_nodes(name, self.node(name).withColumn(LABELS, F.when(self._match(name, match), labels).otherwise(F.col(LABELS))))

    def upsert(self, name: str, row: dict, keys: tuple[str, ...] | None = None) -> Snapshot:
        """Updates the one node with the row's identity, or creates it; several are an error."""
        r = self.resources[name]
        keys = keys or (r.identities[0] if r.identities else r.key)
        identity = {k: row.get(k) for k in keys}
        if any(v is None for v in identity.values()):
            return self.create(name, row)
        n = self.node(name).where(self._match(name, identity)).limit(2).count()
        if n > 1:
            raise UpsertConflict(f"several {name} have {identity}")
        changed = {k: v for k, v in row.items() if k not in keys and (r.upsert_fields is None or k in r.upsert_fields)}
        return self.update(name, identity, changed) if n else self.create(name, row)

    def upsert_all(self, name: str, df: DataFrame, keys: tuple[str, ...]) -> Snapshot:
        """Bulk upsert of rows (stored names): one outer join on the identity. A matching node takes all of the row's
        columns, nulls included; rows without an identity are created. UpsertConflict where an identity has several rows
        or several nodes."""
        old, ids = self.node(name), [self.resources[name].stored(k) for k in keys]
        known = df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ids]))
        held = old.join(known.select(*[F.col(c).alias(f"_new_{c}") for c in ids]), reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_new_{c}") for c in ids]), "left_semi")
        for rows, what in ((known, "rows"), (held, "nodes")):
            several = rows.groupBy(*ids).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).collect()
            if several:
                raise UpsertConflict(f"several {what} of {name} have {several[0].asDict()}")
        new = df.select(F.lit(True).alias("_there"), *[F.col(c).alias(f"_new_{c}") for c in df.columns])
        joined = old.join(new, [F.col(c) == F.col(f"_new_{c}") for c in ids], "full")
        labels = F.coalesce(F.col(LABELS), F.array(*[F.lit(x) for x in self.resources[name].labels])).alias(LABELS)
        cols = [F.when(F.col("_there"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in df.columns else labels if c == LABELS else F.col(c) for c in old.columns]
        return self._with_nodes(name, joined.select(*cols))

    def delete(self, name: str, match: dict) -> Snapshot:
        """Deletes the matching nodes with all their edges."""
        hit = self._match(name, match)
        return self._drop(name, self.node(name).where(hit).select(F.col(self.key(name)).cast("string").alias("_gone")))

    def _drop(self, name: str, gone: DataFrame) -> Snapshot:
        df = self.node(name)
        out = self._with_nodes(name, df.join(gone, F.col(self.key(name)).cast("string") == F.col("_gone"), "left_anti"))
        for e in self.edges:
            for end, at in ((e[1], "src"), (e[2], "dst")):
                if end == name:
                    out = out._with_edges(e, out.edge(e).join(gone, F.col(at) == F.col("_gone"), "left_anti"))
        return out

    def _guarded(self, name: str, guard: Guard) -> list[tuple[EdgeName, str]]:
        ways = {"out": [("src", 1, 2)], "in": [("dst", 2, 1)], "any": [("src", 1, 2), ("dst", 2, 1)]}[guard.direction]
        return [(e, at) for e in self.edges for at, here, there in ways if e[0] == guard.edge and e[here] == name and e[there] == guard.destination]

    def unguarded(self, name: str, match: dict) -> DataFrame:
        """Of the matching nodes those that no guard protects."""
        df = self.node(name).where(self._match(name, match))
        for g in self.resources[name].all_guards(tuple(self.resources.values())):
            for e, at in self._guarded(name, g):
                df = df.join(self.edge(e).select(F.col(at).alias("_held")), F.col(self.key(name)).cast("string") == F.col("_held"), "left_anti")
        return df

    def delete_guarded(self, name: str, match: dict) -> Snapshot:
        """Deletes the matching nodes that have no guarded edges; if that is none, GuardViolation."""
        gone = self.unguarded(name, match)
        if gone.isEmpty():
            raise GuardViolation(f"no {name} with {match} may be deleted")
        return self._drop(name, gone.select(F.col(self.key(name)).cast("string").alias("_gone")))

    def delete_all(self) -> Snapshot:
        return replace(self, nodes={n: df.limit(0) for n, df in self.nodes.items()}, edges={e: df.limit(0) for e, df in self.edges.items()})

    # edges -----------------------------------------------------------------------------------------------------------

    def keys_of(self, name: str, match: dict) -> DataFrame:
        return self.node(name).where(self._match(name, match)).select(F.col(self.key(name)).cast("string").alias("k"))

    def relate(self, e: EdgeName, source: dict, destination: dict, source_exclusive: bool = False, destination_exclusive: bool = False) -> Snapshot:
        """An edge between each two matching nodes, once. An exclusive source first loses its other edges of the type, an
        exclusive destination those from other sources. Properties that stand for over RELATE_ROWS edges are an error:
        these are given to ``relate_all``."""
        here, there = self.keys_of(e[1], source).withColumnRenamed("k", "src"), self.keys_of(e[2], destination).withColumnRenamed("k", "dst")
        n, m = (df.limit(RELATE_ROWS + 1).count() for df in (here, there))
        if not n * m:
            raise MissingNode(f"{e}: {source} or {destination} does not exist")
        if n * m > RELATE_ROWS:
            raise ValueError(f"{source} and {destination} stand for over {RELATE_ROWS} edges; give these to relate_all")
        return self.relate_all(e, F.broadcast(here).crossJoin(there), source_exclusive, destination_exclusive)  # both sides counted above

    def relate_all(self, e: EdgeName, pairs: DataFrame, source_exclusive: bool = False, destination_exclusive: bool = False) -> Snapshot:
        """Edges from a DataFrame of src and dst. EdgeConflict where they give an exclusive end several."""
        pairs = pairs.select(F.col("src").cast("string"), F.col("dst").cast("string")).distinct()
        df = self.edge(e)
        for exclusive, at in ((source_exclusive, "src"), (destination_exclusive, "dst")):
            if exclusive:
                several = pairs.groupBy(at).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).collect()
                if several:
                    raise EdgeConflict(f"{e}: {at} {several[0][0]} is exclusive and would have {several[0][1]} edges")
                df = df.join(pairs.select(F.col(at).alias("_at")), F.col(at) == F.col("_at"), "left_anti")
        return self._with_edges(e, df.unionByName(pairs).dropDuplicates(["src", "dst"]))

    def relate_each(self, changes: list[tuple[EdgeName, dict, dict]]) -> Snapshot:
        """Several edges; the first that fails fails all."""
        if not changes:
            raise ValueError("no edges are given")
        out = self
        for e, source, destination in changes:
            rel = next((r for r in self.resources[e[1]].relationships if r.type == e[0] and r.destination == e[2]), None)
            s = bool(rel and self.resources[e[1]].source_exclusive(rel))
            d = bool(rel and self.resources[e[1]].destination_exclusive(rel, self.resources[e[2]]))
            out = out.relate(e, source, destination, s, d)
        return out

    def unrelate(self, e: EdgeName, source: dict, destination: dict | None = None) -> Snapshot:
        df, here = self.edge(e), self.keys_of(e[1], source)
        if destination is None:
            return self._with_edges(e, df.join(here, F.col("src") == F.col("k"), "left_anti"))
        there = self.keys_of(e[2], destination).withColumnRenamed("k", "k2")
        gone = df.join(here, F.col("src") == F.col("k"), "left_semi").join(there, F.col("dst") == F.col("k2"), "left_semi")
        return self._with_edges(e, df.join(gone.withColumnsRenamed({"src": "_s", "dst": "_d"}), (F.col("src") == F.col("_s")) & (F.col("dst") == F.col("_d")), "left_anti"))

    def replace_edges(self, e: EdgeName, source: dict, destinations: list[dict]) -> Snapshot:
        """The source's edges of the type become exactly those to the destinations."""
        out = self.unrelate(e, source)
        for d in destinations:
            out = out.relate(e, source, d)
        return out

    def related(self, e: EdgeName, source: dict, destination: dict) -> bool:
        here, there = self.keys_of(e[1], source), self.keys_of(e[2], destination).withColumnRenamed("k", "k2")
        return not self.edge(e).join(here, F.col("src") == F.col("k"), "left_semi").join(there, F.col("dst") == F.col("k2"), "left_semi").isEmpty()

    def manage(self, name: str, match: dict, relationship: str, how: str, others: list[dict]) -> Snapshot:
        """Changes what the matching nodes are related to, from whichever end the relationship is declared.

        how: append adds edges to the nodes that ``others`` name; remove takes those away; append_and_remove also takes
        away all edges to nodes that are not named. Ends that the declarations say have one edge are exclusive, and an
        attribute that holds the destination's key follows the edge.
        """
        if how not in ("append", "remove", "append_and_remove"):
            raise ValueError(f"no way to manage a relationship: {how}")
        r = self.resources[name]
        rel = r.relationship(relationship)
        if rel is None:
            raise UnresolvableTraversal("unresolved_hop", resource=name, hop=relationship)
        own, far = r.source_exclusive(rel), r.destination_exclusive(rel, self.resources[rel.destination])
        outgoing = rel.direction == "out"
        e = (rel.type, name, rel.destination) if outgoing else (rel.type, rel.destination, name)
        near_end, far_end = ("src", "dst") if outgoing else ("dst", "src")
        out = self
        if how == "append_and_remove":
            here = self.keys_of(name, match)
            kept = reduce(DataFrame.unionByName, [self.keys_of(rel.destination, o) for o in others], self.keys_of(rel.destination, {}).limit(0)).withColumnRenamed("k", "_kept")
            gone = self.edge(e).join(here, F.col(near_end) == F.col("k"), "left_semi").join(kept, F.col(far_end) == F.col("_kept"), "left_anti").withColumnsRenamed({"src": "_s", "dst": "_d"})
            out = out._with_edges(e, self.edge(e).join(gone, (F.col("src") == F.col("_s")) & (F.col("dst") == F.col("_d")), "left_anti"))
        for o in others:
            ends = (match, o) if outgoing else (o, match)
            exclusive = (own, far) if outgoing else (far, own)
            out = out.unrelate(e, *ends) if how == "remove" else out.relate(e, *ends, *exclusive)
        if not rel.attribute:
            return out
        column, key = r.stored(rel.attribute), self.key(name)
        held = out.edge(e).groupBy(F.col(near_end).alias("_held")).agg(F.min(far_end).alias("_far"))
        df = out.node(name)
        kind = df.schema[column].dataType
        df = df.join(held, F.col(key).cast("string") == F.col("_held"), "left")
        return out._with_nodes(name, df.withColumn(column, F.when(self._match(name, match), F.col("_far").cast(kind)).otherwise(F.col(column))).drop("_held", "_far"))

    # transactions and storage ------------------------------------------------------------------------------------------

    def transaction(self, change: Callable[[Snapshot], Snapshot], run: bool = True) -> tuple[Snapshot, Exception | None]:
        """The changed snapshot; or this one and the error that ended the change.

        The tables that the change made are written once, in the shared folder, so that errors which only the data show
        also end it, and the changed snapshot reads what was written; ``run`` false leaves that to whoever reads them. Transactions may be nested: one that fails within another gives the
        snapshot that it began with, and the other goes on. ``rollback`` ends one on purpose.
        """
        try:
            out = change(self)
            if run:
                put = lambda new, old: {k: df if df is old.get(k) else commit.written(df, "transaction") for k, df in new.items()}
                out = replace(out, nodes=put(out.nodes, self.nodes), edges=put(out.edges, self.edges))
            return out, None
        except Exception as error:
            return self, error

    def sandboxed(self) -> Snapshot:
        """This snapshot for tests: whatever is made of it, ``save`` writes nothing."""
        return replace(self, sandbox=True)

    def save(self, path: str) -> str | None:
        """Writes a version and then makes it the current one; returns the version's name, or None in a sandbox.

        Versions have numbers, and a number is made once: of two writers that go out from the same version the second
        gets SaveConflict, and what it wrote is removed. A snapshot that was not opened follows the version that is
        current when saving begins.
        """
        if self.sandbox:
            return None
        base = Snapshot._current(self.spark, path)[0] if self.base is None else self.base
        version = uuid.uuid4().hex
        for name, df in self.nodes.items():
            df.write.parquet(f"{path}/{version}/nodes/{name}")
        for e, df in self.edges.items():
            df.write.parquet(f"{path}/{version}/edges/{'-'.join(e)}")
        if not commit.create_once(self.spark, f"{path}/current-{base + 1:010d}", version.encode()):
            commit.delete(self.spark, f"{path}/{version}")
            raise SaveConflict(f"version {base + 1} of {path} exists")
        return version

    def _tables(self) -> dict[str, tuple[tuple[str, ...], DataFrame]]:
        """Key and rows of each table, under its name in a store."""
        nodes = {f"nodes/{n}": ((self.key(n),), df) for n, df in self.nodes.items()}
        return nodes | {f"edges/{'-'.join(e)}": (("src", "dst"), df) for e, df in self.edges.items()}

    def save_changes(self, store: Store) -> int | None:
        """Writes what the snapshot's tables have and those of its version in the store have not, and the keys that they no
        longer have, as the version after it; returns that one's number, or None in a sandbox. Tables that no change has
        touched are neither read nor written. SaveConflict if others have saved since; nothing to save makes no version."""
        if self.sandbox:
            return None
        changes = {}
        for name, (key, df) in self._tables().items():
            old = self.origin.get(name)
            if old is None:
                changes[name] = Change(key, df)
            elif df is not old:
                changes[name] = difference(key, old, df)
        return store.commit(changes, self.base) if changes else self.base or store.version()

    @staticmethod
    def open_store(store: Store, resources: dict[str, Resource], version: int | None = None) -> Snapshot:
        """A store's latest version, or an older one, whose changes then conflict with those that followed it."""
        m = store.manifest(version)
        origin = {name: store.read(name, m["version"]) for name in m["tables"]}
        nodes = {n[6:]: df for n, df in origin.items() if n.startswith("nodes/")}
        edges = {tuple(n[6:].split("-")): df for n, df in origin.items() if n.startswith("edges/")}
        return Snapshot(store.spark, resources, nodes, edges, m["version"], origin=origin)

    @staticmethod
    def _current(spark: SparkSession, path: str) -> tuple[int, str | None]:
        found = [n for n in commit.names(spark, path) if n.startswith("current-")]
        return (int(found[-1][8:]), commit.read(spark, f"{path}/{found[-1]}").decode()) if found else (0, None)

    @staticmethod
    def open(spark: SparkSession, path: str, resources: dict[str, Resource], version: str | None = None) -> Snapshot:
        """The current version, or one by its name; what is saved from it follows the version that is current now."""
        base, current = Snapshot._current(spark, path)
        version = version or current
        if version is None:
            raise FileNotFoundError(f"{path} has no version")
        nodes = {n: spark.read.parquet(f"{path}/{version}/nodes/{n}") for n in commit.names(spark, f"{path}/{version}/nodes")}
        edges = {tuple(n.split("-")): spark.read.parquet(f"{path}/{version}/edges/{n}") for n in commit.names(spark, f"{path}/{version}/edges")}
        return Snapshot(spark, resources, nodes, edges, base)


def rollback(reason: object = None) -> None:
    """Ends the transaction in which it is called; the reason is in the error that this gives back."""
    raise Rollback(reason)
