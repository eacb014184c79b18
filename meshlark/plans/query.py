"""Queries: an immutable description, compiled to one DataFrame.

Order of work: filter, calculation sort or sort, offset, limit, then aggregates, calculations and loads of what
is left. Results have the resource's attribute names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import UnresolvableTraversal
from ..operators import aggregates, reach
from ..operators.paths import Keys, Path, known, only, paths, repeats, resolve
from ..schema import Aggregate, spark_type
from ..sources.graph import Graph
from .expr import Attr, Bool, Calc, Expr, attr, column, conjuncts, reaches

#: Orders and where their nulls go: as the largest value unless said otherwise.
ORDERS = {
    "asc": F.asc_nulls_last, "desc": F.desc_nulls_first, "asc_nulls_first": F.asc_nulls_first, "asc_nulls_last": F.asc_nulls_last,
    "desc_nulls_first": F.desc_nulls_first, "desc_nulls_last": F.desc_nulls_last,
}


def typed(c: Column, stored: T.DataType, declared: T.DataType) -> Column:
    """A stored value in the declared type; null where it does not fit. Nested values kept as text are JSON."""
    if stored == declared:
        return c
    if isinstance(stored, T.StringType) and isinstance(declared, T.StructType):
        bad = "_unfit"
        while bad in declared.fieldNames():
            bad = "_" + bad
        read = F.from_json(c, T.StructType([*declared.fields, T.StructField(bad, T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
        return F.when(read.isNotNull() & read[bad].isNull(), F.struct(*[read[f.name].alias(f.name) for f in declared.fields])).cast(declared)
    if isinstance(stored, T.StringType) and isinstance(declared, (T.ArrayType, T.MapType)):
        return F.from_json(c, declared, {"mode": "PERMISSIVE"})
    if isinstance(stored, T.StringType) and isinstance(declared, T.BinaryType):
        return F.try_to_binary(c, F.lit("base64"))
    return c.try_cast(declared)


#: Rows of a limited result whose keys are sent to every task at most.
FEW = 20_000


class _Rows:
    """What expressions see of a resource's own rows."""

    def __init__(self, graph: Graph, resource: str):
        self.graph, self.r = graph, graph.resource(resource)

    def column(self, name: str) -> Column:
        if self.r.attribute(name) is None or name in self.r.skip:
            raise UnresolvableTraversal("unmapped_property", resource=self.r.name, property=name)
        return known(self.r.attribute(name), F.col(f"`{self.r.stored(name)}`"))

    def is_ci(self, name: str) -> bool:
        a = self.r.attribute(name)
        return bool(a and a.ci)

    def calculation(self, name: str) -> Column:
        c = self.r.calculation(name)
        if c is None:
            raise UnresolvableTraversal("unmapped_property", resource=self.r.name, property=name)
        return c.build(self.column)


@dataclass(frozen=True, eq=False)
class Query:
    graph: Graph
    resource: str
    tests: tuple[Expr, ...] = ()
    order: tuple[tuple[Expr, str], ...] = ()
    skip: int = 0
    most: int | None = None
    aggs: tuple[Aggregate, ...] = ()
    calcs: tuple[str, ...] = ()
    loads: tuple[str, ...] = ()
    projections: tuple[tuple[str, tuple], ...] = ()
    computed: tuple[tuple[str, Expr], ...] = ()
    chains: tuple[tuple[str, tuple, Expr | None, int | None], ...] = ()
    typed: bool = False
    labelled: bool = False
    start: DataFrame | None = field(default=None, repr=False)

    def filter(self, *tests: Expr) -> Query:
        return replace(self, tests=(*self.tests, *tests))

    def where_stored(self, properties: dict) -> Query:
        """Rows whose attributes have these values."""
        return self.filter(*[attr(k) == v for k, v in properties.items()])

    def by_keys(self, keys: DataFrame) -> Query:
        """Rows whose key is in a DataFrame of keys (attribute names), by a semi-join."""
        r = self.graph.resource(self.resource)
        df = self._source().join(keys.select(*[F.col(k).alias(f"_by_{k}") for k in r.key]), reduce(lambda a, b: a & b, [F.col(f"`{r.stored(k)}`") == F.col(f"_by_{k}") for k in r.key]), "left_semi")
        return replace(self, start=df)

    def sort(self, *terms: str | Expr | tuple) -> Query:
        """Terms: an attribute, calc(...) or any expression, or (one of them, order). Repeated attributes count once."""
        out = list(self.order)
        for t in terms:
            e, o = t if isinstance(t, tuple) else (t, "asc")
            e = attr(e) if isinstance(e, str) else e
            if not (isinstance(e, Attr) and any(isinstance(x, Attr) and x.name == e.name for x, _ in out)):
                out.append((e, o))
        return replace(self, order=tuple(out))

    def offset(self, n: int) -> Query:
        return replace(self, skip=n)

    def limit(self, n: int) -> Query:
        return replace(self, most=n)

    def aggregate(self, *aggs: Aggregate | str) -> Query:
        own = {a.name: a for a in self.graph.resource(self.resource).aggregates}
        return replace(self, aggs=(*self.aggs, *[own[a] if isinstance(a, str) else a for a in aggs]))

    def calculate(self, *names: str, **expressions: Expr) -> Query:
        return replace(self, calcs=(*self.calcs, *names), computed=(*self.computed, *expressions.items()))

    def load(self, *relationships: str) -> Query:
        return replace(self, loads=(*self.loads, *relationships))

    def load_all(self) -> Query:
        """Loads all relationships of the resource."""
        return self.load(*[r.name for r in self.graph.resource(self.resource).relationships])

    def load_along(self, name: str, *hops: str | tuple, where: Expr | None = None, limit: int | None = None) -> Query:
        """A column of the records of the different nodes that hops lead to (relationships' names, or typed hops), many to
        many included, in order of their keys: those that meet ``where``, and the first ``limit`` of each row."""
        return replace(self, chains=(*self.chains, (name, tuple(("forward", h) if isinstance(h, str) else h for h in hops), where, limit)))

    def cast(self) -> Query:
        """Attributes in their declared types, whatever they are stored as. Nil stays nil; the names of the attributes whose
        values do not fit their types are in a further column, ``_errors``, and their values are null."""
        return replace(self, typed=True)

    def metadata(self) -> Query:
        """Each record with its node's labels, as ``_labels``."""
        return replace(self, labelled=True)

    def project(self, name: str, hops: tuple) -> Query:
        """A column of what a chain reaches, of whichever resource it turns out to be."""
        return replace(self, projections=(*self.projections, (name, hops)))

    # compilation ---------------------------------------------------------------------------------------------------

    def _source(self) -> DataFrame:
        return self.graph.frame(self.resource) if self.start is None else self.start

    def rows(self, settled: bool = False) -> DataFrame:
        """Rows after filter, sort, offset and limit, in stored columns. ``settled``: which of equal rows a limit leaves is
        decided by their keys, so that they can be asked for twice."""
        scope = _Rows(self.graph, self.resource)
        df = self._source()
        for test in [c for t in self.tests for c in conjuncts(t)]:
            chains = reaches(test)
            if not chains:
                df = df.where(column(test, scope))
            elif chains[0] is test:
                df = reach.keep(self.graph, self.resource, df, test)
            elif isinstance(test, Bool) and test.op == "not" and chains[0] is test.args[0] and chains[0].kind == "any":
                df = reach.keep(self.graph, self.resource, df, replace(chains[0], value=not chains[0].value))
            else:
                marks, names = {}, []
                for n, r in enumerate(chains):
                    name = f"_mark{n}"
                    df, marks[id(r)] = reach.mark(self.graph, self.resource, df, r, name)
                    names.append(name)
                df = df.where(column(test, scope, marks)).drop(*names)
        order = [ORDERS[o](column(e, scope)) for e, o in self.order]
        if settled and (self.skip or self.most is not None):
            order += [F.col(f"`{k}`").asc() for k in self.graph.keys(self.resource)]
        if order:
            df = df.orderBy(*order)
        if self.skip:
            df = df.offset(self.skip)
        return df if self.most is None else df.limit(self.most)

    def _attributes(self, df: DataFrame) -> list[Column]:
        r = self.graph.resource(self.resource)
        stored = {a.name: F.col(f"`{r.stored(a.name)}`") for a in r.attributes if a.name not in r.skip}
        out = []
        if self.typed:
            failed = []
            for name, c in stored.items():
                stored[name] = typed(c, df.schema[r.stored(name)].dataType, spark_type(r.attribute(name).type))
                failed.append(F.when(c.isNotNull() & stored[name].isNull(), F.lit(name)))
            out = [F.array_compact(F.array(*failed)).alias("_errors")]
        if self.labelled:
            out.append(self.graph.labels_of(self.resource, df).alias("_labels"))
        return [*[c.alias(name) for name, c in stored.items()], *out]

    def df(self) -> DataFrame:
        scope = _Rows(self.graph, self.resource)
        left = df = self.rows(settled=bool(self.aggs or self.loads or self.chains or self.projections))
        few = self.most is not None and self.most <= FEW

        def asked(cols: list[str]) -> DataFrame:
            keys = left.select(*[F.col(f"`{c}`") for c in cols])
            return F.broadcast(keys) if few else keys

        keys = asked if self.tests or self.skip or self.most is not None or self.start is not None else None
        extra: list[str] = []
        if self.aggs:
            df = aggregates.per_record(self.graph, self.resource, df, list(self.aggs), keys, few)
            extra += [a.name for a in self.aggs]
        wanted = {**{n: Calc(n) for n in self.calcs}, **dict(self.computed)}
        made = {f"_calc_{n}": column(e, scope) for n, e in wanted.items()}
        df = df.withColumns(made) if made else df
        for name in self.loads:
            df = self._loaded(df, name, keys)
            extra.append(name)
        for name, hops, where, limit in self.chains:
            df = self._along(df, name, hops, where, limit, keys)
            extra.append(name)
        for name, hops in self.projections:
            df = self._projected(df, name, hops, keys)
            extra.append(name)
        if self.order and extra:  # joins have undone it
            df = df.orderBy(*[ORDERS[o](column(e, scope)) for e, o in self.order])
        return df.select(*self._attributes(df), *[F.col(f"`{x}`") for x in extra], *[F.col(f"`_calc_{n}`").alias(n) for n in wanted])

    def total(self, *aggs: Aggregate) -> DataFrame:
        """One row of aggregates over the whole result."""
        return aggregates.total(self.graph, self.resource, self.rows(), list(aggs), _Rows(self.graph, self.resource), self.most is not None)

    def _record(self, p: Path) -> Column:
        r = self.graph.resource(p.at)
        return F.struct(*[F.col(f"`{p.load().have[r.stored(a.name)]}`").alias(a.name) for a in r.attributes if a.name not in r.skip])

    def _loaded(self, df: DataFrame, name: str, keys: Keys | None) -> DataFrame:
        """df with a relationship's record (cardinality one) or records, in order of their keys."""
        rel = self.graph.resource(self.resource).relationship(name)
        if rel is None:
            raise UnresolvableTraversal("unresolved_hop", resource=self.resource, hop=name)
        (steps,) = resolve(self.graph, self.resource, (("forward", name),))
        p = Path(self.graph, self.resource, steps)
        record = self._record(p)
        entry = [f"_l{n}" for n in range(len(p.entry))]
        rows = only(p, keys).select(*[F.col(c).alias(x) for c, x in zip(p.entry, entry, strict=True)], F.struct(F.struct(*p.key).alias("k"), record.alias("v")).alias(name))
        if rel.cardinality == "one":
            unique = steps[0].edge.columns and steps[0].outgoing  # the key names one node
            table = rows if unique else rows.groupBy(*entry).agg(F.min_by(name, F.col(name)["k"]).alias(name))
            table = table.withColumn(name, F.col(name)["v"])
        else:
            table = rows.groupBy(*entry).agg(F.transform(F.array_sort(F.collect_list(name), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)), lambda x: x["v"]).alias(name))
        df = df.join(table, reach._on(p, entry), "left").drop(*entry)
        return df if rel.cardinality == "one" else df.withColumn(name, F.coalesce(name, F.array().cast(df.schema[name].dataType)))

    def _along(self, df: DataFrame, name: str, hops: tuple, where: Expr | None, limit: int | None, keys: Keys | None) -> DataFrame:
        found = paths(self.graph, self.resource, hops)
        if len(found) > 1:
            raise UnresolvableTraversal("unresolved_reached", resource=self.resource, hops=hops)
        (p,) = found
        test = None if where is None else column(where, p)
        rows = only(p, keys) if test is None else only(p, keys).where(test)
        entry, key = [f"_a{n}" for n in range(len(p.entry))], [f"_n{n}" for n in range(len(p.key))]
        ends = [F.col(c).alias(x) for c, x in zip([*p.entry, *p.key], [*entry, *key], strict=True)]
        many = repeats(p.steps)
        # Nodes that come several times are told apart by their keys alone; their records follow.
        late = many or p.have is None
        rows = rows.select(*ends).distinct() if many else rows.select(*ends) if late else rows.select(*ends, self._record(p).alias("_v"))
        if limit is not None:
            nth = F.row_number().over(Window.partitionBy(*entry).orderBy(*key))
            rows = rows.withColumn("_nth", nth).where(F.col("_nth") <= limit).drop("_nth")
        if late:
            r = self.graph.resource(p.at)
            record = F.struct(*[F.col(f"`{r.stored(a.name)}`").alias(a.name) for a in r.attributes if a.name not in r.skip])
            own = [f"_o{n}" for n in range(len(key))]
            nodes = self.graph.frame(p.at).select(*[F.col(f"`{c}`").alias(x) for c, x in zip(self.graph.keys(p.at), own, strict=True)], record.alias("_v"))
            rows = rows.join(nodes, reduce(lambda a, b: a & b, [F.col(k) == F.col(x) for k, x in zip(key, own, strict=True)]))
        in_order = F.array_sort(F.collect_list(F.struct(F.struct(*key).alias("k"), F.col("_v").alias("v"))), lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0))
        table = rows.groupBy(*entry).agg(F.transform(in_order, lambda x: x["v"]).alias(name))
        df = df.join(table, reach._on(p, entry), "left").drop(*entry)
        return df.withColumn(name, F.coalesce(name, F.array().cast(df.schema[name].dataType)))

    def _projected(self, df: DataFrame, name: str, hops: tuple, keys: Keys | None) -> DataFrame:
        """struct<status, domain, resource, record>: of the reached node with the smallest key; record is its JSON.

        status is concrete where the node's labels have a world, unknown where not (labels are then kept in record),
        and null where nothing is reached.
        """
        tables = []
        found = [Path(self.graph, self.resource, s) for s in resolve(self.graph, self.resource, hops)]
        entry = [f"_p{n}" for n in range(len(found[0].entry))]
        for p in found:
            p.load()
            record = F.to_json(F.struct(*[F.col(c).alias(n) for n, c in p.have.items()]))
            labels = F.col(p.have["_labels"]) if "_labels" in p.have else F.array(*[F.lit(x) for x in self.graph.resource(p.at).labels])
            key = F.to_json(F.struct(*[F.col(c).alias(f"k{n}") for n, c in enumerate(p.key)]))
            tables.append(only(p, keys).select(*[F.col(c).alias(x) for c, x in zip(p.entry, entry, strict=True)], labels.alias("_labels"), record.alias("_record"), F.struct(F.lit(p.at).alias("at"), F.struct(*p.key).cast("string").alias("k"), key.alias("j")).alias("_key")))
        rows = reduce(lambda a, b: a.unionByName(b), tables).groupBy(*entry).agg(F.min_by(F.struct("_labels", "_record"), "_key").alias("_r"))
        world = F.get(self.graph.worlds(F.col("_r")["_labels"]), F.lit(0))
        value = F.struct(F.when(world.isNull(), "unknown").otherwise("concrete").alias("status"), world["domain"].alias("domain"), world["resource"].alias("resource"), F.col("_r")["_record"].alias("record"))
        rows = rows.select(*entry, value.alias(name))
        return df.join(rows, reach._on(found[0], entry), "left").drop(*entry)


def combine(*branches: tuple[str, Query], raw: bool = False) -> DataFrame:
    """(base, q), then (union | union_all | intersect | except, q) from left to right, on nodes, not on rows.

    Records come once each; ``raw`` keeps those that union_all repeats.
    """
    (kind, first), *rest = branches
    if kind != "base":
        raise ValueError("the first branch of a combination is its base")
    key = list(first.graph.resource(first.resource).key)
    out = first.df()
    for kind, q in rest:
        if q.resource != first.resource:
            raise ValueError("branches are of one resource")
        if kind in ("union", "union_all"):
            out = out.unionByName(q.df())
            if kind == "union" and raw:  # else repeats go once, at the end
                out = out.dropDuplicates(key)
        elif kind in ("intersect", "except"):
            other = q.df().select(*[F.col(k).alias(f"_c_{k}") for k in key])
            out = out.join(other, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_c_{k}") for k in key]), "left_semi" if kind == "intersect" else "left_anti")
        else:
            raise ValueError(f"no set operation {kind}")
    return out if raw else out.dropDuplicates(key)


def ordered(df: DataFrame, *terms: str | tuple[str, str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Sort, offset and limit of a combination's result."""
    df = df.orderBy(*[ORDERS[o](F.col(c)) for c, o in [t if isinstance(t, tuple) else (t, "asc") for t in terms]])
    df = df.offset(offset) if offset else df
    return df if limit is None else df.limit(limit)
