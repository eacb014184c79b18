"""Resources: typed node labels with relationships, guards, aggregates and calculations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import types as T

from .functions import naming

#: Spark types of attribute types. Times are microseconds of the day; durations months, days and microseconds.
DURATION = T.StructType([T.StructField("months", T.IntegerType()), T.StructField("days", T.IntegerType()), T.StructField("micros", T.LongType())])
TYPES: dict[str, T.DataType] = {
    "boolean": T.BooleanType(), "integer": T.LongType(), "float": T.DoubleType(), "string": T.StringType(), "date": T.DateType(),
    "time": T.LongType(), "naive_datetime": T.TimestampNTZType(), "datetime": T.TimestampType(), "duration": DURATION,
    "atom": T.StringType(), "module": T.StringType(), "ci_string": T.StringType(), "decimal": T.DecimalType(38, 18), "function": T.StringType(),
    "binary": T.BinaryType(), "uuid": T.StringType(), "map": T.MapType(T.StringType(), T.StringType()), "variant": T.VariantType(),
}
UNSUPPORTED = ("file", "term")
TENSOR_ELEMENTS = ("s8", "s16", "s32", "s64", "u8", "u16", "u32", "u64", "f16", "f32", "f64", "bf16")


@dataclass(frozen=True)
class Array:
    of: object


@dataclass(frozen=True)
class Struct:
    fields: tuple[tuple[str, object], ...]


@dataclass(frozen=True)
class Union:
    """A tagged value: its member's name and its JSON."""

    members: tuple[tuple[str, object], ...]


@dataclass(frozen=True)
class VectorOf:
    dimensions: int
    element: str = "f32"


@dataclass(frozen=True)
class TensorOf:
    shape: tuple[int, ...]
    element: str = "f32"
    packed: bool = False


@dataclass(frozen=True)
class Geometry:
    """kinds: names that are allowed; none allows any. dimensions: 2 or 3 (points only)."""

    kinds: tuple[str, ...] = ()
    dimensions: int = 2


def spark_type(kind: object) -> T.DataType:
    """The Spark type of an attribute type; ValueError for one that is not supported, at any depth."""
    if isinstance(kind, T.DataType):
        return kind
    if isinstance(kind, str):
        if kind in TYPES:
            return TYPES[kind]
        raise ValueError(f"attribute type {kind} is not supported")
    if isinstance(kind, Array):
        return T.ArrayType(spark_type(kind.of))
    if isinstance(kind, Struct):
        return T.StructType([T.StructField(n, spark_type(t)) for n, t in kind.fields])
    if isinstance(kind, Union):
        for _, t in kind.members:
            spark_type(t)
        return T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType())])
    if isinstance(kind, VectorOf):
        return T.ArrayType({"f32": T.FloatType(), "f64": T.DoubleType()}[kind.element])
    if isinstance(kind, TensorOf):
        if kind.element not in TENSOR_ELEMENTS or not 1 <= len(kind.shape) <= 3:
            raise ValueError(f"tensors have one to three dimensions of {TENSOR_ELEMENTS}")
        return T.BinaryType() if kind.packed else T.ArrayType(T.LongType() if kind.element[0] in "su" else T.DoubleType())
    if isinstance(kind, Geometry):
        from .functions.geo import GEOMETRY

        return GEOMETRY
    raise ValueError(f"attribute type {kind!r} is not supported")


@dataclass(frozen=True)
class Attribute:
    name: str
    type: object = "string"
    source: str | None = None  # the stored column; by default the name in camel case
    allow_nil: bool = True
    default: object = None

    @property
    def ci(self) -> bool:
        return self.type == "ci_string"


@dataclass(frozen=True)
class Relationship:
    """cardinality: one or many. attribute: of a belongs_to, the attribute that holds the destination's key."""

    name: str
    destination: str
    cardinality: str = "many"
    edge: str | None = None
    direction: str = "out"
    attribute: str | None = None
    allow_nil: bool = True

    @property
    def type(self) -> str:
        return self.edge or naming.macro(self.name)


@dataclass(frozen=True)
class Guard:
    edge: str
    direction: str
    destination: str


@dataclass(frozen=True)
class Mergeable:
    """A kind of aggregate of one's own: ``step`` aggregates values, ``merge`` aggregates what ``step`` or ``merge`` gave, and
    ``finish`` makes the result of it. The first two are aggregate functions that Spark can start on the map side; nulls
    are skipped, and a source that reaches nothing has null."""

    step: Callable[[Column], Column]
    merge: Callable[[Column], Column]
    finish: Callable[[Column], Column] = lambda c: c


@dataclass(frozen=True)
class Aggregate:
    name: str
    kind: str | Mergeable
    path: tuple[str, ...] = ()
    field: str | None = None
    filter: object = None
    expr: object = None
    uniq: bool = False


@dataclass(frozen=True)
class Calculation:
    name: str
    build: Callable[..., Column] = field(compare=False)  # from a function that gives an attribute's Column


@dataclass(frozen=True)
class Domain:
    name: str
    label: str | None = None
    fragment: str | None = None


@dataclass(frozen=True)
class Resource:
    name: str
    attributes: tuple[Attribute, ...]
    key: tuple[str, ...] = ("id",)
    relationships: tuple[Relationship, ...] = ()
    guards: tuple[Guard, ...] = ()
    aggregates: tuple[Aggregate, ...] = ()
    calculations: tuple[Calculation, ...] = ()
    domain: Domain = Domain("Default")
    label: str | None = None
    identities: tuple[tuple[str, ...], ...] = ()
    skip: tuple[str, ...] = ()
    upsert_fields: tuple[str, ...] | None = None

    def attribute(self, name: str) -> Attribute | None:
        return next((a for a in self.attributes if a.name == name), None)

    def relationship(self, name: str) -> Relationship | None:
        return next((r for r in self.relationships if r.name == name), None)

    def calculation(self, name: str) -> Calculation | None:
        return next((c for c in self.calculations if c.name == name), None)

    def stored(self, name: str) -> str:
        """The column that an attribute is stored in; unknown names are kept."""
        a = self.attribute(name)
        if a is None:
            return name
        return a.source or ("uuid" if name == "id" else naming.camel(name))

    def stored_map(self, values: dict) -> dict:
        return {self.stored(k): v for k, v in values.items()}

    @property
    def own_label(self) -> str:
        return naming.short_name(self.name)

    @property
    def labels(self) -> tuple[str, ...]:
        """Domain, resource, and further labels, each once."""
        d = self.domain.label or naming.short_name(self.domain.name)
        return tuple(dict.fromkeys(x for x in (d, self.own_label, self.label, self.domain.fragment) if x))

    @property
    def label_pair(self) -> tuple[str, str]:
        return self.labels[0], self.own_label

    def source_exclusive(self, rel: Relationship) -> bool:
        """Whether a node has at most one such edge."""
        return rel.cardinality == "one"

    def destination_exclusive(self, rel: Relationship, destination: Resource) -> bool:
        """Whether the node at the other end has at most one: its relationship back is of cardinality one."""
        back = [r for r in destination.relationships if r.type == rel.type and r.destination == self.own_label and r.direction == naming.reverse(rel.direction)]
        return any(r.cardinality == "one" for r in back)

    def all_guards(self, others: tuple[Resource, ...] = ()) -> tuple[Guard, ...]:
        """Own guards, and those implied by what may not be without this resource."""
        implied = [Guard(r.type, naming.reverse(r.direction), o.own_label) for o in others for r in o.relationships if r.destination == self.own_label and r.cardinality == "one" and not r.allow_nil]
        return tuple(dict.fromkeys([*self.guards, *implied]))

    def validate(self) -> Resource:
        """Itself; ValueError says what is wrong with the declaration."""

        def check(ok: bool, what: str) -> None:
            if not ok:
                raise ValueError(f"{self.name}: {what}")

        for label in self.labels:
            check(naming.is_pascal(label), f"label {label} is not in Pascal case")
        for a in self.attributes:
            if a.name not in self.skip:
                check(naming.is_camel(self.stored(a.name)) or a.source is not None and "_" in a.source, f"property {self.stored(a.name)} is not in camel case")
            check(a.type not in UNSUPPORTED, f"attribute type {a.type} is not supported")
            spark_type(a.type)
        for k in self.key:
            check(self.attribute(k) is not None, f"key {k} is no attribute")
        seen = set()
        for r in self.relationships:
            check(naming.is_macro(r.type), f"edge {r.type} is not in macro case")
            check(r.direction in ("in", "out"), f"direction {r.direction} of {r.name} is neither in nor out")
            check(naming.is_pascal(r.destination), f"destination {r.destination} is not in Pascal case")
            check(r.cardinality in ("one", "many"), f"cardinality {r.cardinality} of {r.name}")
            triple = (r.type, r.direction, r.destination)
            check(triple not in seen, f"edge {triple} has two relationships")
            seen.add(triple)
        for g in self.guards:
            check(naming.is_macro(g.edge) and g.direction in ("in", "out", "any") and naming.is_pascal(g.destination), f"guard {g}")
        for s in self.skip:
            check(self.attribute(s) is not None, f"skipped {s} is no attribute")
        return self
