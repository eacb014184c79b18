"""Expressions over a resource's attributes, and predicates over what a chain of hops reaches."""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F


class Scope(Protocol):
    """Where names are looked up."""

    def column(self, name: str) -> Column: ...

    def is_ci(self, name: str) -> bool: ...

    def calculation(self, name: str) -> Column: ...


class Expr:
    def __eq__(self, other):  # type: ignore[override]
        return Compare("==", self, wrap(other))

    def __ne__(self, other):  # type: ignore[override]
        return Compare("!=", self, wrap(other))

    def __lt__(self, other):
        return Compare("<", self, wrap(other))

    def __le__(self, other):
        return Compare("<=", self, wrap(other))

    def __gt__(self, other):
        return Compare(">", self, wrap(other))

    def __ge__(self, other):
        return Compare(">=", self, wrap(other))

    __hash__ = object.__hash__

    def __and__(self, other):
        return Bool("and", (self, wrap(other)))

    def __or__(self, other):
        return Bool("or", (self, wrap(other)))

    def __invert__(self):
        return Bool("not", (self,))

    def __add__(self, other):
        return func(operator.add, self, other)

    def __sub__(self, other):
        return func(operator.sub, self, other)

    def __mul__(self, other):
        return func(operator.mul, self, other)

    def __rsub__(self, other):
        return func(operator.sub, wrap(other), self)

    __radd__, __rmul__ = __add__, __mul__

    def __truediv__(self, other):
        return func(operator.truediv, self, other)

    def isin(self, values) -> In:
        return In(self, tuple(sorted(values, key=repr)) if isinstance(values, (set, frozenset)) else tuple(values))

    def is_nil(self, yes: bool = True) -> Expr:
        return func(lambda c: c.isNull() if yes else c.isNotNull(), self)

    def contains(self, part: str | Ci) -> Expr:
        return Contains(self, wrap(part))

    def get_path(self, *names: str) -> Expr:
        def walk(c: Column) -> Column:
            for n in names:
                c = c.getField(n)
            return c

        return func(walk, self)

    def concat(self, *others) -> Expr:
        return func(lambda *c: F.concat(*c), self, *others)

    def cast(self, kind: str) -> Expr:
        return func(lambda c: c.cast(kind), self)


@dataclass(frozen=True, eq=False)
class Attr(Expr):
    name: str


@dataclass(frozen=True, eq=False)
class Calc(Expr):
    name: str


@dataclass(frozen=True, eq=False)
class Lit(Expr):
    value: object


@dataclass(frozen=True, eq=False)
class Ci(Expr):
    """Text to compare regardless of letter case."""

    value: str


@dataclass(frozen=True, eq=False)
class Call(Expr):
    build: Callable[..., Column]
    args: tuple


@dataclass(frozen=True, eq=False)
class Compare(Expr):
    op: str
    left: Expr
    right: Expr


@dataclass(frozen=True, eq=False)
class In(Expr):
    left: Expr
    values: tuple


@dataclass(frozen=True, eq=False)
class Contains(Expr):
    left: Expr
    part: Expr


@dataclass(frozen=True, eq=False)
class Bool(Expr):
    op: str
    args: tuple


@dataclass(frozen=True, eq=False)
class Reach(Expr):
    """A test of what a chain reaches. kind: any (some reached node meets ``where``), count, min, max, avg or sum."""

    hops: tuple
    kind: str = "any"
    where: Expr | None = None
    field: str | None = None
    op: str = "=="
    value: object = True


OPS = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def wrap(v) -> Expr:
    return v if isinstance(v, Expr) else Lit(v)


def attr(name: str) -> Attr:
    return Attr(name)


def calc(name: str) -> Calc:
    return Calc(name)


def ci(text: str) -> Ci:
    return Ci(text)


def func(build: Callable[..., Column], *args) -> Call:
    """Any function of Columns, given expressions or values."""
    return Call(build, tuple(wrap(a) for a in args))


@dataclass(frozen=True, eq=False)
class _Measure:
    hops: tuple
    kind: str
    field: str | None = None

    def _reach(self, op, value):
        if self.field is not None and self.kind == "any":
            return Reach(self.hops, where=Compare(op, Attr(self.field), wrap(value)))
        return Reach(self.hops, self.kind, None, self.field, op, value)

    def __eq__(self, v):  # type: ignore[override]
        return self._reach("==", v)

    def __ne__(self, v):  # type: ignore[override]
        return self._reach("!=", v)

    def __lt__(self, v):
        return self._reach("<", v)

    def __le__(self, v):
        return self._reach("<=", v)

    def __gt__(self, v):
        return self._reach(">", v)

    def __ge__(self, v):
        return self._reach(">=", v)

    __hash__ = object.__hash__

    def isin(self, values) -> Reach:
        return Reach(self.hops, where=Attr(self.field).isin(values))

    def contains(self, part) -> Reach:
        return Reach(self.hops, where=Attr(self.field).contains(part))


@dataclass(frozen=True)
class Traverse:
    """A chain of hops: ("forward" or "reverse", relationship name or (edge type,) or (edge type, destination))."""

    hops: tuple

    def field(self, name: str) -> _Measure:
        return _Measure(self.hops, "any", name)

    def exists(self) -> Reach:
        return Reach(self.hops)

    def where(self, test: Expr) -> Reach:
        return Reach(self.hops, where=test)

    def count(self) -> _Measure:
        return _Measure(self.hops, "count")

    def min(self, name: str) -> _Measure:
        return _Measure(self.hops, "min", name)

    def max(self, name: str) -> _Measure:
        return _Measure(self.hops, "max", name)

    def avg(self, name: str) -> _Measure:
        return _Measure(self.hops, "avg", name)

    def sum(self, name: str) -> _Measure:
        return _Measure(self.hops, "sum", name)


def traverse(*hops) -> Traverse:
    return Traverse(tuple(("forward", h) if isinstance(h, str) else h for h in hops))


def exists(path: str | tuple, test: Expr | None = None) -> Reach:
    """Whether a node over named relationships meets a test."""
    names = (path,) if isinstance(path, str) else path
    return Reach(tuple(("forward", n) for n in names), where=test)


def reaches(e: Expr) -> list[Reach]:
    """All tests of chains in an expression."""
    if isinstance(e, Reach):
        return [e]
    inner = e.args if isinstance(e, (Bool, Call)) else (e.left, e.right) if isinstance(e, Compare) else (e.left,) if isinstance(e, (In, Contains)) else ()
    return [r for x in inner for r in reaches(x)]


def conjuncts(e: Expr) -> list[Expr]:
    return [c for a in e.args for c in conjuncts(a)] if isinstance(e, Bool) and e.op == "and" else [e]


def _folds(e: Expr, scope: Scope) -> bool:
    return isinstance(e, Ci) or isinstance(e, Attr) and scope.is_ci(e.name)


def column(e: Expr, scope: Scope, marks: dict[int, Column] | None = None) -> Column:
    """The Column of an expression. marks: Columns that stand for its tests of chains."""
    def c(x):
        return column(x, scope, marks)

    if isinstance(e, Attr):
        return scope.column(e.name)
    if isinstance(e, Calc):
        return scope.calculation(e.name)
    if isinstance(e, (Lit, Ci)):
        return e.value if isinstance(e.value, Column) else F.lit(e.value)
    if isinstance(e, Call):
        return e.build(*[c(a) for a in e.args])
    if isinstance(e, Compare):
        left, right = c(e.left), c(e.right)
        if _folds(e.left, scope) or _folds(e.right, scope):
            left, right = F.lower(left), F.lower(right)
        return OPS[e.op](left, right)
    if isinstance(e, In):
        values = [v.value if isinstance(v, (Lit, Ci)) else v for v in e.values if v is not None]
        if not values:
            return F.lit(False)
        if _folds(e.left, scope) or any(isinstance(v, Ci) for v in e.values):
            return F.lower(c(e.left)).isin([str(v).lower() for v in values])
        return c(e.left).isin(values)
    if isinstance(e, Contains):
        left, part = c(e.left), c(e.part)
        if _folds(e.left, scope) or _folds(e.part, scope):
            left, part = F.lower(left), F.lower(part)
        return left.contains(part)
    if isinstance(e, Bool):
        args = [c(a) for a in e.args]
        return ~args[0] if e.op == "not" else args[0] & args[1] if e.op == "and" else args[0] | args[1]
    if isinstance(e, Reach):
        if marks is None or id(e) not in marks:
            from ..errors import UnresolvableTraversal

            raise UnresolvableTraversal("unsupported_predicate", predicate=e.kind)
        return marks[id(e)]
    raise TypeError(f"no expression: {e!r}")


__all__ = ["Attr", "Calc", "Ci", "Expr", "Lit", "Reach", "Traverse", "attr", "calc", "ci", "column", "conjuncts", "exists", "func", "reaches", "replace", "traverse", "wrap"]
