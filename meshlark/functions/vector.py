"""Vector similarity as Column expressions, inside whole-stage evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _vector(v: Column | Sequence[float]) -> Column:
    return v.cast("array<double>") if isinstance(v, Column) else F.array(*[F.lit(float(x)) for x in v]).cast("array<double>")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def vector_similarity(a: Column | Sequence[float], b: Column | Sequence[float]) -> Column:
    """(1 + cosine) / 2; 0.5 where a norm is zero; null for null, empty or unequally long vectors."""
    a, b = _vector(a), _vector(b)
    norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    cosine = F.when(norm == 0, F.lit(0.0)).otherwise(_dot(a, b) / norm)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), (1 + cosine) / 2)


def vector_cosine_distance(a: Column | Sequence[float], b: Column | Sequence[float]) -> Column:
    """1 - cosine, from 0 to 2."""
    return 2 - 2 * vector_similarity(a, b)


def check_dimensions(values: Sequence[float] | None, dimensions: int) -> list[float] | None:
    if values is not None and len(values) != dimensions:
        raise ValueError(f"the vector has {len(values)} elements instead of {dimensions}")
    return None if values is None else [float(v) for v in values]
