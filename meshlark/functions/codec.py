"""Codecs for values that other stores keep as text or bytes: JSON with sorted keys, base64, tensors, nested arrays."""

from __future__ import annotations

import base64
import datetime as dt
import json
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import TensorOf


def to_json(value: object) -> str:
    """Compact JSON: keys sorted, null entries of maps left out, times in ISO 8601, decimals and names as text."""

    def plain(v):
        if isinstance(v, dict):
            return {str(k): plain(x) for k, x in sorted(v.items(), key=lambda kv: str(kv[0])) if x is not None}
        if isinstance(v, (list, tuple)):
            return [plain(x) for x in v]
        if isinstance(v, (dt.date, dt.datetime, dt.time)):
            return v.isoformat()
        if isinstance(v, Decimal):
            return str(v)
        if isinstance(v, bytes):
            return base64.b64encode(v).decode()
        if hasattr(v, "__dataclass_fields__"):
            return plain(vars(v))
        return v

    return json.dumps(plain(value), separators=(",", ":"), ensure_ascii=False)


def from_json(text: str | None) -> object:
    return None if text is None else json.loads(text)


def to_base64(data: bytes | None, url: bool = False) -> str | None:
    return None if data is None else (base64.urlsafe_b64encode if url else base64.b64encode)(data).decode()


def from_base64(text: str | None, url: bool = False) -> bytes | None:
    return None if text is None else (base64.urlsafe_b64decode if url else base64.b64decode)(text)


def dump_nested(values: list | None) -> list[str] | None:
    """A nested array as a list of JSON texts, one for each inner array."""
    return None if values is None else [to_json(v) for v in values]


def load_nested(texts: list[str] | None) -> list | None:
    return None if texts is None else [json.loads(t) for t in texts]


def tag_union(kind: str, value: object) -> dict:
    return {"type": kind, "value": to_json(value)}


def untag_union(value: dict | None) -> tuple[str, object] | None:
    return None if value is None else (value["type"], json.loads(value["value"]))


#: Little-endian numpy types of tensor elements; bf16 is kept as f32.
ELEMENTS = {**{f"{k}{n}": f"<{'i' if k == 's' else 'u'}{n // 8}" for k in "su" for n in (8, 16, 32, 64)}, "f16": "<f2", "f32": "<f4", "f64": "<f8", "bf16": "<f4"}


def dump_tensor(values: object, kind: TensorOf) -> list | bytes | None:
    """Nested numbers as a flat list, or packed bytes; the shape must be the type's."""
    if values is None:
        return None
    a = np.asarray(values)
    if a.shape != tuple(kind.shape):
        raise ValueError(f"the tensor has shape {a.shape} instead of {tuple(kind.shape)}")
    return a.astype(ELEMENTS[kind.element]).tobytes() if kind.packed else a.reshape(-1).tolist()


def load_tensor(data: list | bytes | None, kind: TensorOf) -> np.ndarray | None:
    if data is None:
        return None
    t = ELEMENTS[kind.element]
    return (np.frombuffer(data, t) if isinstance(data, (bytes, bytearray)) else np.asarray(data, dtype=t)).reshape(kind.shape)


# Columns ---------------------------------------------------------------------------------------------------------

def _in_order(c: Column, kind: T.DataType) -> Column:
    """A value with the fields of its structs and the keys of its maps in order."""
    if isinstance(kind, T.StructType):
        return F.when(c.isNotNull(), F.struct(*[_in_order(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _in_order(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.array_sort(F.transform(F.filter(F.map_entries(c), lambda e: e["value"].isNotNull()), lambda e: F.struct(e["key"].cast("string").alias("key"), _in_order(e["value"], kind.valueType).alias("value")))))
    return c


def json_column(c: Column, kind: T.DataType) -> Column:
    """Compact JSON of a struct, map or array of this type: keys in order, null entries left out; null for null."""
    return F.to_json(_in_order(c, kind), {"ignoreNullFields": "true"})


def base64_column(data: Column, url: bool = False) -> Column:
    text = F.base64(data)
    return F.translate(text, "+/", "-_") if url else text


def unbase64_column(text: Column, url: bool = False) -> Column:
    return F.unbase64(F.translate(text, "-_", "+/") if url else text)


def nested_column(c: Column) -> Column:
    """A nested array as an array of JSON texts, one for each inner array."""
    return F.transform(c, lambda x: F.to_json(x))


def unnested_column(texts: Column, inner: str) -> Column:
    """The nested array; inner: the type of its elements, such as array<bigint>."""
    return F.transform(texts, lambda x: F.from_json(x, inner))


def tensor_column(c: Column, kind: TensorOf) -> Column:
    """Nested arrays as a flat one, or packed bytes; null for null, an error where the shape is not the type's."""
    def fits(x: Column, shape: tuple[int, ...]) -> Column:
        own = F.size(x) == shape[0]
        return own if len(shape) == 1 else own & F.forall(x, lambda y: fits(y, shape[1:]))

    flat = c
    for _ in kind.shape[1:]:
        flat = F.flatten(flat)
    flat = F.when(c.isNull(), F.lit(None)).when(F.coalesce(fits(c, kind.shape), F.lit(False)), flat).otherwise(F.raise_error(F.lit(f"the tensor does not have shape {tuple(kind.shape)}")))
    if not kind.packed:
        return flat
    element = ELEMENTS[kind.element]

    @F.arrow_udf(T.BinaryType())
    def packed(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else np.array(v, element).tobytes() for v in x.to_pylist()], pa.binary())

    return packed(flat)
