"""Names: case conversions and checks."""

from __future__ import annotations

import re

#: What names must look like.
PASCAL = re.compile(r"[A-Z][a-zA-Z0-9]*\Z")
CAMEL = re.compile(r"[a-z][a-zA-Z0-9]*\Z")
MACRO = re.compile(r"[A-Z][A-Z0-9]*(_[A-Z0-9]+)*\Z")


def words(name: str) -> list[str]:
    """The words of a name in snake, camel, Pascal or macro case, in lower case."""
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+", name)]


def camel(name: str) -> str:
    first, *rest = re.split(r"_+", name.strip("_")) or [""]
    return first[:1].lower() + first[1:] + "".join(w[:1].upper() + w[1:] for w in rest)


def pascal(name: str) -> str:
    c = camel(name)
    return c[:1].upper() + c[1:]


def macro(name: str) -> str:
    return "_".join(w.upper() for w in words(name))


def short_name(name: str) -> str:
    """The last part of a dotted name."""
    return name.rpartition(".")[2]


def is_pascal(name: str) -> bool:
    return bool(PASCAL.match(name))


def is_camel(name: str) -> bool:
    return bool(CAMEL.match(name))


def is_macro(name: str) -> bool:
    return bool(MACRO.match(name))


def reverse(direction: str) -> str:
    return {"out": "in", "in": "out", "any": "any"}[direction]
