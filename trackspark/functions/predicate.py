"""A predicate language, compiled to columns: ``field op literal``.

Two-valued: a missing field is null, equality is null-safe, a boolean literal compares truth, a
numeric literal compares numbers, ordering is false for what is no number. An empty predicate holds.

A field may lie inside structs, maps, arrays (by position) and VARIANT: ``a.b.0``. A column that
bears the whole name comes first, then the longest column name that begins it.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

_SIGNS = "=!<>"
_WORDS = {"true": True, "false": False, "null": None, "none": None}


def parts(expr: str) -> tuple[str, str, str]:
    """(field, operator, literal text): the operator is the first run of comparison signs."""
    begin = next((i for i, c in enumerate(expr) if c in _SIGNS), len(expr))
    end = begin
    while end < len(expr) and expr[end] in _SIGNS and end - begin < 2:
        end += 1
    op = expr[begin:end]
    if op not in _ORDER and op not in ("==", "!="):
        raise ValueError(f"predicate {expr!r} is not 'field op literal'")
    token = expr[end:].strip()
    if not token:
        raise ValueError(f"predicate {expr!r} is not 'field op literal'")
    return expr[:begin].strip(), op, token


def literal(token: str) -> object:
    """A quoted text, one of the words for truth and nothing, a number, else plain text."""
    t = token.strip()
    for quote in ("'", '"'):
        if len(t) >= 2 and t.startswith(quote) and t.endswith(quote):
            return t[1:-1]
    if t.lower() in _WORDS:
        return _WORDS[t.lower()]
    if t.lstrip("+-").isdecimal() and t.isascii():
        return int(t)
    try:
        return float(t)
    except ValueError:
        return t


def truth(c: Column, kind: str) -> Column:
    """Whether a value counts as true: not null, not empty, not 0."""
    if kind == "boolean":
        held = c
    elif kind == "string":
        held = F.length(c) > 0
    elif kind.startswith(("array", "map")):
        held = F.size(c) > 0
    elif kind.startswith("struct"):
        held = c.isNotNull()
    else:
        held = c.cast("double") != 0
    return F.coalesce(held, F.lit(False))


def number(c: Column, kind: str) -> Column:
    return (c.cast("int") if kind == "boolean" else c.cast("string")).try_cast("double")


_SAME: dict[type, Callable[[Column, str, object], Column]] = {
    bool: lambda c, kind, v: truth(c, kind) if v else ~truth(c, kind),
    type(None): lambda c, kind, v: c.isNull(),
    int: lambda c, kind, v: number(c, kind).eqNullSafe(F.lit(float(v))),
    float: lambda c, kind, v: number(c, kind).eqNullSafe(F.lit(v)),
    str: lambda c, kind, v: c.cast("string").eqNullSafe(F.lit(v)),
}
_ORDER: dict[str, Callable[[Column, float], Column]] = {">": lambda a, b: a > b, "<": lambda a, b: a < b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b}


def compare(c: Column, kind: str, op: str, value: object) -> Column:
    if op in _ORDER:
        if isinstance(value, str):
            value = literal(value)
        if not isinstance(value, (int, float)):
            return F.lit(False)
        n = number(c, kind)
        return F.coalesce(_ORDER[op](n, float(value)) & ~F.isnan(n), F.lit(False))
    same = _SAME[type(value)](c, kind, value)
    return same if op == "==" else ~same


def inside(c: Column, kind: DataType, steps: list[str]) -> tuple[Column, str]:
    """The value below a column, step by step; null where a step leads nowhere."""
    for i, step in enumerate(steps):
        if isinstance(kind, StructType) and step in kind.fieldNames():
            c, kind = c.getField(step), kind[step].dataType
        elif isinstance(kind, MapType):
            c, kind = F.try_element_at(c, F.lit(step)), kind.valueType
        elif isinstance(kind, ArrayType) and step.isdecimal():
            c, kind = F.get(c, F.lit(int(step))), kind.elementType
        elif isinstance(kind, VariantType):
            way = "".join(f"[{s}]" if s.isdecimal() else f"['{s}']" for s in steps[i:])
            return F.try_variant_get(c, "$" + way, "string"), "string"
        else:
            return F.lit(None).cast("string"), "string"
    if isinstance(kind, VariantType):
        return F.try_variant_get(c, "$", "string"), "string"
    return c, kind.simpleString()


def field(name: str, types: dict[str, str]) -> tuple[Column, str]:
    """(column, type) of a name in a table with the given dtypes; an unknown name is a null text."""
    if name in types:
        return inside(F.col(f"`{name}`"), DataType.fromDDL(types[name]), [])
    steps = name.split(".")
    for k in range(len(steps) - 1, 0, -1):
        top = ".".join(steps[:k])
        if top in types:
            return inside(F.col(f"`{top}`"), DataType.fromDDL(types[top]), steps[k:])
    return F.lit(None).cast("string"), "string"


def predicate(expr: str | None, types: dict[str, str]) -> Column:
    """A column for the expression; ``types`` are the table's dtypes, unknown fields are null."""
    if not expr or not expr.strip():
        return F.lit(True)
    name, op, token = parts(expr)
    if not name:
        raise ValueError(f"predicate {expr!r} is not 'field op literal'")
    return compare(*field(name, types), op, literal(token))


def field_of(expr: str | None) -> str | None:
    """The field a predicate asks for."""
    return parts(expr)[0] if expr and expr.strip() else None


def valid_when(c: Column, kind: str, expr: str) -> Column:
    """A validity test such as "==1" or ">=0" on one column."""
    name, op, token = parts(expr)
    if name:
        raise ValueError(f"validity {expr!r} is not 'op literal'")
    return compare(c, kind, op, literal(token))


def glob(c: Column, patterns: list[str]) -> Column:
    """True where a shell pattern matches the whole text."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.coalesce(c.rlike("^" + fnmatch.translate(p).replace("\\z", "$").replace("(?s:", "(?:").replace(")\\Z", ")$")), F.lit(False))
    return hit
