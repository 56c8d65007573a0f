"""Expressions to Spark columns, with types checked on the way.

Everything becomes built-in Catalyst expressions.  Nulls follow SQL's
three-valued logic; division is on doubles and gives null for a zero divisor,
as modulo does; logarithms are natural.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ColumnNotFound, ExprTypeError
from .expr import ARITHMETIC, COMPARISONS, Expr

_BINARY: dict[str, Callable[[Column, Column], Column]] = {
    "add": lambda a, b: a + b,
    "sub": lambda a, b: a - b,
    "mul": lambda a, b: a * b,
    "div": lambda a, b: F.try_divide(a.cast("double"), b.cast("double")),
    "mod": F.try_mod,
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
    "lt": lambda a, b: a < b,
    "le": lambda a, b: a <= b,
    "gt": lambda a, b: a > b,
    "ge": lambda a, b: a >= b,
    "and": lambda a, b: a & b,
    "or": lambda a, b: a | b,
}
_UNARY: dict[str, Callable[[Column], Column]] = {
    "not": lambda a: ~a,
    "neg": lambda a: -a,
    "abs": F.abs,
    "sqrt": F.sqrt,
    "log": F.log,
    "exp": F.exp,
    "ceil": F.ceil,
    "floor": F.floor,
    "is_null": lambda a: a.isNull(),
}
_AGGREGATE: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "prod": F.product, "min": F.min, "max": F.max, "count": F.count, "mean": F.avg}


def kind_of(kind: T.DataType) -> str:
    if isinstance(kind, T.NumericType):
        return "number"
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, T.StringType):
        return "text"
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "time"
    return "other"


def _literal(value: object) -> tuple[Column, str]:
    if value is None:
        return F.lit(None), "null"
    if isinstance(value, bool):
        return F.lit(value), "bool"
    if isinstance(value, int):
        return F.lit(value).cast("bigint"), "number"
    return F.lit(value), "number" if isinstance(value, float) else "text"


def _need(kind: str, wanted: str, op: str) -> None:
    if kind not in (wanted, "null"):
        raise ExprTypeError(f"{op} takes {wanted}, not {kind}")


def lower(e: Expr, schema: T.StructType, first: Callable[[Column], Column] | None = None, last: Callable[[Column], Column] | None = None, aggregate: Callable[[Expr], tuple[Column, str]] | None = None) -> tuple[Column, str]:
    """(column, kind) of an expression.  ``first`` and ``last`` say how those
    aggregates see the row order; ``aggregate``, where given, replaces every
    aggregate (for those inside a predicate)."""
    sub = lambda x: lower(x, schema, first, last, aggregate)
    if e.kind == "col":
        if e.op not in schema.names:
            raise ColumnNotFound(e.op)
        return F.col(f"`{e.op}`"), kind_of(schema[e.op].dataType)
    if e.kind == "lit":
        return _literal(e.op)
    if e.kind == "alias":
        c, kind = sub(e.args[0])
        return c.alias(e.op), kind
    if e.kind == "unop":
        c, kind = sub(e.args[0])
        if e.op != "is_null":
            _need(kind, "bool" if e.op == "not" else "number", e.op)
        return _UNARY[e.op](c), "bool" if e.op in ("not", "is_null") else "number"
    if e.kind == "binop":
        (a, ka), (b, kb) = map(sub, e.args)
        if e.op in ARITHMETIC:
            _need(ka, "number", e.op)
            _need(kb, "number", e.op)
            return _BINARY[e.op](a, b), "number"
        if e.op in COMPARISONS:
            if ka != kb and "null" not in (ka, kb) and {ka, kb} != {"time", "text"}:
                raise ExprTypeError(f"{e.op} compares like with like, not {ka} with {kb}")
            return _BINARY[e.op](a, b), "bool"
        _need(ka, "bool", e.op)
        _need(kb, "bool", e.op)
        return _BINARY[e.op](a, b), "bool"
    if e.kind == "agg":
        if aggregate is not None:
            return aggregate(e)
        if e.args[0].has_aggregate():
            raise ExprTypeError("an aggregate inside an aggregate")
        c, kind = sub(e.args[0])
        if e.op in ("sum", "prod", "mean"):
            _need(kind, "number", e.op)
        if e.op in ("first", "last"):
            by = first if e.op == "first" else last
            return by(c), kind
        return _AGGREGATE[e.op](c), "number" if e.op not in ("min", "max") else kind
    raise ExprTypeError(f"unknown expression {e.kind}")


def default_name(e: Expr, position: int) -> str:
    """``<column>_<method>``; ``agg<i>_<method>`` over other expressions;
    ``agg<i>`` for arithmetic over aggregates."""
    if e.kind == "alias":
        return e.op
    if e.kind == "agg":
        return f"{e.args[0].op}_{e.op}" if e.args[0].kind == "col" else f"agg{position}_{e.op}"
    if e.kind == "col":
        return f"{e.op}_first"
    return f"agg{position}" if e.has_aggregate() else f"agg{position}_first"
