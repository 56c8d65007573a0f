"""Expression trees, built by ``col`` and ``lit`` and by operators or methods."""

from __future__ import annotations

from collections.abc import Iterator

ARITHMETIC = ("add", "sub", "mul", "div", "mod")
COMPARISONS = ("eq", "ne", "lt", "le", "gt", "ge")
LOGIC = ("and", "or")
UNARY = ("not", "neg", "abs", "sqrt", "log", "exp", "ceil", "floor", "is_null")
AGGREGATES = ("sum", "prod", "min", "max", "count", "mean", "first", "last")


class Expr:
    """An immutable node: a column, a literal, an operation, an aggregate or an
    alias.  ``==`` and the other operators build expressions."""

    __slots__ = ("args", "kind", "op")

    def __init__(self, kind: str, op: object, *args: Expr):
        object.__setattr__(self, "kind", kind)
        object.__setattr__(self, "op", op)
        object.__setattr__(self, "args", args)

    def __setattr__(self, name, value):
        raise AttributeError("expressions do not change")

    __hash__ = object.__hash__

    def __bool__(self):
        raise TypeError("an expression has no truth value; use & | ~ or and_, or_, not_")

    def __repr__(self) -> str:
        if self.kind in ("col", "lit"):
            return f"{self.kind}({self.op!r})"
        return f"{self.op}({', '.join(map(repr, self.args))})" if self.kind != "alias" else f"{self.args[0]!r}.alias({self.op!r})"

    def walk(self) -> Iterator[Expr]:
        yield self
        for a in self.args:
            yield from a.walk()

    def has_aggregate(self) -> bool:
        return any(e.kind == "agg" for e in self.walk())

    def alias(self, name: str) -> Expr:
        if not isinstance(name, str):
            raise TypeError("an alias is a string")
        return Expr("alias", name, self)


def col(name: str) -> Expr:
    """A column by name."""
    if not isinstance(name, str):
        raise TypeError("a column's name is a string")
    return Expr("col", name)


def lit(value: object) -> Expr:
    """A literal: bool, int (64 bits), float, str or None (a null)."""
    if value is not None and not isinstance(value, (bool, int, float, str)):
        raise TypeError(f"no literal of type {type(value).__name__}")
    if isinstance(value, int) and not -(1 << 63) <= value < 1 << 63:
        raise TypeError("an integer literal has 64 bits")
    return Expr("lit", value)


def wrapped(value: object) -> Expr:
    return value if isinstance(value, Expr) else lit(value)


def _binary(op: str, wrap: bool):
    def method(self: Expr, other: object) -> Expr:
        if not wrap and not isinstance(other, Expr):
            raise TypeError(f"{op} takes an expression")
        return Expr("binop", op, self, wrapped(other))

    return method


def _reflected(op: str):
    return lambda self, other: Expr("binop", op, wrapped(other), self)


def _unary(op: str):
    return lambda self: Expr("unop", op, self)


def _aggregate(op: str):
    return lambda self: Expr("agg", op, self)


for _op in (*ARITHMETIC, *COMPARISONS):
    setattr(Expr, _op, _binary(_op, wrap=True))
    if _op in COMPARISONS:
        setattr(Expr, f"__{_op}__", _binary(_op, wrap=True))
for _op, _name in (("add", "add"), ("sub", "sub"), ("mul", "mul"), ("div", "truediv"), ("mod", "mod")):
    setattr(Expr, f"__{_name}__", _binary(_op, wrap=True))
    setattr(Expr, f"__r{_name}__", _reflected(_op))
for _op in LOGIC:
    setattr(Expr, f"{_op}_", _binary(_op, wrap=False))
    setattr(Expr, f"__{_op}__", _binary(_op, wrap=False))
for _op in UNARY:
    setattr(Expr, f"{_op}_" if _op == "not" else _op, _unary(_op))
for _op, _name in (("not", "invert"), ("neg", "neg"), ("abs", "abs")):
    setattr(Expr, f"__{_name}__", _unary(_op))
for _op in AGGREGATES:
    setattr(Expr, _op, _aggregate(_op))
