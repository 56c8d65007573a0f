"""Expression trees, without Spark."""

import pytest

from larkspur import Expr, col, lit


def test_leaves():
    assert (col("a").kind, col("a").op) == ("col", "a")
    assert [(lit(v).kind, lit(v).op) for v in (1, 2.5, "x", True, None)] == [("lit", 1), ("lit", 2.5), ("lit", "x"), ("lit", True), ("lit", None)]


def test_operators_and_methods_agree():
    a, b = col("a"), col("b")
    pairs = [(a + b, a.add(b)), (a - b, a.sub(b)), (a * b, a.mul(b)), (a / b, a.div(b)), (a % b, a.mod(b)), (a == b, a.eq(b)), (a != b, a.ne(b)), (a < b, a.lt(b)), (a <= b, a.le(b)), (a > b, a.gt(b)), (a >= b, a.ge(b)), (a & b, a.and_(b)), (a | b, a.or_(b)), (~a, a.not_()), (-a, a.neg()), (abs(a), a.abs())]
    for x, y in pairs:
        assert repr(x) == repr(y)


def test_wrapping():
    assert repr(col("a") > 5) == "gt(col('a'), lit(5))"
    assert repr(2 - col("a")) == "sub(lit(2), col('a'))"
    with pytest.raises(TypeError):
        col("a") & True
    with pytest.raises(TypeError):
        lit(1 << 63)
    with pytest.raises(TypeError):
        lit([1])
    with pytest.raises(TypeError):
        col(1)


def test_chains_alias_and_aggregates():
    e = (col("a") * col("b")).sum().alias("s")
    assert e.kind == "alias" and e.args[0].kind == "agg" and e.has_aggregate()
    assert repr(e) == "sum(mul(col('a'), col('b'))).alias('s')"
    assert [repr(getattr(col("x"), m)()) for m in ("sum", "prod", "min", "max", "count", "mean", "first", "last", "sqrt", "log", "exp", "ceil", "floor", "is_null")][:2] == ["sum(col('x'))", "prod(col('x'))"]


def test_immutable():
    with pytest.raises(AttributeError):
        col("a").op = "b"
    with pytest.raises(TypeError):
        bool(col("a") == 1)
    assert isinstance(col("a") == 1, Expr)
