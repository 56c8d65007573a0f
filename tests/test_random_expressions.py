"""Random predicates against DuckDB, where both engines mean the same: values
stay small, divisors are guarded, logarithms and roots take positive numbers."""

import random

import duckdb
import pandas as pd
import pytest

from larkspur import Context, col, lit

ROWS = [
    (k, rng.choice([None, *range(-5, 6)]), rng.choice([None, -2.5, -1.0, 0.0, 0.5, 3.0]), rng.choice([None, "a", "b", "é"]), rng.choice([None, True, False]))
    for rng in [random.Random(6)]
    for k in range(120)
]


def number(rng, depth):
    if depth == 0 or rng.random() < 0.2:
        name = rng.choice(["i", "x", None])
        if name:
            return col(name), name
        v = rng.choice([0, 1, 2, -3, 0.5, 2.25])
        return lit(v), f"({v})"
    op = rng.choice(["add", "sub", "mul", "div", "neg", "abs", "sqrt", "log", "exp", "ceil", "floor", "mod"])
    a, sa = number(rng, depth - 1)
    if op in ("add", "sub", "mul"):
        b, sb = number(rng, depth - 1)
        return getattr(a, op)(b), f"({sa} {dict(add='+', sub='-', mul='*')[op]} {sb})"
    if op == "div":
        b, sb = number(rng, depth - 1)
        return a / b, f"({sa}::DOUBLE / NULLIF({sb}, 0))"
    if op == "mod":
        return a.floor() % 3, f"(floor({sa})::BIGINT % 3)"
    if op in ("neg", "abs"):
        return getattr(a, op)(), f"({'-' if op == 'neg' else 'abs'}({sa}))"
    if op in ("ceil", "floor"):
        return getattr(a, op)(), f"({op}({sa})::BIGINT)"
    if op == "exp":
        return (abs(a) * -1).exp(), f"exp(abs({sa}) * -1)"
    return getattr(abs(a) + 1, op)(), f"{'sqrt' if op == 'sqrt' else 'ln'}(abs({sa}) + 1)"


def predicate(rng, depth):
    kind = rng.choice(["and", "or", "not", "cmp", "cmp", "null", "text", "bool"]) if depth else rng.choice(["cmp", "null", "text", "bool"])
    if kind in ("and", "or"):
        (a, sa), (b, sb) = predicate(rng, depth - 1), predicate(rng, depth - 1)
        return (a & b if kind == "and" else a | b), f"({sa} {kind} {sb})"
    if kind == "not":
        a, sa = predicate(rng, depth - 1)
        return ~a, f"(NOT {sa})"
    if kind == "null":
        a, sa = number(rng, 1)
        return a.is_null(), f"({sa} IS NULL)"
    if kind == "bool":
        return col("f"), "f"
    op, sign = rng.choice([("eq", "="), ("ne", "<>"), ("lt", "<"), ("le", "<="), ("gt", ">"), ("ge", ">=")])
    if kind == "text":
        return getattr(col("s"), op)("b"), f"(s {sign} 'b')"
    (a, sa), (b, sb) = number(rng, 2), number(rng, 1)
    return getattr(a, op)(b), f"({sa} {sign} {sb})"


@pytest.fixture(scope="module")
def table(spark):
    with Context(spark) as context:
        yield context.table(spark.createDataFrame(ROWS, "k int, i int, x double, s string, f boolean").coalesce(1))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    frame = pd.DataFrame(ROWS, columns=list("kixsf")).astype({"i": "Int32", "x": "Float64", "f": "boolean"})  # noqa: F841
    con.sql("CREATE TABLE t AS SELECT k::INT AS k, i::INT AS i, x::DOUBLE AS x, s::VARCHAR AS s, f::BOOLEAN AS f FROM frame")
    return con


@pytest.mark.parametrize("seed", range(40))
def test_predicate(table, duck, seed):
    e, sql = predicate(random.Random(seed), 3)
    got = [r.k for r in table.filter(e).to_df().collect()]
    assert got == [k for (k,) in duck.sql(f"SELECT k FROM t WHERE {sql} ORDER BY k").fetchall()], (repr(e), sql)
