"""The engine on small frames: goldens, nulls, special values, order, errors."""

import math
import os
from datetime import date, datetime
from decimal import Decimal
from concurrent.futures import Future

import numpy as np
import pytest

from larkspur import ColumnNotFound, Context, EngineError, QueryFailed, ReadFailed, col, lit
from larkspur.operators.dictionary import coded
from larkspur.operators.frame import _leading

HERE = os.path.join(os.path.dirname(__file__), "fixtures")
#: Rows of our own, with their own sums: tools 120.5 and 5 on average, garden 61.0 and 30, paper 6.75 and 400.
SALES = [("garden", "rake", 18.5, 20), ("paper", "card", 0.5, 700), ("tools", "saw", 30.25, 4), ("paper", "roll", 4.25, 200), ("tools", "drill", 80.0, 2), ("garden", "spade", 22.0, 40), ("tools", "file", 10.25, 9), ("garden", "hose", 20.5, 30), ("paper", "pad", 2.0, 300)]


@pytest.fixture(scope="module")
def ctx(spark):
    with Context(spark) as c:
        yield c


@pytest.fixture(scope="module")
def small(ctx):
    return ctx.read_csv(f"{HERE}/small.csv")


@pytest.fixture(scope="module")
def sales(ctx, spark):
    return ctx.table(spark.createDataFrame(SALES, "category string, product string, price double, quantity int").coalesce(1))


def rows(q):
    return [tuple(r) for r in q.to_df().collect()]


def frame(ctx, spark, data, schema):
    return ctx.table(spark.createDataFrame(data, schema).coalesce(1))


# ---- goldens


def test_shape(small):
    assert (small.n_rows, small.n_cols, small.columns) == (3, 3, ["id", "name", "value"])
    assert small.dtypes == {"id": "i32", "name": "sym", "value": "f64"}


def test_filter_head_sort(small, sales):
    assert list(small.filter(col("value") > 15).collect_sync().col("value").data) == [20.3, 30.1]
    assert small.head(2).collect_sync().n_rows == 2
    assert small.filter(col("value") > 5).head(1).collect_sync().n_rows == 1
    assert sales.sort("price").collect_sync().col("price").data[0] == 0.5
    assert sales.sort("price", descending=True).collect_sync().col("price").data[0] == 80.0


def test_group_and_sort(sales):
    got = rows(sales.group_by("category").agg(col("price").sum(), col("quantity").mean()).sort("price_sum", descending=True))
    assert [r[0] for r in got] == ["tools", "garden", "paper"]
    assert [round(r[1], 2) for r in got] == [120.5, 61.0, 6.75]
    assert [round(r[2], 3) for r in got] == [5.0, 30.0, 400.0]


def test_async(small, ctx):
    pending = small.filter(col("value") > 15).collect()
    assert isinstance(pending, Future) and pending.result(60).n_rows == 2
    assert ctx.read_csv_async(f"{HERE}/small.csv").result(60).n_rows == 3


# ---- values


def test_null_logic(ctx, spark):
    t = frame(ctx, spark, [(1, 1.0), (2, None), (None, 3.0)], "k int, v double")
    assert rows(t.filter(col("v") > 0)) == [(1, 1.0), (None, 3.0)]
    assert rows(t.filter((col("v") > 0).not_())) == []
    assert rows(t.filter(col("v").is_null())) == [(2, None)]
    assert rows(t.filter(col("v").is_null().or_(col("k") == 1))) == [(1, 1.0), (2, None)]
    got = rows(t.group_by().agg(col("v").sum(), col("v").count(), col("v").mean(), col("v").first(), col("k").last()))
    assert got == [(4.0, 2, 2.0, 1.0, None)]
    assert rows(t.sort("v")) == [(2, None), (1, 1.0), (None, 3.0)]
    assert rows(t.sort("v", descending=True))[-1] == (2, None)


def test_division_and_modulo(ctx, spark):
    t = frame(ctx, spark, [(7, 2), (-7, 3), (7, 0)], "a int, b int")
    got = rows(t.group_by("a", "b").agg((col("a") / col("b")).first().alias("d"), (col("a") % col("b")).first().alias("m")).sort("a", "b", descending=[True, True]))
    assert got == [(7, 2, 3.5, 1), (7, 0, None, None), (-7, 3, -7 / 3, -1)]


def test_special_values(ctx, spark):
    nan, inf = float("nan"), float("inf")
    t = frame(ctx, spark, [(nan,), (inf,), (-inf,), (-0.0,), (4.0,)], "x double")
    assert len(rows(t.filter(col("x") == nan))) == 1
    assert len(rows(t.filter(col("x") > 5))) == 2
    got = rows(t.filter(col("x") == 4.0).group_by("x").agg(col("x").sqrt().max().alias("s"), col("x").log().max().alias("l"), col("x").exp().max().alias("e"), col("x").ceil().max().alias("c"), col("x").floor().max().alias("f")))
    assert got == [(4.0, 2.0, math.log(4), math.exp(4), 4, 4)]


def test_overflow_is_an_error(ctx, spark):
    t = frame(ctx, spark, [((1 << 63) - 1,)], "x bigint")
    with pytest.raises(Exception, match="overflow"):
        rows(t.filter(col("x") + 1 > 0))


def test_empty(ctx, spark):
    t = frame(ctx, spark, [], "k int, v double")
    assert rows(t.group_by().agg(col("v").sum(), col("v").count())) == [(None, 0)]
    assert rows(t.group_by("k").agg(col("v").sum())) == []
    assert rows(t.head(3)) == [] and rows(t.sort("v")) == []
    assert t.collect_sync().col("v").length == 0 if hasattr(t, "collect_sync") else t.col("v").length == 0


# ---- order


def test_stable_and_chained_sorts(ctx, spark):
    t = frame(ctx, spark, [(2, 0), (1, 1), (2, 2), (1, 3)], "k int, id int")
    assert rows(t.sort("k")) == [(1, 1), (1, 3), (2, 0), (2, 2)]
    assert rows(t.sort("id", descending=True).sort("k")) == [(1, 3), (1, 1), (2, 2), (2, 0)]
    assert rows(t.head(2)) == [(2, 0), (1, 1)]
    assert rows(t.sort("id", descending=True).head(2)) == [(1, 3), (2, 2)]


def test_first_and_last_follow_the_order(ctx, spark):
    t = frame(ctx, spark, [("a", 1, "p"), ("a", 2, "q"), ("b", 3, None)], "k string, id int, s string")
    agg = (col("s").first(), col("s").last())
    assert rows(t.group_by("k").agg(*agg).sort("k")) == [("a", "p", "q"), ("b", None, None)]
    assert rows(t.sort("id", descending=True).group_by("k").agg(*agg).sort("k")) == [("a", "q", "p"), ("b", None, None)]
    assert rows(t.sort("s", descending=True).group_by("k").agg(col("id").first()).sort("k")) == [("a", 2), ("b", 3)]


def test_steps_are_sequential_and_immutable(sales):
    top = sales.sort("price", descending=True).head(2)
    assert sorted(rows(top.group_by("category").agg(col("price").count()))) == [("tools", 2)]
    q = sales.query()
    q.filter(col("price") > 100)
    assert len(rows(q)) == 9
    twice = sales.group_by("category", "product").agg(col("price").max()).group_by("category").agg(col("price_max").count())
    assert sorted(rows(twice)) == [("garden", 3), ("paper", 3), ("tools", 3)]


def test_parquet_order(ctx, spark, tmp_path):
    spark.range(100).selectExpr("99 - id AS k", "id % 3 AS g").coalesce(1).write.parquet(str(tmp_path / "t"))
    t = ctx.read_parquet(str(tmp_path / "t"))
    assert [r[0] for r in rows(t.head(3))] == [99, 98, 97]
    assert rows(t.group_by("g").agg(col("k").first()).sort("g")) == [(0, 99), (1, 98), (2, 97)]
    assert [r[0] for r in rows(t.sort("g").head(2))] == [99, 96]
    assert [r[0] for r in rows(t.filter(col("k") > col("k").mean()).head(2))] == [99, 98]


def test_descending_ends_of_every_type(ctx, spark):
    values = {
        "tinyint": [(-128,), (127,), (0,), (None,)],
        "bigint": [(-(1 << 63),), ((1 << 63) - 1,), (0,), (None,)],
        "double": [(float("nan"),), (-0.0,), (float("inf"),), (float("-inf"),), (None,), (2.5,)],
        "string": [("",), ("a",), ("ab",), ("b",), (None,), ("\u00e9",), ("\U0001f600",)],
        "boolean": [(True,), (False,), (None,)],
        "decimal(8,2)": [(Decimal("-1.5"),), (Decimal("2.25"),), (None,)],
        "date": [(date(1969, 1, 2),), (date(2001, 3, 4),), (None,)],
        "timestamp": [(datetime(1969, 1, 2, 3, 4, 5, 6),), (datetime(2001, 3, 4),), (None,)],
        "timestamp_ntz": [(datetime(1969, 1, 2, 3, 4, 5, 6),), (datetime(1969, 1, 2, 3, 4, 5, 7),), (datetime(2001, 3, 4, 23),), (datetime(2001, 3, 4, 7, 59),), (None,)],
        "array<int>": [([1],), ([1, 2],), (None,)],
    }
    for kind, some in values.items():
        t = frame(ctx, spark, [(i, v) for i, (v,) in enumerate(some)] + [(99, some[0][0])], f"id int, v {kind}")
        for down in (True, False):
            order = [r[0] for r in rows(t.sort("v", descending=down))]
            got = rows(t.sort("v", descending=down).group_by().agg(col("id").first().alias("a"), col("id").last().alias("b")))
            assert got == [(order[0], order[-1])], (kind, down)


def test_ends_of_grouped_frames(ctx, spark):
    t = frame(ctx, spark, [("a", 1), ("b", 5), ("c", 5), ("a", 2)], "k string, v int")
    sums = t.group_by("k").agg(col("v").sum().alias("s"))
    assert rows(sums.group_by().agg(col("k").first(), col("s").last())) == [("a", 5)]
    assert rows(sums.sort("s", descending=True).group_by().agg(col("k").first().alias("x"), col("k").last().alias("y"))) == [("b", "a")]


def test_heads_read_the_first_files(ctx, spark, tmp_path):
    for i in range(9):
        spark.range(10 * i, 10 * i + 10 + i).coalesce(1).write.parquet(str(tmp_path / f"t{i}"))
    for i in range(9):
        part = next((tmp_path / f"t{i}").glob("*.parquet"))
        part.rename(tmp_path / f"f{i}.parquet")
    t = ctx.read_parquet(str(tmp_path / "f*.parquet"))
    assert [r[0] for r in rows(t.head(12))] == [*range(10), 10, 11]
    assert [r[0] for r in rows(t.filter(col("id") >= 35).head(3))] == [35, 36, 37]
    assert [r[0] for r in rows(t.head(12).head(11))] == [*range(10), 10]
    assert len(rows(t.head(1000))) == 126 and rows(t.head(0)) == []
    assert [_leading(t._frame, n).count() for n in (10, 12, 70)] == [10, 46, 126]


def test_dictionary_codes(spark):
    values = ["b", None, "a", "b", "", "c", "aa"]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    place = {v: i for i, v in enumerate(sorted({v for v in values if v is not None}))}
    for parts in (1, 3, 8):
        got = {r.id: r.code for r in coded(df, "v", parts=parts).collect()}
        assert got == {i: place.get(v) for i, v in enumerate(values)}
    assert coded(df.limit(0), "v").count() == 0


# ---- groups


def test_names(sales):
    q = sales.group_by("category").agg(col("price").sum(), (col("price") * 2).max(), col("product"), (col("price").sum() / col("quantity").sum()))
    assert q.collect_sync().columns == ["category", "price_sum", "agg1_max", "product_first", "agg3"]
    with pytest.raises(EngineError, match="alias"):
        sales.group_by("category").agg(col("price").sum(), col("price").sum())


def test_zero_keys_and_zero_aggregates(sales):
    assert len(rows(sales.group_by("category").agg())) == 3
    assert rows(sales.group_by().agg(col("price").count())) == [(9,)]
    with pytest.raises(EngineError):
        sales.group_by().agg()


def test_product_and_null_key(ctx, spark):
    t = frame(ctx, spark, [(None, 2.0), (None, 3.0), (1, 4.0)], "k int, v double")
    assert rows(t.group_by("k").agg(col("v").prod()).sort("k")) == [(None, 6.0), (1, 4.0)]


# ---- series


def test_series(ctx, spark):
    t = frame(ctx, spark, [("b", 1.5, True), (None, None, None), ("a", 2.5, False), ("b", 0.0, True)], "s string, v double, f boolean")
    s, v = t.col("s"), t.col("v")
    assert (s.dtype, s.name, len(s)) == ("sym", "s", 4)
    assert s.indices.dtype == np.uint8 and [s.dictionary[i] for i in s.indices[[0, 2, 3]]] == ["b", "a", "b"]
    assert list(s.null_bitmap) == [0b1101] and t.col("f").data.dtype == np.uint8
    assert v.data.dtype == np.float64 and list(v.null_bitmap) == [0b1101]
    for wrong in (lambda: s.data, lambda: v.indices, lambda: v.dictionary):
        with pytest.raises(TypeError):
            wrong()


def test_raw_times(ctx, spark):
    t = ctx.table(spark.sql("SELECT DATE'2000-01-03' AS d, TIMESTAMP_NTZ'1970-01-01 00:00:01' AS t, 5S AS h"))
    assert (t.col("d").data[0], t.col("t").data[0], t.col("h").dtype) == (2, 1_000_000_000, "i16")
    assert t.col("d").dtype == "date" and t.col("t").null_bitmap is None


@pytest.mark.parametrize(("n", "kind"), [(256, np.uint8), (257, np.uint16), (70_000, np.uint32)])
def test_index_width(ctx, spark, n, kind):
    s = ctx.table(spark.range(n).selectExpr("cast(id AS string) AS s")).col("s")
    assert s.indices.dtype == kind and len(s.dictionary) == n


# ---- sources and errors


def test_csv_edges(ctx, tmp_path):
    path = tmp_path / "e.csv"
    path.write_text('a,b\n1,"x, ""y"""\n,z\n')
    assert rows(ctx.read_csv(str(path)).query()) == [(1, 'x, "y"'), (None, "z")]
    path.write_text('a,b\n1,"x\ny, ""z"""\n2,w\n')
    assert rows(ctx.read_csv(str(path)).query()) == [(1, 'x\ny, "z"'), (2, "w")]
    assert rows(ctx.read_csv(str(path), "a int, b string", multi_line=True).head(1)) == [(1, 'x\ny, "z"')]
    with pytest.raises(Exception, match="(?i)malformed|failed_read"):
        rows(ctx.read_csv(str(path), "a int, b string", multi_line=False).query())
    path.write_text("a,b\n")
    assert ctx.read_csv(str(path)).n_rows == 0
    assert rows(ctx.read_csv(f"{HERE}/small.csv", "id bigint, name string, value double").head(1)) == [(1, "alpha", 10.5)]


def test_csv_files_are_in_order(ctx, tmp_path):
    for i, n in enumerate((1, 30, 5)):
        (tmp_path / f"{i}.csv").write_text("a\n" + "".join(f"{100 * i + k}\n" for k in range(n)))
    t = ctx.read_csv(str(tmp_path))
    assert [r[0] for r in rows(t.head(4))] == [0, 100, 101, 102]
    assert rows(t.group_by().agg(col("a").first(), col("a").last().alias("z"))) == [(0, 204)]


def test_errors(ctx, small):
    with pytest.raises(ColumnNotFound, match="Column not found: nope"):
        small.col("nope")
    for build in (lambda: small.filter(col("nope") > 1), lambda: small.sort("nope"), lambda: small.group_by("nope").agg()):
        with pytest.raises(ColumnNotFound):
            build()
    for build in (lambda: small.filter(col("name") > 1), lambda: small.filter(col("value")), lambda: small.filter(lit("x")), lambda: small.group_by().agg(col("name").sum()), lambda: small.group_by().agg(col("id").sum().sum()), lambda: small.head(1.5), lambda: small.col(3), lambda: ctx.read_csv(3)):
        with pytest.raises(TypeError):
            build()
    with pytest.raises(ValueError):
        small.head(-1)
    with pytest.raises(ReadFailed, match="Failed to read CSV"):
        ctx.read_csv("/no/such/file.csv")
    assert QueryFailed("x").code == "query"


def test_destroyed(spark):
    c = Context(spark)
    t = c.read_csv(f"{HERE}/small.csv")
    c.destroy()
    c.destroy()
    for use in (lambda: c.read_csv(f"{HERE}/small.csv"), lambda: t.head(1), lambda: t.n_rows, lambda: c.submit(print)):
        with pytest.raises(RuntimeError, match="destroyed"):
            use()
    assert spark.range(1).count() == 1
