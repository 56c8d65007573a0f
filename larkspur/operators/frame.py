"""An ordered frame: a DataFrame with the order that its rows are in.

DataFrames have no order, so the frame keeps it apart: the sort keys, latest
first, and behind them the row's place in its source.  Sorting only notes the
keys; rows are sorted once, when an order is needed (head, result).  The place
in the source is read only then, so other plans scan no column for it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ColumnNotFound, EngineError, ExprTypeError
from ..functions.expr import Expr
from ..functions.lower import default_name, lower

ROW = "__row"


@dataclass(frozen=True)
class Frame:
    """``place``: how to order rows within the source: ``file`` (Parquet file
    and row index), ``row`` (a hidden column), or names of key columns."""

    df: DataFrame
    place: str | tuple[str, ...] = "row"
    order: tuple[tuple[str, bool], ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([f for f in self.df.schema.fields if f.name != ROW])

    @property
    def visible(self) -> DataFrame:
        return self.df.drop(ROW)

    def _place(self) -> list[Column]:
        if self.place == "file":
            return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]
        return [F.col(ROW)] if self.place == "row" else [F.col(f"`{k}`") for k in self.place]

    def keys(self) -> list[Column]:
        return [F.col(f"`{c}`").desc() if down else F.col(f"`{c}`").asc() for c, down in self.order] + self._place()

    def named(self) -> Frame:
        """The frame with its place in the source as a plain column."""
        if self.place != "file":
            return self
        return replace(self, df=self.df.withColumn(ROW, F.struct(*self._place())), place="row")

    def result(self) -> DataFrame:
        """The rows in their order, if any was asked for."""
        return self.df.orderBy(*self.keys()).drop(ROW) if self.order else self.visible


def filtered(frame: Frame, predicate: Expr) -> Frame:
    """Rows for which the predicate is true.  Aggregates inside it are computed
    over the frame once and joined as one broadcast row."""
    if not predicate.has_aggregate():
        c, kind = lower(predicate, frame.schema)
        if kind not in ("bool", "null"):
            raise ExprTypeError(f"a filter takes bool, not {kind}")
        return replace(frame, df=frame.df.filter(c))
    frame = frame.named()
    named: dict[str, tuple[Column, str]] = {}

    def aggregate(e: Expr) -> tuple[Column, str]:
        c, kind = lower(e, frame.schema, *_ends(frame))
        named[f"__agg{len(named)}"] = (c, kind)
        return F.col(f"__agg{len(named) - 1}"), kind

    c, kind = lower(predicate, frame.schema, aggregate=aggregate)
    if kind not in ("bool", "null"):
        raise ExprTypeError(f"a filter takes bool, not {kind}")
    row = frame.df.agg(*[a.alias(n) for n, (a, _) in named.items()])
    return replace(frame, df=frame.df.crossJoin(F.broadcast(row)).filter(c).drop(*named))


def _ends(frame: Frame):
    """First and last by the frame's order, nulls kept: the values at the least
    and the greatest place, which combine on the map side."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    by = [_backwards(F.col(f"`{c}`"), kinds[c]) if down else F.col(f"`{c}`") for c, down in frame.order]
    rank = F.struct(*[c.alias(f"k{i}") for i, c in enumerate((*by, *frame._place()))])
    return lambda c: F.min_by(c, rank), lambda c: F.max_by(c, rank)


def _backwards(c: Column, kind: T.DataType) -> Column | None:
    """A value that orders as ``c`` does backwards, nulls last; none for types
    that have no such value."""
    if isinstance(kind, T.IntegralType):
        key = [F.bitwise_not(c)]
    elif isinstance(kind, T.BooleanType):
        key = [~c]
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        key = [~F.isnan(c), -c]
    elif isinstance(kind, T.DecimalType):
        key = [-c]
    elif isinstance(kind, T.DateType):
        key = [-F.unix_date(c)]
    elif isinstance(kind, T.TimestampType):
        key = [-F.unix_micros(c)]
    elif isinstance(kind, T.TimestampNTZType):
        key = [-F.unix_date(c.cast("date")), -F.hour(c), -F.minute(c), -F.extract(F.lit("SECOND"), c)]
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        # a digit beyond all others ends it, so that of two the longer one is less
        key = [F.concat(F.translate(F.hex(c.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))]
    else:
        return None
    return F.struct(c.isNull().alias("none"), *[k.alias(f"v{i}") for i, k in enumerate(key)])


def grouped(frame: Frame, keys: tuple[str, ...], exprs: tuple[Expr, ...]) -> Frame:
    """One row for each distinct key: keys, then aggregates as written.  Bare
    expressions are their first value; without keys one row; without
    aggregates the distinct keys."""
    names = frame.schema.names
    for k in keys:
        if k not in names:
            raise ColumnNotFound(k)
    by = [F.col(f"`{k}`") for k in keys]
    if not exprs:
        if not keys:
            raise EngineError("a group needs keys or aggregates")
        return Frame(frame.df.select(*by).distinct(), keys)
    exprs = tuple(_aggregated(e) for e in exprs)
    out = [default_name(e, i) for i, e in enumerate(exprs)]
    doubled = {n for n in (*keys, *out) if (*keys, *out).count(n) > 1}
    if doubled:
        raise EngineError(f"two outputs are named {', '.join(sorted(doubled))}: give an alias")
    if any(x.kind == "agg" and x.op in ("first", "last") for e in exprs for x in e.walk()):
        frame = _ranked(frame.named(), keys)
    columns = [lower(e, frame.schema, *_ends(frame))[0].alias(n) for e, n in zip(exprs, out)]
    df = frame.df.groupBy(*by).agg(*columns) if keys else frame.df.agg(*columns)
    return Frame(df, keys if keys else (out[0],))


def _aggregated(e: Expr) -> Expr:
    """A bare expression stands for its first value."""
    inner = e.args[0] if e.kind == "alias" else e
    if inner.has_aggregate():
        if inner.kind not in ("agg",) and any(x.kind == "col" for x in _outside(inner)):
            raise ExprTypeError("a column beside an aggregate: aggregate it too")
        return e
    return inner.first().alias(default_name(e, 0)) if e.kind == "alias" or inner.kind == "col" else inner.first()


def _outside(e: Expr):
    """The nodes of a tree that lie in no aggregate."""
    if e.kind != "agg":
        yield e
        for a in e.args:
            yield from _outside(a)


def _ranked(frame: Frame, keys: tuple[str, ...]) -> Frame:
    """The frame itself, where each of its order's keys can be read backwards.
    Else (descending arrays and structs) each group's rows are numbered, which
    sorts a group in one task."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    if all(not down or _backwards(F.lit(None), kinds[c]) is not None for c, down in frame.order):
        return frame
    number = F.row_number().over(Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*frame.keys()))
    return Frame(frame.df.withColumn("__n", number).drop(ROW).withColumnRenamed("__n", ROW), "row")


def sorted_by(frame: Frame, columns: tuple[str, ...], descending: tuple[bool, ...]) -> Frame:
    """Stable: earlier orders break ties, then the place in the source."""
    for c in columns:
        if c not in frame.schema.names:
            raise ColumnNotFound(c)
    new = tuple(zip(columns, descending))
    return replace(frame, order=new + tuple(o for o in frame.order if o[0] not in columns))


def head(frame: Frame, n: int) -> Frame:
    if isinstance(n, bool) or not isinstance(n, int):
        raise TypeError("head takes an integer")
    if n < 0:
        raise ValueError("head takes no negative number")
    df = _leading(frame, n) if frame.place == "file" and not frame.order else frame.df
    return replace(frame, df=df.orderBy(*frame.keys()).limit(n))


def _leading(frame: Frame, n: int) -> DataFrame:
    """The rows of the first files, by path, that hold ``n`` rows together, so
    that a head without a sort does not read all files.  The files are tried
    now, few first; a single file is not."""
    files = sorted(re.sub("^([^:/]+):///", r"\1:/", f) for f in frame.df.inputFiles())  # as in _metadata
    tried = 1
    while tried < len(files):
        some = frame.df.where(F.col("_metadata.file_path") <= files[tried - 1])
        if some.limit(n).count() >= n:
            return some
        tried *= 4
    return frame.df
