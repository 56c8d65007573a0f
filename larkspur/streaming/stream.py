"""Filter and group over a streaming DataFrame, with the engine's expressions.

An extension: there is no order in a stream, so sort, head, first and last have
no meaning here and are not offered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import ExprTypeError
from ..functions.expr import Expr
from ..functions.lower import default_name, lower


def filtered(stream: DataFrame, predicate: Expr) -> DataFrame:
    c, kind = lower(predicate, stream.schema)
    if kind != "bool":
        raise ExprTypeError(f"a filter takes bool, not {kind}")
    return stream.filter(c)


def grouped(stream: DataFrame, keys: list[str], exprs: list[Expr], time_col: str | None = None, window: str | None = None, late: str = "0 seconds") -> DataFrame:
    """Aggregates by key and, with ``time_col`` and ``window``, by tumbling
    window; rows later than ``late`` behind the watermark are not counted."""

    def no_order(_):
        raise ExprTypeError("a stream has no first or last row")

    columns = [lower(e, stream.schema, no_order, no_order)[0].alias(default_name(e, i)) for i, e in enumerate(exprs)]
    by = [F.col(f"`{k}`") for k in keys]
    if time_col and window:
        stream = stream.withWatermark(time_col, late)
        by.insert(0, F.window(F.col(f"`{time_col}`"), window).alias("window"))
    return stream.groupBy(*by).agg(*columns)
