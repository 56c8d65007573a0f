"""The fluent query.  A query never changes: each step returns a new one, and
each step sees the result of the step before."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import Future
from typing import TYPE_CHECKING

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from ..errors import QueryFailed
from ..functions.expr import Expr, wrapped
from ..operators import frame as ops

if TYPE_CHECKING:
    from ..session import Context
    from ..table import Table


class Query:
    def __init__(self, context: Context, frame: ops.Frame):
        self._context, self._frame = context, frame

    def _next(self, step, *args) -> Query:
        self._context.check()
        try:
            return Query(self._context, step(self._frame, *args))
        except PySparkException as e:
            raise QueryFailed(e) from e

    def filter(self, predicate: Expr) -> Query:
        """Rows for which the predicate is true; null counts as false."""
        return self._next(ops.filtered, wrapped(predicate))

    def group_by(self, *keys: str) -> GroupBy:
        if not all(isinstance(k, str) for k in keys):
            raise TypeError("group_by takes names of columns")
        return GroupBy(self, keys)

    def sort(self, *columns: str, descending: bool | Sequence[bool] = False) -> Query:
        """Stable sort by one or more columns; nulls are the least values."""
        if not columns or not all(isinstance(c, str) for c in columns):
            raise TypeError("sort takes names of columns")
        down = (descending,) * len(columns) if isinstance(descending, bool) else tuple(descending)
        if len(down) != len(columns):
            raise ValueError("descending has as many values as there are columns")
        return self._next(ops.sorted_by, columns, down)

    def head(self, n: int) -> Query:
        """The first ``n`` rows: by the sort, else in the source's order."""
        return self._next(ops.head, n)

    def to_df(self) -> DataFrame:
        """The plan as a DataFrame, not run yet."""
        self._context.check()
        return self._frame.result()

    def explain(self, mode: str = "formatted") -> None:
        self.to_df().explain(mode)

    def collect_sync(self, cache: bool = False) -> Table:
        """The result as a table.  Spark runs it when its rows are asked for;
        with ``cache`` it runs once, now."""
        from ..table import Table

        self._context.check()
        try:
            frame = self._frame
            if cache:
                frame = ops.replace(frame.named(), df=frame.named().df.cache())
                frame.df.count()
            return Table(self._context, frame)
        except PySparkException as e:
            raise QueryFailed(e) from e

    def collect(self) -> Future[Table]:
        """The same on another thread, run at once."""
        self._context.check()
        return self._context.submit(self.collect_sync, True)


class GroupBy:
    def __init__(self, query: Query, keys: tuple[str, ...]):
        self._query, self._keys = query, keys

    def agg(self, *exprs: Expr) -> Query:
        """Keys, then the aggregates as written."""
        if not all(isinstance(e, Expr) for e in exprs):
            raise TypeError("agg takes expressions")
        return self._query._next(ops.grouped, self._keys, exprs)
