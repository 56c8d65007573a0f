"""Tables: named columns over a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from .errors import ColumnNotFound
from .functions.expr import Expr
from .operators.frame import Frame
from .plans.query import GroupBy, Query
from .series import Series


class Table:
    def __init__(self, context, frame: Frame):
        self._context, self._frame = context, frame

    @property
    def n_rows(self) -> int:
        self._context.check()
        return self._frame.df.count()

    @property
    def n_cols(self) -> int:
        return len(self.columns)

    @property
    def columns(self) -> list[str]:
        return self._frame.schema.names

    @property
    def dtypes(self) -> dict[str, str]:
        from .series import dtype_of

        return {f.name: dtype_of(f.dataType) for f in self._frame.schema.fields}

    def col(self, name: str) -> Series:
        """A column's values, in the table's order."""
        self._context.check()
        if not isinstance(name, str):
            raise TypeError("a column's name is a string")
        if name not in self.columns:
            raise ColumnNotFound(name)
        values = self._frame.result().select(f"`{name}`").toArrow().column(0).combine_chunks()
        return Series(name, self._frame.schema[name].dataType, values)

    def to_df(self) -> DataFrame:
        return self.query().to_df()

    def query(self) -> Query:
        """A query without steps."""
        return Query(self._context, self._frame)

    def filter(self, predicate: Expr) -> Query:
        return self.query().filter(predicate)

    def group_by(self, *keys: str) -> GroupBy:
        return self.query().group_by(*keys)

    def sort(self, *columns: str, descending: bool | Sequence[bool] = False) -> Query:
        return self.query().sort(*columns, descending=descending)

    def head(self, n: int) -> Query:
        return self.query().head(n)
