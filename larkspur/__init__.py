"""A columnar analytics engine on Spark DataFrames.

    from larkspur import Context, col

    with Context() as ctx:
        sales = ctx.read_csv("sales.csv")
        top = (
            sales.filter(col("price") > 10)
            .group_by("category")
            .agg(col("price").sum(), col("quantity").mean())
            .sort("price_sum", descending=True)
            .head(5)
            .collect_sync()
        )
"""

from .errors import ColumnNotFound, ContextClosed, EngineError, QueryFailed, ReadFailed
from .functions.expr import Expr, col, lit
from .plans.query import GroupBy, Query
from .series import Series
from .session import Context
from .table import Table

__all__ = ["ColumnNotFound", "Context", "ContextClosed", "EngineError", "Expr", "GroupBy", "Query", "QueryFailed", "ReadFailed", "Series", "Table", "col", "lit"]
