"""Errors of the engine; each has a ``code``."""

from __future__ import annotations


class EngineError(Exception):
    code = "engine"


class ContextClosed(EngineError, RuntimeError):
    code = "closed"

    def __init__(self):
        super().__init__("Context has been destroyed")


class ColumnNotFound(EngineError, KeyError):
    code = "column"

    def __init__(self, name: str):
        super().__init__(f"Column not found: {name}")

    def __str__(self) -> str:
        return self.args[0]


class ReadFailed(EngineError):
    code = "read"


class QueryFailed(EngineError):
    code = "query"

    def __init__(self, why: object):
        super().__init__(f"Query execution failed: {why}")


class ExprTypeError(EngineError, TypeError):
    code = "type"
