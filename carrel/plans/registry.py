"""Collects the proof queries of every query module under their names."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

MODULES = ["mapping", "votes", "fixes", "matching", "reading", "searching", "claiming", "checking", "repairing"]


class Book:
    """Queries of a module with their SQL; ``@book.query(sql)`` adds one under its function's name."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql is not None:
                self.sql[f.__name__] = sql
            return f

        return add


def _books() -> list[Book]:
    return [import_module(f"carrel.plans.{name}").book for name in MODULES]


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for book in _books():
        found |= book.queries
    return found


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    for book in _books():
        found |= book.sql
    return found
