"""Where queries are registered: name -> function of (spark, sf_dir), and SQL for the same rows."""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from nivalis.operators.lineage import shared_folder
from nivalis.plans.fixtures import oracle, view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    """Registers f(each view, in order); ``sql`` gives the same rows from the same views."""

    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[view(spark, sf_dir, v) for v in views])

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = oracle(sql, *[v for v in _NAMED if v in views or re.search(rf"\b{v}\b", sql)])
        return f

    return register


_NAMED = ("station", "grid", "daily", "panel", "code", "strnum", "season", "cube")


def scalar(name: str, source: str, keys: Sequence[str], columns: dict[str, tuple[Callable[[], Column], str]]) -> None:
    """Registers columns computed row by row: name -> (the column, its SQL)."""
    chosen = ", ".join([*keys, *[f"{sql} as {c}" for c, (_, sql) in columns.items()]])

    @query(name, f"select {chosen} from {source}", source)
    def run(df: DataFrame) -> DataFrame:
        return df.select(*keys, *[f().alias(c) for c, (f, _) in columns.items()])


def folder(spark: SparkSession) -> str:
    """A new folder for what a query writes, in the one that the cluster shares."""
    return f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


def with_folder(name: str, sql: str | None = None, *views: str):
    """Registers f(spark, sf_dir, a new folder); ``views`` are those that ``sql`` names."""

    def register(f):
        @functools.wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir, folder(spark))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = oracle(sql, *views)
        return f

    return register
