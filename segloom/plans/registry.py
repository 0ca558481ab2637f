"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from segloom.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
MODULES = ("sources", "scalars", "joins", "rules", "stats", "ranking", "clusters", "segments", "models", "quality")


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(list(views), sql)
        return fn

    return register


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"segloom.plans.{module}_queries")
