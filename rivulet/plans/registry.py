"""Named queries over the test tables, each with its DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame``; its oracle is an
ANSI SQL string over the pre-registered views ``events documents ...``.
Queries without an exact SQL form register ``sql=None``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    operator: str  # SURVEY id(s) it covers


_REGISTRY: dict[str, Query] = {}


def register(name: str, operator: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, operator)
        return fn
    return deco


def _load() -> None:
    # importing the modules fills the registry
    from rivulet.plans import (live_queries, record_queries, source_queries,  # noqa: F401
                               stream_queries, table_queries, topic_queries)


def all_queries() -> dict[str, Query]:
    _load()
    return dict(_REGISTRY)
