"""Registry of named queries: a Spark builder plus (optionally) the ANSI SQL
that computes the same result, used as an independent oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]  # inventory ids the query exercises
    bench: bool = False


_REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ops: tuple[str, ...] = (),
          bench: bool = False):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _REGISTRY:
            raise ValueError(f"duplicate query {name}")
        _REGISTRY[name] = Query(name, fn, sql, tuple(ops), bench)
        return fn
    return deco


def all_queries() -> dict[str, Query]:
    # import for side effect: every catalog module registers its queries
    from oreflow.plans import catalog  # noqa: F401
    return dict(_REGISTRY)
