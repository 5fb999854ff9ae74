"""Registry of named queries: Spark callables and their DuckDB oracle SQL.

Each ``plans/q_*.py`` module registers ``(spark, sf_dir) -> DataFrame``
callables under the query names of SURVEY section 2, with the matching DuckDB
text when the operator is SQL-expressible.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

MODULES = ("q_ratings", "q_scoring", "q_trace", "q_steps", "q_prepare", "q_sources", "q_prompts",
           "q_generations", "q_streaming")


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(f"treepref.plans.{m}")


def r6(c: Column | str) -> Column:
    """Doubles are compared at 6 decimals on both sides."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
