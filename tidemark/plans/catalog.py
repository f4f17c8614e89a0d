"""Registered queries: name -> (spark builder, oracle SQL or None).

Every builder takes ``(spark, sf_dir)``, reads the given tables and returns a
DataFrame whose column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tidemark.plans import queries_eval, queries_grid, queries_models, queries_monitoring, queries_perturb, queries_reports, queries_stream, queries_tables  # noqa: F401
