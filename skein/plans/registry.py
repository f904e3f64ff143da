"""Registry of named queries and their independent DuckDB oracle SQL.

A registered query is `fn(spark, sf_dir) -> DataFrame`: it derives the
stand-in tables from `sf_dir` (see `fixtures.py`) and calls library
operators.  The oracle is plain SQL over the same parquet tables; it shares
no code with the Spark side except the stand-in view text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLE[key] = oracle
        return fn
    return deco
