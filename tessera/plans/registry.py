"""Registry of named queries (one per operator of SURVEY §2) and their SQL oracles.

Each query is ``fn(spark, sf_dir) -> DataFrame``.  Results are checked against
an equivalent DuckDB SQL text over the same parquet tables, so outputs use
types both engines render alike: dates as ``yyyy-MM-dd`` strings, decimals as
doubles, no struct or array columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn`` under ``name``; ``sql=None`` marks a rows-only check."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Dates -> ISO strings, decimals -> double; other columns unchanged."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)
