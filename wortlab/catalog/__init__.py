"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame``
per inventory operator, each paired with the DuckDB SQL that computes the
same table from the same parquet files (the correctness oracle).

Doubles are rounded to ``PLACES`` decimals on both sides so that summation
order does not change the value hash."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..session import ensure_ready

PLACES = 9

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` under ``name`` (with its oracle SQL when it has one)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_ready(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def finish(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Round every floating column (oracle comparison is by value hash)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`").cast("double"), places).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def load_all() -> None:
    from . import analytics, loanwords, pages, profiling, incremental, enrichment, streaming, scalars, learned, lexicon  # noqa: F401
