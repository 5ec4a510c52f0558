"""Queries of the survey operators over the given tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixed(c: Column | str, digits: int = 6) -> Column:
    """Rounded the same way in both engines."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 10.0**digits + 0.5).cast("double") / 10.0**digits


def fixed_all(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: fixed(n, digits) for n in names})


def r(c: str, digits: int = 6) -> str:
    """``fixed`` in SQL."""
    return f"floor(({c}) * 1e{digits} + 0.5) / 1e{digits}"
