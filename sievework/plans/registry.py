"""Where queries and the SQL that each must match are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.plans.tables import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

NOW = "2024-02-01 00:00:00"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL if there is any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def sql_any(column: str, terms: tuple[str, ...]) -> str:
    """DuckDB: whether any term stands in the column."""
    return "(" + " or ".join(f"contains({column}, '{t}')" for t in terms) + ")"


def sql_list(terms: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{t}'" for t in terms) + "]"
