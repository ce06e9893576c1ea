"""Where the plan modules put their queries and oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, make: Callable[[Views], DataFrame], sql: str | None = None) -> None:
    """make: Views -> DataFrame.  sql: the same rows in DuckDB, if SQL has them."""
    QUERIES[name] = lambda spark, sf_dir: make(Views(spark, sf_dir))
    if sql:
        ORACLE[name] = sql


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at a fixed number of digits, so that the order of sums does not show."""
    return df.select(*[F.round(F.col(f"`{c}`"), digits).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])
