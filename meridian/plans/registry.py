"""Registered queries: each Spark plan beside an independent SQL text for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.sources.fixtures import duckdb_sql, fixture

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, **fixtures: str):
    """Register f(fixture frames...) under its name; sql gives the same rows in DuckDB."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(**{k: fixture(spark, sf_dir, v) for k, v in fixtures.items()})

        QUERIES[f.__name__] = run
        if sql:
            ORACLES[f.__name__] = duckdb_sql(sql)
        return f

    return add


#: Added before rounding, in thousandths of the last digit: table values have few decimals, so many sit on a rounding
#: tie, which the engines break differently; none sits on this.
NUDGE = 3.7


def off_ties(x: Column, digits: int) -> Column:
    """x rounded, off the ties and without a negative zero."""
    return F.round(x + F.lit(NUDGE * 10.0 ** -(digits + 3)), digits) + F.lit(0.0)


def rounded(df: DataFrame, digits: int = 6, **other: int) -> DataFrame:
    """Doubles rounded by off_ties(); other: columns with digits of their own."""
    return df.select(*(off_ties(F.col(c), other.get(c, digits)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def R(expression: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"(round({expression} + {NUDGE * 10.0 ** -(digits + 3)!r}::DOUBLE, {digits}) + 0.0e0)"


def col(name: str) -> Column:
    return F.col(name)
