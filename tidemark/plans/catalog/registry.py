"""Registered queries, each with the SQL text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


# Means of prices in cents often end exactly halfway between two rounded values,
# where the last bit of the sum would choose the direction. Both sides add the
# same small constant first.
NUDGE = 0.00123


def rounded(df: DataFrame, places: dict[int, Sequence[str]]) -> DataFrame:
    """Round columns whose last digits depend on the order of summation."""
    digits = {c: n for n, columns in places.items() for c in columns}

    def shown(c: str) -> Column:
        return F.round(F.col(c) + NUDGE * 10.0 ** -digits[c], digits[c]).alias(c)

    return df.select(*[shown(c) if c in digits else F.col(c) for c in df.columns])


def sql_round(value: str, places: int, name: str) -> str:
    """The same in SQL; adding zero turns -0.0 into 0.0."""
    return f"round({value} + CAST({NUDGE * 10.0 ** -places!r} AS DOUBLE), {places}) + CAST(0 AS DOUBLE) AS {name}"


def rounding(places: dict[int, Sequence[str]], columns: Sequence[str]) -> str:
    """A SQL select list with some columns rounded."""
    digits = {c: n for n, names in places.items() for c in names}
    return ", ".join(sql_round(c, digits[c], c) if c in digits else c for c in columns)


def rounded_sql(inner: str, places: dict[int, Sequence[str]], columns: Sequence[str]) -> str:
    return f"SELECT {rounding(places, columns)} FROM ({inner})"
