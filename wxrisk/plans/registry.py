"""Registry of queries: each Spark plan next to the SQL that checks it.

A query function takes (spark, folder) and returns a DataFrame. For comparison
times and dates become text and doubles are rounded to six places, on both sides
in the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wxrisk.functions.scalar import steady

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def presented(df: DataFrame) -> DataFrame:
    def shown(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind == "double":
            return (steady(column, 6, 4) + F.lit(0.0)).alias(name)
        if kind.startswith("timestamp"):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)
        if kind == "date":
            return F.date_format(column, "yyyy-MM-dd").alias(name)
        return column

    return df.select(*[shown(n, k) for n, k in df.dtypes])


def _presented_sql(sql: str, doubles: str, times: str, days: str) -> str:
    changes = [f'{steady_sql(chr(34) + c + chr(34), 6, 4)} + 0.0e0 as "{c}"' for c in doubles.split()]
    changes += [f"strftime(\"{c}\", '%Y-%m-%d %H:%M:%S.%f') as \"{c}\"" for c in times.split()]
    changes += [f"strftime(\"{c}\", '%Y-%m-%d') as \"{c}\"" for c in days.split()]
    if not changes:
        return sql
    return f"select * replace ({', '.join(changes)}) from ({sql}) as answer"


def query(sql: str | None = None, *, doubles: str = "", times: str = "", days: str = "",
          name: str | None = None) -> Callable[[Query], Query]:
    """Registers the function under its name; ``sql`` is its check, with the columns to present."""
    def add(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(fn(spark, sf_dir))

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = _presented_sql(sql.strip(), doubles, times, days)
        return fn

    return add


def steady_sql(value: str, digits: int, guard: int = 6) -> str:
    """Decimal rounding, half away from zero, after removing floating-point noise."""
    return f"cast(round(cast({value} as decimal(38, {digits + guard})), {digits}) as double)"


def plain_round_sql(value: str, digits: int) -> str:
    """Decimal rounding of a double as it prints, half away from zero."""
    return f"cast(round(cast(cast({value} as varchar) as decimal(38, 20)), {digits}) as double)"
