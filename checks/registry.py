"""Query and SQL side by side under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(sql: str | None = None, name: str | None = None):
    """Register a query under its function's name, with its SQL if it can be put in SQL."""

    def register(query: Query) -> Query:
        key = name or query.__name__
        QUERIES[key] = query
        if sql is not None:
            SQL[key] = sql
        return query

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_grid(df: DataFrame, row_idx: Column | str, cells: Column, sheet_id: Column | str = "0", title: Column | str = "Sheet1") -> DataFrame:
    """Grid rows made from the rows of a table; plain strings are literal ids and titles."""

    def value(v):
        return F.lit(v) if isinstance(v, str) else v

    position = F.col(row_idx) if isinstance(row_idx, str) else row_idx
    return df.select(
        F.lit("wb").alias("workbook_id"),
        value(sheet_id).cast("string").alias("sheet_id"),
        value(title).cast("string").alias("sheet_title"),
        position.cast("bigint").alias("row_idx"),
        cells.cast("array<string>").alias("cells"),
    )


def row_of(spark: SparkSession, row_idx: int, cells: list[str], sheet_id: str = "0", title: str = "Sheet1") -> DataFrame:
    """One fixed grid row, such as a header above a table's rows."""
    return as_grid(spark.range(0, 1, 1, numPartitions=1), F.lit(row_idx), F.array(*[F.lit(c) for c in cells]), sheet_id, title)


def unpivoted(source: str, keys: str, columns: list[str], first_col: int = 0) -> str:
    """SQL for one row per listed column: ``keys, col_idx, value``."""
    return " union all ".join(
        f"select {keys}, {first_col + i}::int as col_idx, {column}::varchar as value from {source}"
        for i, column in enumerate(columns)
    )
