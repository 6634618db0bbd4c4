"""Values bodies as grid rows, and stored grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.functions.address import address_cells, address_title, col_number
from gridframe.sources.schemas import GRID, ROW_KEYS, VALUES_BODY, VALUES_RECORD


def read_values(spark: SparkSession, path: str | list[str], positions: str = "body", multi_line: bool = False) -> DataFrame:
    """Grid rows of saved values responses, one JSON record per body.

    Records may carry ``workbook_id``, ``sheet_id`` and ``sheet_title`` beside
    the response fields; a missing title comes from ``range``.
    """
    bodies = spark.read.schema(VALUES_RECORD).options(multiLine=multi_line, mode="FAILFAST").json(path)
    return values_to_grid(bodies, positions=positions)


def values_to_grid(df: DataFrame, body_col: str | None = None, positions: str = "body") -> DataFrame:
    """One grid row per sheet row of each values body.

    ``body_col`` names a JSON string column; without it the body's fields are
    columns of ``df``. A body without values gives no rows; one that is not valid
    JSON is an error, never a silent loss. ``positions="body"``
    counts rows from the body's start; ``positions="range"`` places them where
    the body's range starts, so one tall sheet may come in many bodies. A body
    saved by columns is turned over.
    """
    if positions not in ("body", "range"):
        raise ValueError("positions is 'body' or 'range'")
    if body_col is not None:
        df = df.withColumn("__body", F.from_json(F.col(body_col), VALUES_BODY, {"mode": "FAILFAST"})).select(
            *[c for c in ("workbook_id", "sheet_id", "sheet_title") if c in df.columns], "__body.*"
        )
    title, values = address_title(F.col("range")), F.col("values")
    if "majorDimension" in df.columns:
        values = F.when(F.upper("majorDimension") == "COLUMNS", _transposed(values)).otherwise(values)
    rows = df.select(
        _column_or(df, "workbook_id", F.lit("")),
        _column_or(df, "sheet_id", F.lit("")),
        _column_or(df, "sheet_title", title),
        F.col("range"),
        F.posexplode(values).alias("position", "row"),
    )
    row_idx, cells = placed_row(F.col("range"), F.col("position").cast("bigint"), F.coalesce("row", F.array().cast("array<string>")), positions)
    return rows.select("workbook_id", "sheet_id", "sheet_title", row_idx.alias("row_idx"), cells.alias("cells"))


def placed_row(address: Column, row_idx: Column, cells: Column, positions: str) -> tuple[Column, Column]:
    """Position and cells of a body's row; by range, from the cell on where the body's range starts."""
    if positions == "body":
        return row_idx, cells
    # Where the range names a start cell; a bare title starts at A1.
    start, at = r"^\$?([A-Za-z]*)\$?(\d*)", address_cells(address)
    first_row = F.greatest(F.coalesce(F.regexp_extract(at, start, 2).try_cast("bigint") - 1, F.lit(0)), F.lit(0))
    first_col = F.greatest(col_number(F.coalesce(F.regexp_extract(at, start, 1), F.lit(""))) - 1, F.lit(0)).cast("int")
    return row_idx + first_row, F.when(F.size(cells) > 0, F.concat(F.array_repeat(F.lit(""), first_col), cells)).otherwise(cells)


def _transposed(columns: Column) -> Column:
    """Rows of a body saved by columns; the end of a short column reads as blank cells."""
    height = F.coalesce(F.array_max(F.transform(columns, lambda c: F.coalesce(F.size(c), F.lit(0)))), F.lit(0))
    rows = F.when(height > 0, F.sequence(F.lit(0), height - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(rows, lambda i: F.transform(columns, lambda c: F.coalesce(F.get(c, i), F.lit(""))))


def read_grid(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """A stored grid, with ``hidden`` if it was stored with it."""
    stored = spark.read.option("mergeSchema", "true").parquet(path)
    return stored.select(*GRID.names, *[c for c in ("hidden",) if c in stored.columns])


def write_grid(grid: DataFrame, path: str, mode: str = "errorifexists", files: int | None = None, rows_per_file: int = 1_000_000) -> None:
    """Store a grid clustered by sheet and row, ``hidden`` included.

    Range clustering splits a tall sheet over files and lets a read of one
    sheet, or of some of its rows, skip the others by Parquet statistics. There
    are ``files`` ranges, or as many as hold ``rows_per_file`` rows each, which
    is also the most one file gets.
    """
    kept = grid.select(*GRID.names, *[c for c in ("hidden",) if c in grid.columns])
    ranges = files or max(1, -(-kept.count() // rows_per_file))
    ordered = kept.repartitionByRange(ranges, *ROW_KEYS).sortWithinPartitions(*ROW_KEYS)
    ordered.write.mode(mode).option("maxRecordsPerFile", rows_per_file).parquet(path)


def _column_or(df: DataFrame, name: str, default: Column) -> Column:
    return (F.coalesce(F.col(name).cast("string"), default) if name in df.columns else default).alias(name)
