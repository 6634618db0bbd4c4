"""Operators on grid rows: choosing, padding, dropping, header."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.address import parse_range
from gridframe.functions.names import lower_names
from gridframe.operators.extent import BROADCAST_BYTES, attach_facts, checkpoint_once, sheet_extents
from gridframe.sources.schemas import SHEET_KEYS


def is_sheet(key: str | int) -> Column:
    """Predicate for one sheet: an all-digit key is a sheet id, any other a title."""
    key = str(key)
    return F.col("sheet_id" if re.fullmatch(r"[0-9]+", key) else "sheet_title") == key


def select_sheet(grid: DataFrame, key: str | int, workbook_id: str | None = None) -> DataFrame:
    """Rows of the sheet with this id or title, in one workbook or in all."""
    if workbook_id is not None:
        grid = grid.filter(F.col("workbook_id") == workbook_id)
    return grid.filter(is_sheet(key))


def cell_range(grid: DataFrame, a1_range: str | None) -> DataFrame:
    """Only the cells of an A1 range, with positions counted from its corner; ``None`` keeps all."""
    if a1_range is None:
        return grid
    bounds = parse_range(a1_range)
    rows = grid.filter(F.col("row_idx") >= bounds.row0)
    if bounds.row1 is not None:
        rows = rows.filter(F.col("row_idx") < bounds.row1)
    columns = F.size("cells") if bounds.col1 is None else F.lit(bounds.col1 - bounds.col0)
    return rows.withColumn("cells", F.slice("cells", bounds.col0 + 1, columns)).withColumn(
        "row_idx", F.col("row_idx") - bounds.row0
    )


def padded(cells: Column, width: Column) -> Column:
    """Cells with nulls blank and missing trailing cells added up to ``width``."""
    filled = F.transform(cells, lambda cell: F.coalesce(cell, F.lit("")))
    return F.concat(filled, F.array_repeat(F.lit(""), F.greatest(width - F.size(cells), F.lit(0))))


def pad_rows(grid: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every row as wide as its sheet's widest row, nulls blank."""
    extents = checkpoint_once(sheet_extents(grid))
    rows = attach_facts(grid, extents, broadcast_bytes).withColumn("cells", padded(F.col("cells"), F.col("width")))
    return rows.select(*grid.columns)


def has_content(cells: Column) -> Column:
    """Whether any cell is not empty; spaces, ``0`` and ``FALSE`` are content."""
    return F.exists(cells, lambda cell: F.coalesce(cell, F.lit("")) != "")


def drop_empty_rows(grid: DataFrame) -> DataFrame:
    """Without rows whose cells are all empty."""
    return grid.filter(has_content(F.col("cells")))


def sheet_headers(
    grid: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, content: Column | None = None
) -> DataFrame:
    """Per sheet its extent and, as ``header``, the cells of its first row in lower case.

    With ``content``, a predicate on rows, the first row is the first one where
    it holds; the width is that of all rows. The first position is found by a hash aggregate; only rows at or above the
    latest first position are then read again, a filter that reaches the scan.
    """
    extents = checkpoint_once(sheet_extents(grid, content))
    latest_first = extents.agg(F.max("first_row")).first()[0]
    top = grid.filter(F.col("row_idx") <= F.lit(latest_first).cast("bigint"))
    first_rows = attach_facts(top, extents, broadcast_bytes).filter(F.col("row_idx") == F.col("first_row"))
    return checkpoint_once(
        first_rows.select(*SHEET_KEYS, "first_row", "last_row", "width", lower_names(F.col("cells")).alias("header"))
    )


def promote_header(grid: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """``(header, body)``: the first row of every sheet as names, and the rows below it."""
    headers = sheet_headers(grid, broadcast_bytes)
    body = attach_facts(grid, headers.drop("header"), broadcast_bytes).filter(F.col("row_idx") > F.col("first_row"))
    return headers.select(*SHEET_KEYS, F.col("first_row").alias("row_idx"), "header"), body.select(*grid.columns)


def grid_to_cells(grid: DataFrame) -> DataFrame:
    """One row per cell: ``workbook_id, sheet_id, row_idx, col_idx, value``."""
    return grid.select(*SHEET_KEYS, "row_idx", F.posexplode("cells").alias("col_idx", "value"))
