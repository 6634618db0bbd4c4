"""Grids as tables and as records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.names import table_name_list
from gridframe.functions.text import quoted
from gridframe.operators.extent import BROADCAST_BYTES, attach_facts, checkpoint_once
from gridframe.operators.naming import settled_names
from gridframe.operators.sheets import has_content, padded, sheet_headers
from gridframe.sources.schemas import SHEET_KEYS


def grid_to_table(grid: DataFrame, make_columns_unique: bool = True, clean_column_names: bool = True) -> DataFrame:
    """One sheet as a wide all-string table named by its first row; a grid of several sheets is an error."""
    return headed_table(grid, F.lit(True), make_columns_unique, clean_column_names)


def headed_table(grid: DataFrame, is_row: Column, make_columns_unique: bool, clean_column_names: bool) -> DataFrame:
    """The rows of one sheet where ``is_row`` holds, below the first of them, as a table named by that one.

    One aggregate finds the width of all rows, the first row and its cells; the
    driver sees that row, since a schema needs it. The table is then a filter and
    a narrow projection over the source, one column per cell. A sheet without
    rows is a table without columns.
    """
    position, key = F.when(is_row, F.col("row_idx")), F.struct(*SHEET_KEYS)
    found = grid.agg(
        F.min(position).alias("first_row"),
        F.min_by("cells", position).alias("header"),
        F.max(F.size("cells")).alias("width"),
        (F.min(key) != F.max(key)).alias("several"),
    ).first()
    if found.several:
        raise ValueError("the grid holds several sheets; select one")
    if found.first_row is None:
        return grid.select().limit(0)
    header_cells = found.header or []
    header = [(cell or "").lower() for cell in header_cells] + [""] * (found.width - len(header_cells))
    names = table_name_list(header, make_columns_unique, clean_column_names)
    cells = [f"coalesce(get(cells, {i}), '') as {quoted(name)}" for i, name in enumerate(names)]
    return grid.filter(is_row & (F.col("row_idx") > found.first_row)).selectExpr(*cells)


def grid_to_records(
    grid: DataFrame,
    make_columns_unique: bool = True,
    clean_column_names: bool = True,
    drop_empty_rows: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every row below its sheet's header as a ``record`` map, for many sheets with differing headers.

    With ``drop_empty_rows`` the result is that of padding, dropping and then
    taking records, but one pass finds both the widths and the header rows.
    """
    content = has_content(F.col("cells")) if drop_empty_rows else None
    headers = sheet_headers(grid, broadcast_bytes, content)
    # Names are repaired once per sheet here, not once per row after the join.
    headers = headers.withColumn("header", padded(F.col("header"), F.col("width")))
    headers = checkpoint_once(settled_names(headers, make_columns_unique, clean_column_names))
    if content is not None:
        grid = grid.filter(content)
    rows = attach_facts(grid, headers, broadcast_bytes).filter(F.col("row_idx") > F.col("first_row"))
    record = F.map_from_arrays("header", padded(F.col("cells"), F.col("width")))
    return rows.select(*SHEET_KEYS, "row_idx", record.alias("record"))
