"""Read one sheet as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.operators import sheets
from gridframe.operators.tables import headed_table
from gridframe.sources.values import read_values


def read_sheet(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    workbook_id: str,
    sheet_id: str,
    make_columns_unique: bool = True,
    clean_column_names: bool = True,
    drop_empty_rows: bool = True,
    cell_range: str | None = None,
    temp_view_name: str | None = None,
) -> DataFrame:
    """One sheet as an all-string table, optionally under a view name.

    ``source`` is a grid or the path of saved values responses; ``sheet_id`` is
    the sheet's id or title. One small action finds the extent of the sheet and
    its header; the table itself is then a filter and a projection over the
    source, without a shuffle. The source is read twice in all.
    """
    grid = source if isinstance(source, DataFrame) else read_values(spark, source)
    grid = sheets.cell_range(sheets.select_sheet(grid, sheet_id, workbook_id), cell_range)
    # Dropped rows still count for the width, as all rows are padded before.
    is_row = sheets.has_content(F.col("cells")) if drop_empty_rows else F.lit(True)
    table = headed_table(grid, is_row, make_columns_unique, clean_column_names)
    if temp_view_name:
        table.createOrReplaceTempView(temp_view_name)
    return table
