"""Grids stored by sheet and chunk of rows, refreshed where they lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.operators.extent import checkpoint_once
from gridframe.operators.sheets import is_sheet
from gridframe.plans.refresh import refresh
from gridframe.sources.schemas import GRID

# Row positions of one chunk, which is one folder of one file.
CHUNK_ROWS = 100_000
FOLDERS = ["workbook_id", "sheet_id", "chunk"]
STORED = T.StructType([f for f in GRID if f.name not in FOLDERS] + [T.StructField("hidden", T.BooleanType()), T.StructField("chunk_rows", T.LongType())])
PLACED = T.StructType([*STORED.fields, *[T.StructField(name, T.StringType()) for name in FOLDERS[:2]], T.StructField("chunk", T.LongType())])


def _chunk(row_idx: Column | int, chunk_rows: int) -> Column:
    return F.call_function("div", F.lit(row_idx) if isinstance(row_idx, int) else row_idx, F.lit(chunk_rows).cast("bigint"))


def _write(grid: DataFrame, path: str, chunk_rows: int, mode: str) -> None:
    hidden = F.col("hidden") if "hidden" in grid.columns else F.lit(False)
    placed = grid.select(*GRID.names, hidden.alias("hidden"), F.lit(chunk_rows).cast("bigint").alias("chunk_rows"), _chunk(F.col("row_idx"), chunk_rows).alias("chunk"))
    ordered = placed.repartition(*FOLDERS).sortWithinPartitions(*FOLDERS, "row_idx")
    ordered.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*FOLDERS).parquet(path)


def store_grid(grid: DataFrame, path: str, chunk_rows: int = CHUNK_ROWS) -> None:
    """Store a grid for refreshes in place: a folder for each sheet and chunk of row positions."""
    _write(grid, path, chunk_rows, "errorifexists")


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A grid stored by :func:`store_grid`, ``hidden`` included; filters on ids and rows skip folders and files."""
    stored = _placed(spark, path)
    return stored.select(*GRID.names, "hidden")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    # An empty id has no folder name of its own.
    ids = {name: F.coalesce(name, F.lit("")) for name in FOLDERS[:2]}
    return spark.read.schema(PLACED).parquet(path).withColumns(ids)


def refresh_stored(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    workbook_id: str,
    sheet_name_or_id: str | int,
    row_number_to_push_into: int,
    column_letter_to_push_into: str,
    order_by: Sequence[str],
    sheets: DataFrame | None = None,
    col_count: int | None = None,
    create: bool = False,
    do_not_clear_entire_target_sheet_range: bool = False,
    starting_row_filter_index: int | None = None,
    **refresh_options,
) -> None:
    """:func:`refresh` of a sheet stored by :func:`store_grid`; only chunks that it changes are read and written.

    These are the chunks from the header row on, up to the end of the new
    content if only its rectangle is cleared, from the first row of the filter
    on, and those with hidden rows, which are shown again. Other chunks and other
    sheets keep their files. What is written is computed and stored first, so a
    lost executor never leaves a chunk half read; chunks are replaced when the
    whole job commits. One writer at a time.
    """
    stored, is_target = _placed(spark, path), (F.col("workbook_id") == workbook_id) & is_sheet(sheet_name_or_id)
    sheet = stored.filter(is_target)
    first = sheet.select("workbook_id", "sheet_id", "sheet_title", "chunk_rows").head()
    chunk_rows = (first or stored.select("chunk_rows").head() or [CHUNK_ROWS])[-1]
    if first is not None:
        sheet = stored.filter((F.col("workbook_id") == workbook_id) & (F.col("sheet_id") == first.sheet_id))
    listed = sheets.filter(is_target).select("col_count").head() if sheets is not None else None
    if first is not None and listed is None:
        kind = "workbook_id string, sheet_id string, sheet_title string, row_count int, col_count int"
        sheets = spark.createDataFrame([(workbook_id, first.sheet_id, first.sheet_title, None, col_count)], kind)
    if starting_row_filter_index is not None:
        refresh_options["starting_row_filter_index"] = starting_row_filter_index
    header = row_number_to_push_into - 1
    last = header + 2 + df.count() if do_not_clear_entire_target_sheet_range else None
    within = F.col("chunk") >= _chunk(header, chunk_rows)
    if last is not None:
        within = within & (F.col("chunk") <= _chunk(last, chunk_rows))
    if starting_row_filter_index is not None:
        within = within | (F.col("chunk") >= _chunk(starting_row_filter_index, chunk_rows))
    shown = [row.chunk for row in sheet.filter("hidden").select("chunk").distinct().collect()]
    changed = sheet.filter(within | F.col("chunk").isin(shown)).select(*GRID.names, "hidden")
    new = refresh(
        changed, df, workbook_id, sheet_name_or_id, row_number_to_push_into, column_letter_to_push_into, order_by,
        sheets=sheets, col_count=col_count, create=create,
        do_not_clear_entire_target_sheet_range=do_not_clear_entire_target_sheet_range, **refresh_options,
    )
    _write(checkpoint_once(new), path, chunk_rows, "overwrite")
