"""What has to be written to turn one version of a grid into another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.functions.address import range_address
from gridframe.sources.schemas import ROW_KEYS, SHEET_KEYS

CELLS = "array<string>"


def changed_blocks(old: DataFrame, new: DataFrame, rows_per_block: int = 500) -> DataFrame:
    """Rectangles of cells that turn the grid ``old`` into ``new`` when they are written into it.

    ``workbook_id, sheet_id, sheet_title, place, row, col, end_row, end_col, range,
    values``: bounds are 0-based and half-open, ``values`` are the cells of ``new``.
    Side by side changes of a row are one span, and equal spans of consecutive
    rows one block. Blocks end where a multiple of ``rows_per_block`` begins, which
    bounds a block and spreads a tall sheet. No two overlap, so they may be
    written in any order (``overlay_blocks`` takes them as they are; ``place`` is 0).

    Only cells count: a null, a blank and a cell beyond a row's end are equal, so
    what ``new`` lacks is written blank, and rows that differ in trailing blanks
    alone do not appear. The title is the one the sheet has in ``old``, or in
    ``new`` where it has no row there. Unchanged rows go no further than the join
    by row position; changed ones are not exploded into cells.
    """
    if rows_per_block < 1:
        raise ValueError("rows_per_block must be at least 1")
    before = old.select(*ROW_KEYS, F.col("sheet_title").alias("__title"), F.col("cells").alias("__old"))
    joined = new.select(*ROW_KEYS, "sheet_title", "cells").join(before, ROW_KEYS, "full_outer")
    empty = F.array().cast(CELLS)
    cells, was = F.coalesce("cells", empty), F.coalesce("__old", empty)
    width = F.greatest(F.size(cells), F.size(was))
    differs = F.transform(F.array_repeat(F.lit(0), width), lambda _, i: _cell(cells, i) != _cell(was, i))
    rows = joined.filter(~cells.eqNullSafe(was)).withColumn("__differs", differs)

    def changed(i: Column) -> Column:
        return F.coalesce(F.get("__differs", i), F.lit(False))

    places = F.transform("__differs", lambda _, i: i)
    starts = F.filter(places, lambda i: changed(i) & ~changed(i - 1))
    ends = F.filter(places, lambda i: changed(i) & ~changed(i + 1))
    rows = rows.withColumn("__starts", starts).withColumn("__ends", ends)
    spans = F.transform("__starts", lambda start, k: F.struct(start.alias("col"), (F.get("__ends", k) + 1).alias("end_col")))
    lines = rows.select(*ROW_KEYS, "sheet_title", "__title", cells.alias("cells"), F.explode(spans).alias("span")).select("*", "span.*")
    values = F.transform(F.sequence(F.col("col"), F.col("end_col") - 1), lambda i: _cell(F.col("cells"), i))

    chunk = F.call_function("div", F.col("row_idx"), F.lit(rows_per_block))
    alike = [*SHEET_KEYS, "__chunk", "col", "end_col"]
    lines = lines.withColumn("cells", values).withColumn("__chunk", chunk)
    island = F.col("row_idx") - F.row_number().over(Window.partitionBy(*alike).orderBy("row_idx"))
    blocks = lines.withColumn("__island", island).groupBy(*alike, "__island").agg(
        F.coalesce(F.max("__title"), F.max("sheet_title")).alias("sheet_title"),
        F.min("row_idx").alias("row"),
        (F.max("row_idx") + 1).alias("end_row"),
        F.array_sort(F.collect_list(F.struct("row_idx", "cells"))).alias("lines"),
    )
    return blocks.select(
        *SHEET_KEYS,
        "sheet_title",
        F.lit(0).alias("place"),
        "row",
        "col",
        "end_row",
        "end_col",
        range_address(F.coalesce("sheet_title", F.lit("")), F.col("row"), F.col("col"), quote=True).alias("range"),
        F.col("lines.cells").alias("values"),
    )


def _cell(cells: Column, i: Column) -> Column:
    """A cell of a row; blank where it is null or beyond the row's end."""
    return F.coalesce(F.get(cells, i), F.lit(""))
