"""Regions of a grid: clear, overlay, filter, write batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.address import range_address
from gridframe.operators.extent import BROADCAST_BYTES, checkpoint_once, measured_bytes
from gridframe.sources.schemas import ROW_KEYS, SHEET_KEYS

EMPTY_ROW = "array<string>"


def cleared(cells: Column, col: int, end_col: Column | int | None) -> Column:
    """Cells with columns ``[col, end_col)`` blank; ``None`` clears to the end."""

    def keep_or_blank(cell: Column, i: Column) -> Column:
        inside = i >= col
        if end_col is not None:
            inside = inside & (i < end_col)
        return F.when(inside, F.lit("")).otherwise(cell)

    return F.transform(cells, keep_or_blank)


def spliced(cells: Column, block: Column, col: Column | int) -> Column:
    """Cells with ``block`` written from ``col`` on; a gap before it is filled with blanks."""
    col = F.lit(col) if isinstance(col, int) else col
    end = col + F.size(block)
    return F.concat(
        F.slice(cells, F.lit(1), col),
        F.array_repeat(F.lit(""), F.greatest(col - F.size(cells), F.lit(0))),
        block,
        F.slice(cells, end + 1, F.greatest(F.size(cells) - end, F.lit(0))),
    )


def clear_region(grid: DataFrame, row: int, col: int, end_col: int | None = None, end_row: int | None = None) -> DataFrame:
    """Blank the cells of rows ``[row, end_row)`` and columns ``[col, end_col)``, 0-based; ``None`` is an open end."""
    inside = F.col("row_idx") >= row
    if end_row is not None:
        inside = inside & (F.col("row_idx") < end_row)
    return grid.withColumn("cells", F.when(inside, cleared(F.col("cells"), col, end_col)).otherwise(F.col("cells")))


def overlay(grid: DataFrame, payload: DataFrame, row: int, col: int) -> DataFrame:
    """Write ``payload``, a grid, into the sheets of ``grid`` from cell ``(row, col)``, 0-based.

    Written cells replace, all others stay; a sheet grows in rows and columns as
    needed. The join key holds the row position, so a tall sheet is spread.
    """
    block = payload.select(
        *SHEET_KEYS,
        (F.col("row_idx") + row).alias("row_idx"),
        F.col("sheet_title").alias("__title"),
        F.col("cells").alias("__block"),
    )
    joined = grid.join(block, ROW_KEYS, "full_outer")
    cells = F.coalesce("cells", F.array().cast(EMPTY_ROW))
    written = joined.withColumn(
        "cells", F.when(F.col("__block").isNull(), F.col("cells")).otherwise(spliced(cells, F.col("__block"), col))
    ).withColumn("sheet_title", F.coalesce("sheet_title", "__title"))
    if "hidden" in grid.columns:
        written = written.withColumn("hidden", F.coalesce("hidden", F.lit(False)))
    return written.select(*grid.columns)


def overlay_blocks(grid: DataFrame, blocks: DataFrame) -> DataFrame:
    """Write many blocks in one pass, as if one after the other: of several on a cell the last wins.

    A block is a row of ``blocks``: ``workbook_id, sheet_id, place`` (its turn),
    ``row, col`` (where its first cell goes, 0-based) and ``values``, rows of
    cells, which may differ in length. Blocks of one sheet with equal places go
    by row, column and values. A sheet that has no rows yet gets the title null,
    or that in ``sheet_title`` if ``blocks`` has it. What meets in a group are
    the pieces of one sheet row; null rows of a block write nothing.
    """
    title = F.col("sheet_title") if "sheet_title" in blocks.columns else F.lit(None).cast("string")
    lines = blocks.select(*SHEET_KEYS, title.alias("__title"), "place", F.col("row").cast("bigint").alias("row"), F.col("col").cast("int").alias("col"), F.posexplode("values").alias("no", "cells"))
    piece = F.struct("place", "row", "col", F.col("cells").cast(EMPTY_ROW).alias("cells"))
    rows = lines.filter(F.col("cells").isNotNull()).groupBy(*SHEET_KEYS, (F.col("row") + F.col("no")).alias("row_idx"))
    pieces = rows.agg(F.max("__title").alias("__title"), F.array_sort(F.collect_list(piece)).alias("__pieces"))
    joined = grid.join(pieces, ROW_KEYS, "full_outer")
    empty = F.array().cast(EMPTY_ROW)
    cells = F.aggregate(F.coalesce("__pieces", F.array().cast(pieces.schema["__pieces"].dataType)), F.coalesce("cells", empty), lambda done, piece: spliced(done, piece["cells"], piece["col"]))
    written = joined.withColumn("cells", cells).withColumn("sheet_title", F.coalesce("sheet_title", "__title"))
    if "hidden" in grid.columns:
        written = written.withColumn("hidden", F.coalesce("hidden", F.lit(False)))
    return written.select(*grid.columns)


def remove_filter(grid: DataFrame) -> DataFrame:
    """All rows visible."""
    return grid.withColumn("hidden", F.lit(False))


def apply_filter(
    grid: DataFrame, filter_col: int = 0, start_row: int = 0, start_col: int = 0, exclude: str = ""
) -> DataFrame:
    """Hide rows below ``start_row`` whose cell in column ``filter_col`` is exactly ``exclude``.

    ``start_row`` is the filter's own header. ``filter_col`` counts from the
    sheet's first column; ``start_col`` is where the filter's range begins and
    hides nothing by itself.
    """
    if start_col < 0 or filter_col < 0 or start_row < 0:
        raise ValueError("filter positions are 0-based")
    before = F.col("hidden") if "hidden" in grid.columns else F.lit(False)
    cell = F.coalesce(F.get("cells", F.lit(filter_col)), F.lit(""))
    return grid.withColumn("hidden", F.when(F.col("row_idx") > start_row, cell == exclude).otherwise(before))


def apply_criteria(grid: DataFrame, criteria: DataFrame, start_row: int = 0, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hide rows below ``start_row`` that have a hidden value in any filtered column of their sheet.

    ``criteria`` lists ``workbook_id, sheet_id, column`` (0-based) ``, value``,
    any number of values for a column; a cell that is null or beyond the row's
    end counts as empty, as does a null value. Rows of sheets without criteria,
    and rows down to ``start_row``, stay as they are. Each filtered column is one
    hash join on sheet and cell, so rows are neither exploded nor scanned value
    by value; values that measure small are broadcast.
    """
    if start_row < 0:
        raise ValueError("filter positions are 0-based")
    wanted = checkpoint_once(criteria.select(*SHEET_KEYS, F.col("column").cast("int").alias("column"), F.coalesce("value", F.lit("")).alias("__value")).distinct())
    small = measured_bytes(wanted) <= broadcast_bytes
    before = F.col("hidden") if "hidden" in grid.columns else F.lit(False)
    marked = grid.withColumn("hidden", before).withColumn("__hit", F.lit(False))
    # One number for each filtered column.
    for column in sorted(row.column for row in wanted.select("column").distinct().collect()):
        values = wanted.filter(F.col("column") == column).select(*SHEET_KEYS, "__value", F.lit(True).alias("__found"))
        cell = F.coalesce(F.get("cells", F.lit(column)), F.lit(""))
        marked = marked.withColumn("__value", cell).join(F.broadcast(values) if small else values, [*SHEET_KEYS, "__value"], "left")
        marked = marked.withColumn("__hit", F.col("__hit") | F.col("__found").isNotNull()).drop("__value", "__found")
    sheets = wanted.select(*SHEET_KEYS).distinct().withColumn("__filtered", F.lit(True))
    marked = marked.join(F.broadcast(sheets) if small else sheets, SHEET_KEYS, "left")
    hidden = F.when(F.col("__filtered").isNotNull() & (F.col("row_idx") > start_row), F.col("__hit")).otherwise(F.col("hidden"))
    return marked.withColumn("hidden", hidden).select(*grid.columns, *[c for c in ("hidden",) if c not in grid.columns])


def write_batches(grid: DataFrame, rows_per_batch: int = 500, bytes_per_batch: int | None = None) -> DataFrame:
    """Rows grouped into write bodies: ``workbook_id, sheet_id, sheet_title, batch_no, range, values``.

    A batch is at most ``rows_per_batch`` positions of one sheet, so a group is
    bounded. Positions a sheet has no row for are empty rows between its others.
    Titles are quoted in the addresses where need be, so that every batch goes
    where it belongs; a sheet without a title counts as one with an empty one.

    With ``bytes_per_batch``, each batch is cut, row by row from its first, where
    ``values`` would pass that many bytes as JSON (UTF-8, with the comma behind a
    row); ``part_no`` counts the cuts of a batch from 0. Only a single row that is
    larger makes a larger part. Missing positions right before a cut are not written.
    """
    if rows_per_batch < 1 or (bytes_per_batch is not None and bytes_per_batch < 1):
        raise ValueError("a batch must hold at least one row and one byte")
    batch = F.call_function("div", F.col("row_idx"), F.lit(rows_per_batch))
    fields = ["row_idx", "cells"]
    if bytes_per_batch is not None:
        # The array's brackets are those of the row.
        written = F.to_json(F.coalesce("cells", F.array().cast(EMPTY_ROW)))
        fields.append((F.octet_length(written) + 1).cast("bigint").alias("bytes"))
    grouped = grid.groupBy(*SHEET_KEYS, batch.alias("batch_no")).agg(
        F.max("sheet_title").alias("sheet_title"),
        F.array_sort(F.collect_list(F.struct(*fields))).alias("rows"),
    )
    number = ["batch_no"]
    if bytes_per_batch is not None:
        number.append("part_no")
        cuts = grouped.withColumn("cuts", _cuts(F.col("rows"), bytes_per_batch))
        end = lambda k: F.coalesce(F.get("cuts", k + 1), F.size("rows"))
        parts = F.transform("cuts", lambda start, k: F.slice("rows", start + 1, end(k) - start))
        grouped = cuts.select(*SHEET_KEYS, "sheet_title", "batch_no", F.posexplode(parts).alias("part_no", "rows"))
    rows = F.col("rows")

    def with_gap(row: Column, i: Column) -> Column:
        gap = row["row_idx"] - F.coalesce(F.get(rows, i - 1)["row_idx"], row["row_idx"] - 1) - 1
        return F.concat(F.array_repeat(F.array().cast(EMPTY_ROW), gap.cast("int")), F.array(row["cells"]))

    return grouped.select(
        *SHEET_KEYS,
        "sheet_title",
        *number,
        range_address(F.coalesce("sheet_title", F.lit("")), F.get(rows, F.lit(0))["row_idx"], 0, quote=True).alias("range"),
        F.flatten(F.transform(rows, with_gap)).alias("values"),
    )


def _cuts(rows: Column, budget: int) -> Column:
    """Places in ``rows`` (``row_idx, cells, bytes``, in order) where a part begins."""
    start = F.expr("named_struct('cuts', cast(array() as array<int>), 'used', 0L, 'last', cast(null as bigint), 'at', 0)")

    def step(done: Column, row: Column) -> Column:
        # A missing position is an empty row and its comma.
        more = row["bytes"] + 3 * F.coalesce(row["row_idx"] - done["last"] - 1, F.lit(0))
        cut = done["last"].isNull() | (done["used"] + more > budget)
        return F.struct(
            F.when(cut, F.concat(done["cuts"], F.array(done["at"]))).otherwise(done["cuts"]).alias("cuts"),
            F.when(cut, row["bytes"]).otherwise(done["used"] + more).alias("used"),
            row["row_idx"].alias("last"),
            (done["at"] + 1).alias("at"),
        )

    return F.aggregate(rows, start, step)["cuts"]
