"""Refresh a region of a sheet from a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.functions.address import column_index
from gridframe.operators import formats
from gridframe.operators.export import cell_rows, html_fragments, numbered_cells, numbered_rows
from gridframe.operators.numbering import ROWS_PER_BUCKET
from gridframe.operators.region import apply_filter, clear_region, remove_filter, spliced
from gridframe.operators.sheets import is_sheet
from gridframe.sources.schemas import GRID


def refresh(
    grid: DataFrame,
    df: DataFrame,
    workbook_id: str,
    sheet_name_or_id: str | int,
    row_number_to_push_into: int,
    column_letter_to_push_into: str,
    order_by: Sequence[str],
    col_count: int | None = None,
    sheets: DataFrame | None = None,
    create: bool = False,
    preserve_last_n_columns: int = 0,
    do_not_clear_entire_target_sheet_range: bool = False,
    apply_filter_to_column_index: int | None = None,
    starting_row_filter_index: int | None = None,
    starting_column_filter_index: int | None = None,
    string_exclusion_filter: str = "",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """A new version of ``grid`` whose target sheet holds ``df`` at the given cell.

    The column names go to the 1-based row, the rows below it, after the old
    content there is blanked: from the start column to the sheet's last column
    less ``preserve_last_n_columns``, all rows down, or just the rectangle of
    the new content. The sheet's filter goes; a new one hides rows whose cell
    in the filter column equals the exclusion text.

    ``sheets`` may list the properties of sheets: ``workbook_id, sheet_id,
    sheet_title, row_count, col_count``. The sheet's column count comes from
    there or from ``col_count``; ``preserve_last_n_columns`` needs it, since rows
    need not be as wide as their sheet. A sheet that is neither listed nor has
    rows is an error unless ``create`` is set. Only the target sheet is joined,
    by row position; the other sheets pass through.
    """
    options = (
        col_count, sheets, create, preserve_last_n_columns, do_not_clear_entire_target_sheet_range,
        apply_filter_to_column_index, starting_row_filter_index, starting_column_filter_index, string_exclusion_filter,
    )
    place = (workbook_id, sheet_name_or_id, row_number_to_push_into, column_letter_to_push_into)
    return _refreshed(grid, df.columns, lambda: numbered_cells(df, order_by, rows_per_bucket), *place, *options)


def _refreshed(
    grid: DataFrame,
    names: list[str],
    numbered: Callable[[], tuple[DataFrame, int]],
    workbook_id: str,
    sheet_name_or_id: str | int,
    row_number_to_push_into: int,
    column_letter_to_push_into: str,
    col_count: int | None = None,
    sheets: DataFrame | None = None,
    create: bool = False,
    preserve_last_n_columns: int = 0,
    do_not_clear_entire_target_sheet_range: bool = False,
    apply_filter_to_column_index: int | None = None,
    starting_row_filter_index: int | None = None,
    starting_column_filter_index: int | None = None,
    string_exclusion_filter: str = "",
) -> DataFrame:
    """:func:`refresh` with the rows that ``numbered`` gives once the arguments are found in order."""
    if apply_filter_to_column_index is not None:
        if starting_row_filter_index is None or starting_column_filter_index is None:
            raise ValueError("a filter needs starting_row_filter_index and starting_column_filter_index")
    # The header goes to 0-based row - 1, the body starts at 0-based row.
    row, col = row_number_to_push_into, column_index(column_letter_to_push_into)
    grid = _with_hidden(grid)
    is_target = (F.col("workbook_id") == workbook_id) & is_sheet(sheet_name_or_id)
    # A sheet may have no title; it is then not the target.
    sheet, others = grid.filter(is_target), grid.filter(~F.coalesce(is_target, F.lit(False)))

    sheet_id, sheet_title, listed_columns = _identity(sheet, sheets, is_target, str(sheet_name_or_id), create)
    col_count = listed_columns if col_count is None else col_count
    body, total = numbered()
    if do_not_clear_entire_target_sheet_range:
        end_row, end_col = row + total + 1, col + len(names)
    else:
        end_row, end_col = None, col_count
        if preserve_last_n_columns:
            if col_count is None:
                raise ValueError("preserve_last_n_columns needs the sheet's column count, from col_count or sheets")
            end_col = max(0, col_count - preserve_last_n_columns)

    titles = F.array(*[F.lit(name) for name in names])
    header = grid.sparkSession.range(0, 1, 1, numPartitions=1).select(F.lit(row - 1).cast("bigint").alias("row_idx"), titles.alias("__block"))
    block = header.unionAll(body.select(F.col("row_idx") + row, "cells"))

    joined = clear_region(remove_filter(sheet), row, col, end_col, end_row).join(block, "row_idx", "full_outer")
    written = joined.select(
        F.lit(workbook_id).alias("workbook_id"),
        F.lit(sheet_id).alias("sheet_id"),
        F.lit(sheet_title).alias("sheet_title"),
        "row_idx",
        F.when(F.col("__block").isNull(), F.col("cells"))
        .otherwise(spliced(F.coalesce("cells", F.array().cast("array<string>")), F.col("__block"), col))
        .alias("cells"),
        F.lit(False).alias("hidden"),
    )
    if apply_filter_to_column_index is not None:
        written = apply_filter(
            written,
            filter_col=apply_filter_to_column_index,
            start_row=starting_row_filter_index,
            start_col=starting_column_filter_index,
            exclude=string_exclusion_filter,
        )
    return others.unionByName(written)


def refresh_formats(
    rows: DataFrame,
    row_number_to_push_into: int,
    horizontalAlignment: str | None = None,
    verticalAlignment: str | None = None,
    wrapStrategy: str | None = None,
    fontFamily: str | None = None,
    fontSize: int | None = None,
    clear_first: bool = True,
) -> DataFrame:
    """Rows of cell metadata patched for a sheet whose content was pushed as HTML.

    From the first body row down: alignment and font as given, and every
    hyperlink as a linked text run. ``rows`` has the cells nested in their rows,
    as :func:`row_positions` gives them, and so has the result: the whole chain
    is one projection. ``clear_first`` drops the user formats the rows had
    before; turn it off for metadata saved after the content was pasted.
    """
    patches = [
        formats.align_patch(horizontalAlignment, verticalAlignment, wrapStrategy),
        formats.link_patch,
        formats.merge_patch,
        formats.font_patch(fontFamily, fontSize),
    ]
    if clear_first:
        patches.insert(0, formats.clear_patch)
    # The header is in the 1-based row, so the first body row is that 0-based one.
    return formats.patch_rows(rows, row_number_to_push_into, patches)


def refresh_as_html(
    grid: DataFrame,
    df: DataFrame,
    rows: DataFrame,
    workbook_id: str,
    sheet_name_or_id: str | int,
    row_number_to_push_into: int,
    column_letter_to_push_into: str,
    order_by: Sequence[str],
    html_table_style: str | None = None,
    horizontalAlignment: str | None = None,
    verticalAlignment: str | None = None,
    wrapStrategy: str | None = None,
    fontFamily: str | None = None,
    fontSize: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    rows_per_fragment: int = 1000,
    **refresh_options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(grid, html, rows)``: a refresh whose body is pasted as HTML.

    The grid is that of :func:`refresh` with the same options: header, cleared
    region, the body's texts from the start column on, and the filter. ``html``
    is the body as one table in fragments, to be pasted at the row below the
    header in the start column. ``rows``, the cell metadata of the target sheet
    with the cells nested, comes back with the formats patched. The rows are
    numbered once, for both.
    """
    numbered, texts, total = numbered_rows(df, order_by, rows_per_bucket)
    place = (workbook_id, sheet_name_or_id, row_number_to_push_into, column_letter_to_push_into)
    new_grid = _refreshed(grid, df.columns, lambda: (cell_rows(numbered, texts), total), *place, **refresh_options)
    html = html_fragments(numbered, texts, total, html_table_style, rows_per_fragment)
    formats_given = (horizontalAlignment, verticalAlignment, wrapStrategy, fontFamily, fontSize)
    return new_grid, html, refresh_formats(rows, row_number_to_push_into, *formats_given)


def _with_hidden(grid: DataFrame) -> DataFrame:
    hidden = F.col("hidden") if "hidden" in grid.columns else F.lit(False)
    return grid.select(*GRID.names, hidden.alias("hidden"))


def _identity(sheet: DataFrame, sheets: DataFrame | None, is_target: Column, key: str, create: bool) -> tuple[str, str, int | None]:
    """Id, title and column count of the target sheet, from its properties or else one of its rows."""
    if sheets is not None:
        listed = sheets.filter(is_target).select("sheet_id", "sheet_title", "col_count").head()
        if listed is not None:
            return listed.sheet_id, listed.sheet_title, listed.col_count
    known = sheet.select("sheet_id", "sheet_title").head()
    if known is not None:
        return known.sheet_id, known.sheet_title, None
    if not create:
        raise ValueError(f"no sheet {key!r} in the workbook; create=True makes one")
    return (key, "", None) if key.isdigit() else ("", key, None)
