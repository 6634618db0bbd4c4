"""Spreadsheet-shaped data as Spark DataFrames: grids in, tables out, and back."""

from gridframe.functions.address import CellRange, col_letters, col_number, column_index, parse_range, range_address
from gridframe.functions.names import clean_names, distinct_names, unique_names
from gridframe.functions.text import double_text
from gridframe.operators.columns import cell_links, column_widths
from gridframe.operators.export import (
    blank_nulls,
    fill_arrays,
    fill_booleans,
    positional,
    stringify,
    to_cells,
    to_html_rows,
    to_html_table,
    to_text,
)
from gridframe.operators.formats import (
    align,
    assemble_rows,
    clear_formats,
    link_runs,
    merge_link_runs,
    rows_json,
    set_font,
)
from gridframe.operators.numbering import number_rows
from gridframe.operators.region import apply_criteria, apply_filter, clear_region, overlay, overlay_blocks, remove_filter, write_batches
from gridframe.operators.sheets import (
    cell_range,
    drop_empty_rows,
    grid_to_cells,
    pad_rows,
    promote_header,
    select_sheet,
)
from gridframe.operators.styles import read_styled, restyle, styled_meta, styled_rows_json
from gridframe.operators.tables import grid_to_records, grid_to_table
from gridframe.operators.updates import changed_blocks
from gridframe.plans.read import read_sheet
from gridframe.plans.refresh import refresh, refresh_as_html, refresh_formats
from gridframe.plans.stored import read_stored, refresh_stored, store_grid
from gridframe.sources.metadata import read_cell_meta, read_metadata, row_positions
from gridframe.sources.tall import read_tall_values
from gridframe.sources.values import read_grid, read_values, values_to_grid, write_grid
