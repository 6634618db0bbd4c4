"""Patches of cell metadata.

Each patch is written once, on the fields of a cell as columns, and used twice:
on ``cell_meta``, one row per cell, and on the cells nested in their rows,
where a whole chain of patches needs no grouping afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions import json_text
from gridframe.sources.metadata import CELL_COLUMNS
from gridframe.sources.schemas import ROW_KEYS, SHEET_KEYS

FORMULA_LINK = "=HYPERLINK"

# Fields of a cell by cell_meta name, their types, and a patch: the fields it changes.
Cell = Mapping[str, Column]
Types = Mapping[str, T.DataType]
Patch = Callable[[Cell, Types], dict[str, Column]]


def _all_null(data_type: T.StructType) -> Column:
    """A struct that is there but has nothing set; ``withField`` on a null struct stays null."""
    fields = ", ".join(f"'{field.name}', cast(null as {field.dataType.simpleString()})" for field in data_type)
    return F.expr(f"named_struct({fields})")


def _with(struct: Column, fields: Mapping[str, str | int | None]) -> Column:
    """The struct with the given fields set; fields given as ``None`` stay."""
    given = ((name, value) for name, value in fields.items() if value is not None)
    return reduce(lambda result, field: result.withField(field[0], F.lit(field[1])), given, struct)


def clear_patch(cell: Cell, types: Types) -> dict[str, Column]:
    return {"user_entered_format": F.lit(None).cast(types["user_entered_format"])}


def align_patch(horizontal: str | None, vertical: str | None, wrap: str | None) -> Patch:
    keys = {"horizontalAlignment": horizontal or None, "verticalAlignment": vertical or None, "wrapStrategy": wrap or None}

    def patch(cell: Cell, types: Types) -> dict[str, Column]:
        if not any(keys.values()):
            return {}
        return {
            side: _with(F.coalesce(cell[side], _all_null(types[side])), keys)
            for side in ("effective_format", "user_entered_format")
        }

    return patch


def font_patch(family: str | None, size: int | None) -> Patch:
    keys = {"fontFamily": family or None, "fontSize": size or None}

    def patch(cell: Cell, types: Types) -> dict[str, Column]:
        if not any(keys.values()):
            return {}
        effective = cell["effective_format"]
        old = effective["textFormat"]
        text = _with(F.coalesce(old, _all_null(types["effective_format"]["textFormat"].dataType)), keys)
        user = F.coalesce(cell["user_entered_format"], _all_null(types["user_entered_format"]))
        return {
            "user_entered_format": user.withField("textFormat", text),
            "effective_format": F.when(old.isNotNull(), effective.withField("textFormat", text)).otherwise(effective),
        }

    return patch


def _formula(cell: Cell) -> Column:
    return F.coalesce(cell["user_entered_value"]["formulaValue"], F.lit(""))


def _linked(cell: Cell, run_type: T.StructType, run_format: Column) -> Column:
    """A run list of one run: this format with the cell's hyperlink as its link."""
    link = _all_null(run_type["format"].dataType["link"].dataType).withField("uri", cell["hyperlink"])
    return F.array(_all_null(run_type).withField("format", run_format.withField("link", link)))


def link_patch(cell: Cell, types: Types) -> dict[str, Column]:
    run_type = types["text_format_runs"].elementType
    runs = cell["text_format_runs"]
    wanted = cell["hyperlink"].isNotNull() & runs.isNull() & ~F.contains(_formula(cell), F.lit(FORMULA_LINK))
    linked = _linked(cell, run_type, _all_null(run_type["format"].dataType))
    return {"text_format_runs": F.when(wanted, linked).otherwise(runs)}


def merge_patch(cell: Cell, types: Types) -> dict[str, Column]:
    run_type = types["text_format_runs"].elementType
    format_type = run_type["format"].dataType
    runs = F.coalesce(cell["text_format_runs"], F.array().cast(T.ArrayType(run_type)))
    has_link = F.exists(runs, lambda run: run["format"]["link"].isNotNull())
    wanted = cell["hyperlink"].isNotNull() & ~has_link & (_formula(cell) == "")

    def later_wins(merged: Column, run: Column) -> Column:
        def later(name: str) -> Column:
            if name == json_text.EXTRA:
                new, old = run["format"][name], merged[name]
                only_old = F.map_filter(old, lambda key, _: ~F.coalesce(F.map_contains_key(new, key), F.lit(False)))
                return F.coalesce(F.map_concat(only_old, new), new, old)
            return F.coalesce(run["format"][name], merged[name])

        return F.struct(*[later(name).alias(name) for name in format_type.names])

    merged = F.aggregate(runs, _all_null(format_type), later_wins)
    return {"text_format_runs": F.when(wanted, _linked(cell, run_type, merged)).otherwise(cell["text_format_runs"])}


def _patched(meta: DataFrame, row_index: int, patch: Patch) -> DataFrame:
    """``cell_meta`` with the patch applied to the cells at and below 0-based ``row_index``."""
    types = {field.name: field.dataType for field in meta.schema}
    changes = patch({name: F.col(name) for name in types}, types)
    return meta.withColumns(
        {name: F.when(F.col("row_idx") >= row_index, column).otherwise(F.col(name)) for name, column in changes.items()}
    )


def patch_rows(rows: DataFrame, row_index: int, patches: list[Patch]) -> DataFrame:
    """Rows with nested cells, all patches applied in turn at and below 0-based ``row_index``.

    A projection: cells never leave their row, so nothing is exploded or shuffled.
    """
    cell_type = rows.schema["values"].dataType.elementType
    fields = {CELL_COLUMNS.get(name, name): name for name in cell_type.names}
    types = {column: cell_type[name].dataType for column, name in fields.items()}

    def apply(patch: Patch) -> Callable[[Column], Column]:
        def to_cell(cell: Column) -> Column:
            changed = patch({column: cell[name] for column, name in fields.items()}, types)
            return reduce(lambda done, change: done.withField(fields[change[0]], change[1]), changed.items(), cell)

        return to_cell

    values = reduce(lambda cells, patch: F.transform(cells, apply(patch)), patches, F.col("values"))
    empty = F.array().cast(rows.schema["values"].dataType)
    return rows.withColumn(
        "values", F.coalesce(F.when(F.col("row_idx") >= row_index, values).otherwise(F.col("values")), empty)
    )


def clear_formats(meta: DataFrame, from_row: int) -> DataFrame:
    """No user-entered format from 1-based ``from_row`` down."""
    return _patched(meta, from_row - 1, clear_patch)


def align(
    meta: DataFrame,
    row_index: int,
    horizontal: str | None = None,
    vertical: str | None = None,
    wrap: str | None = None,
) -> DataFrame:
    """Set the given alignment keys of both formats at and below 0-based ``row_index``."""
    return _patched(meta, row_index, align_patch(horizontal, vertical, wrap))


def set_font(meta: DataFrame, row_index: int, family: str | None = None, size: int | None = None) -> DataFrame:
    """The user text format becomes the effective one with family and size replaced.

    The effective text format changes with it. Where there is none, the user
    format alone gets a new one holding just the given keys.
    """
    return _patched(meta, row_index, font_patch(family, size))


def link_runs(meta: DataFrame, row_index: int) -> DataFrame:
    """A linked run for cells with a hyperlink, no run list and no link formula."""
    return _patched(meta, row_index, link_patch)


def merge_link_runs(meta: DataFrame, row_index: int) -> DataFrame:
    """One linked run for cells with a hyperlink, no formula and no run that has a link.

    Formats of the runs merge left to right, later ones winning key by key.
    """
    return _patched(meta, row_index, merge_patch)


def assemble_rows(meta: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Cells back to one ordered row each: ``workbook_id, sheet_id, row_idx, values``.

    ``rows`` lists the row positions there should be; those without cells become
    empty rows. Cells and positions meet in the one grouping by row, which is
    never larger than a sheet row is wide.
    """
    names = {column: field for field, column in CELL_COLUMNS.items()}
    fields = [c for c in meta.columns if c not in (*ROW_KEYS, "col_idx")]
    cell = F.struct("col_idx", F.struct(*[F.col(c).alias(names.get(c, c)) for c in fields]).alias("cell"))
    parts = meta.select(*ROW_KEYS, cell.alias("part"))
    if rows is not None:
        parts = parts.unionByName(rows.select(*ROW_KEYS), allowMissingColumns=True)
    in_order = F.array_sort(F.collect_list("part"), lambda a, b: a["col_idx"] - b["col_idx"])
    return parts.groupBy(*ROW_KEYS).agg(F.transform(in_order, lambda part: part["cell"]).alias("values"))


def rows_json(rows: DataFrame) -> DataFrame:
    """Assembled rows as JSON text per row, ready to be written, members without a name here included."""
    row = json_text.text_sql("row", T.StructType([rows.schema["values"]]))
    return rows.select(*SHEET_KEYS, "row_idx", F.struct("values").alias("row")).withColumn("row", F.expr(row))
