"""DataFrames as sheet content: text columns, cell rows, HTML."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.text import blank_sql, cell_sql, filled_sql, quoted, value_sql
from gridframe.operators.numbering import ROWS_PER_BUCKET, number_rows
from gridframe.sources.schemas import GRID

# Fixed markup of an exported table.
TABLE_OPEN = '<table border="1" class="dataframe">'
TABLE_OPEN_STYLED = '<table style="{style}" border="1" class="dataframe">'
TABLE_CLOSE = "</tbody></table>"


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Columns renamed by position, and the original names: repeated names stay apart."""
    return df.toDF(*[f"_c{i}" for i in range(len(df.columns))]), df.columns


def _by_type(df: DataFrame, convert: Callable[[str, T.DataType], str]) -> DataFrame:
    """Every column as the SQL its type converts to, keeping names that may repeat."""
    frame, names = positional(df)
    return frame.selectExpr(*[f"{convert(f.name, f.dataType)} as {f.name}" for f in frame.schema]).toDF(*names)


def fill_booleans(df: DataFrame) -> DataFrame:
    """Null booleans become false."""
    return _by_type(df, lambda x, t: filled_sql(x, t) if isinstance(t, T.BooleanType) else x)


def fill_arrays(df: DataFrame) -> DataFrame:
    """Null arrays become empty."""
    return _by_type(df, lambda x, t: filled_sql(x, t) if isinstance(t, T.ArrayType) else x)


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text by its type's rule; nulls stay null."""
    return _by_type(df, value_sql)


def blank_nulls(df: DataFrame) -> DataFrame:
    """String columns with null and the whole-cell missing tokens blank."""
    return _by_type(df, lambda x, t: blank_sql(x) if isinstance(t, T.StringType) else x)


def to_text(df: DataFrame) -> DataFrame:
    """The whole chain: fills, typed text, blanks."""
    return _by_type(df, cell_sql)


def row_texts(df: DataFrame) -> list[str]:
    """The cells of a row as SQL."""
    return [cell_sql(quoted(field.name), field.dataType) for field in df.schema]


def numbered_rows(df: DataFrame, order_by: Sequence[str], rows_per_bucket: int) -> tuple[DataFrame, list[str], int]:
    """Numbered rows with positional columns, their texts as SQL and the row count.

    Raw values are shuffled, not their wider texts, and rendered afterwards.
    """
    frame, names = positional(df)
    keys = []
    for key in order_by:
        if names.count(key) != 1:
            raise ValueError(f"order_by column {key!r} appears {names.count(key)} times")
        keys.append(f"_c{names.index(key)}")
    numbered, total = number_rows(frame, keys, "row_idx", rows_per_bucket)
    return numbered, row_texts(frame), total


def numbered_cells(
    df: DataFrame, order_by: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET
) -> tuple[DataFrame, int]:
    """``row_idx, cells`` of the rendered rows in order, and their count."""
    numbered, texts, total = numbered_rows(df, order_by, rows_per_bucket)
    return cell_rows(numbered, texts), total


def cell_rows(numbered: DataFrame, texts: list[str]) -> DataFrame:
    return numbered.selectExpr("row_idx", f"array({', '.join(texts)}) as cells")


def to_cells(
    df: DataFrame,
    order_by: Sequence[str],
    workbook_id: str = "",
    sheet_id: str = "0",
    sheet_title: str = "Sheet1",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The body of a DataFrame as a grid in ``order_by`` order."""
    cells, _ = numbered_cells(df, order_by, rows_per_bucket)
    return cells.select(
        F.lit(workbook_id).alias("workbook_id"),
        F.lit(sheet_id).alias("sheet_id"),
        F.lit(sheet_title).alias("sheet_title"),
        "row_idx",
        "cells",
    ).select(*GRID.names)


def html_row(texts: list[str]) -> str:
    """One unescaped table row, as SQL."""
    cells = ", ".join(f"'<td>', {text}, '</td>'" for text in texts)
    return f"concat('<tr>', {cells}, '</tr>')"


def to_html_rows(df: DataFrame, order_by: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``row_idx, html`` with one table row per DataFrame row."""
    numbered, texts, _ = numbered_rows(df, order_by, rows_per_bucket)
    return numbered.selectExpr("row_idx", f"{html_row(texts)} as html")


def to_html_table(
    df: DataFrame,
    order_by: Sequence[str],
    table_style: str | None = None,
    rows_per_fragment: int = 1000,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One HTML table without a head, as ``fragment_no, html`` in order.

    The table is the fragments one after another. A table of up to
    ``rows_per_fragment`` rows is a single fragment; a tall one is never put
    together in one task.
    """
    numbered, texts, total = numbered_rows(df, order_by, rows_per_bucket)
    return html_fragments(numbered, texts, total, table_style, rows_per_fragment)


def html_fragments(numbered: DataFrame, texts: list[str], total: int, table_style: str | None = None, rows_per_fragment: int = 1000) -> DataFrame:
    """The table of rows that are numbered already."""
    last = max(0, (total - 1) // rows_per_fragment)
    opening = (TABLE_OPEN_STYLED.format(style=table_style) if table_style else TABLE_OPEN) + "<tbody>"
    rows = numbered.selectExpr(
        f"row_idx div {rows_per_fragment} as fragment_no", f"struct(row_idx, {html_row(texts)} as html) as row"
    )
    if total == 0:
        # A table without rows still has its tags.
        rows = numbered.sparkSession.range(0, 1, 1, numPartitions=1).select(F.col("id").alias("fragment_no"), F.lit(None).cast(rows.schema["row"].dataType).alias("row"))
    ordered = F.array_sort(F.collect_list("row"))
    body = F.array_join(F.transform(ordered, lambda row: row["html"]), "")
    return rows.groupBy("fragment_no").agg(body.alias("body")).select(
        "fragment_no",
        F.concat(
            F.when(F.col("fragment_no") == 0, F.lit(opening)).otherwise(F.lit("")),
            "body",
            F.when(F.col("fragment_no") == last, F.lit(TABLE_CLOSE)).otherwise(F.lit("")),
        ).alias("html"),
    )
