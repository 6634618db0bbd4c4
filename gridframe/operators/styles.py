"""Cell metadata whose formats are stored once.

A cell holds the id of its pair of formats, a dictionary holds each pair that
occurs. Formats are read, patched and written per entry of the dictionary, so
that work grows with distinct formats and not with cells. Ids are hashes of the
content, so tables made apart agree on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.json_text import text_sql, typed_sql
from gridframe.operators.extent import BROADCAST_BYTES, checkpoint_once, measured_bytes
from gridframe.operators.formats import Patch, align_patch, clear_patch, font_patch
from gridframe.sources.metadata import CELL_COLUMNS, FORMATS, read_cell_meta
from gridframe.sources.schemas import CELL, ROW_KEYS, SHEET_KEYS, TEXT

COLUMNS = [CELL_COLUMNS[name] for name in FORMATS]
# Beyond a broadcast, cells of one style are spread over this many keys.
SPREAD = 64


def _style_id(effective: Column, user: Column) -> Column:
    """Hash of two format texts; their lengths keep apart where one ends, and what is missing."""
    lengths = [F.coalesce(F.length(text).cast("string"), F.lit("-")) for text in (effective, user)]
    return F.sha2(F.concat_ws(":", *lengths, effective, user), 256)


def _format_text(styles: DataFrame, name: str) -> Column:
    return F.when(F.col(name).isNotNull(), F.expr(text_sql(name, styles.schema[name].dataType)))


def read_styled(df: DataFrame, row_data_col: str = "row_data", cell: T.StructType = CELL) -> tuple[DataFrame, DataFrame]:
    """``(cells, styles)``: as :func:`read_cell_meta`, but with a ``style_id`` for the two formats.

    ``styles`` is ``style_id, effective_format, user_entered_format``, an entry
    for each pair of formats as saved, no formats being a pair as well; members
    without a name are kept. Formats that differ in blanks or in the order of
    members are entries of their own. A format that is no object is an error.
    """
    as_text = T.StructType([T.StructField(f.name, TEXT if f.name in FORMATS else f.dataType) for f in cell])
    saved = read_cell_meta(df, row_data_col, as_text).withColumn("style_id", _style_id(*map(F.col, COLUMNS)))
    # Equal pairs meet in each task first, so a pair that most cells have sends one row a task.
    pairs = saved.select("style_id", *COLUMNS).distinct()
    typed = {column: F.expr(typed_sql(f"parse_json({column})", cell[name].dataType)) for name, column in zip(FORMATS, COLUMNS)}
    return saved.drop(*COLUMNS), checkpoint_once(pairs.withColumns(typed))


def _with_styles(cells: DataFrame, styles: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Cells with what a stored table says of their style."""
    if measured_bytes(styles) <= broadcast_bytes:
        return cells.join(F.broadcast(styles), "style_id")
    key = F.pmod(F.xxhash64(*ROW_KEYS, "col_idx"), F.lit(SPREAD)).cast("int")
    copies = styles.withColumn("__key", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    return cells.withColumn("__key", key).join(copies, ["style_id", "__key"]).drop("__key")


def _restyled(cells: DataFrame, styles: DataFrame, row_index: int, patches: Sequence[Patch], broadcast_bytes: int) -> tuple[DataFrame, DataFrame]:
    types = {name: styles.schema[name].dataType for name in COLUMNS}
    patched = styles
    for patch in patches:
        patched = patched.withColumns(patch({name: F.col(name) for name in COLUMNS}, types))
    patched = checkpoint_once(patched.withColumn("__new", _style_id(*[_format_text(styles, name) for name in COLUMNS])))
    moved = _with_styles(cells, patched.select("style_id", "__new"), broadcast_bytes)
    style = F.when(F.col("row_idx") >= row_index, F.col("__new")).otherwise(F.col("style_id"))
    new = patched.select(F.col("__new").alias("style_id"), *COLUMNS)
    return moved.withColumn("style_id", style).drop("__new"), checkpoint_once(styles.unionByName(new).dropDuplicates(["style_id"]))


def restyle(
    cells: DataFrame,
    styles: DataFrame,
    row_index: int,
    horizontal: str | None = None,
    vertical: str | None = None,
    wrap: str | None = None,
    family: str | None = None,
    size: int | None = None,
    clear_first: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """Clear, align and set the font at and below 0-based ``row_index``, in that order.

    The result is that of :func:`clear_formats`, :func:`align` and
    :func:`set_font`; cells only change their ids. New entries join the
    dictionary, old ones stay, whether a cell still has them or not. The table
    of ids is broadcast below a measured size; beyond it, it is joined with the
    cells of a style spread over many keys.
    """
    patches = [*([clear_patch] if clear_first else []), align_patch(horizontal, vertical, wrap), font_patch(family, size)]
    return _restyled(cells, styles, row_index, patches, broadcast_bytes)


def styled_meta(cells: DataFrame, styles: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``cell_meta`` again: the formats of every cell in place of its ``style_id``."""
    whole = _with_styles(cells, styles, broadcast_bytes)
    named = [*ROW_KEYS, "col_idx", *CELL_COLUMNS.values()]
    return whole.select(*[c for c in named if c in whole.columns], *[c for c in whole.columns if c not in (*named, "style_id")])


def styled_rows_json(cells: DataFrame, styles: DataFrame, rows: DataFrame | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows as JSON text, as :func:`assemble_rows` and :func:`rows_json` write them.

    A format is written once for each entry of the dictionary, and cells take
    its text. ``rows`` lists the row positions there should be.
    """
    members = [F.concat(F.lit(f'"{name}":'), _format_text(styles, column)) for name, column in zip(FORMATS, COLUMNS)]
    texts = checkpoint_once(styles.select("style_id", F.concat_ws(",", *members).alias("__formats")))
    names = {column: field for field, column in CELL_COLUMNS.items()}
    fields = [c for c in cells.columns if c not in (*ROW_KEYS, "col_idx", "style_id")]
    plain = cells.select(*ROW_KEYS, "col_idx", "style_id", F.struct(*[F.col(c).alias(names.get(c, c)) for c in fields]).alias("__cell"))
    written = plain.withColumn("__cell", F.expr(text_sql("__cell", plain.schema["__cell"].dataType)))
    inside = F.substring("__cell", F.lit(2), F.length("__cell") - 2)
    filled = [F.nullif(text, F.lit("")) for text in (inside, F.col("__formats"))]
    text = F.concat(F.lit("{"), F.concat_ws(",", *filled), F.lit("}")).alias("text")
    parts = _with_styles(written, texts, broadcast_bytes).select(*ROW_KEYS, F.struct("col_idx", text).alias("part"))
    if rows is not None:
        parts = parts.unionByName(rows.select(*ROW_KEYS), allowMissingColumns=True)
    in_order = F.transform(F.array_sort(F.collect_list("part")), lambda part: part["text"])
    row = F.concat(F.lit('{"values":['), F.array_join(in_order, ","), F.lit("]}"))
    return parts.groupBy(*ROW_KEYS).agg(row.alias("row")).select(*SHEET_KEYS, "row_idx", "row")
