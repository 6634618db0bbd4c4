"""Saved row metadata as one row per cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.functions.json_text import EXTRA, SPARE, as_many_members, typed_sql, with_extras
from gridframe.operators.extent import checkpoint_once
from gridframe.sources.schemas import CELL, SHEET_KEYS, metadata_record, saved_rows

# Saved field name -> cell_meta column.
CELL_COLUMNS = {
    "userEnteredValue": "user_entered_value",
    "effectiveValue": "effective_value",
    "formattedValue": "formatted_value",
    "note": "note",
    "hyperlink": "hyperlink",
    "textFormatRuns": "text_format_runs",
    "effectiveFormat": "effective_format",
    "userEnteredFormat": "user_entered_format",
}
FORMATS = ("effectiveFormat", "userEnteredFormat")


def read_metadata(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Saved metadata responses as ``workbook_id, sheet_id, sheet_title, start_row, start_col, row_data``.

    One row per segment of a sheet: a tall sheet may be saved in many segments,
    each with the place of its first cell. Everything the rows hold is kept,
    whatever its name.
    """
    bodies = spark.read.schema(metadata_record()).options(multiLine=multi_line, mode="FAILFAST").json(path)
    sheets = bodies.select(F.coalesce("spreadsheetId", F.lit("")).alias("workbook_id"), F.explode("sheets").alias("sheet"))
    segments = sheets.select("workbook_id", "sheet.properties", F.explode("sheet.data").alias("segment"))
    return segments.select(
        "workbook_id",
        F.coalesce("properties.sheetId", F.lit("")).alias("sheet_id"),
        F.coalesce("properties.title", F.lit("")).alias("sheet_title"),
        F.coalesce("segment.startRow", F.lit(0)).cast("bigint").alias("start_row"),
        F.coalesce("segment.startColumn", F.lit(0)).alias("start_col"),
        F.col("segment.rowData").alias("row_data"),
    )


def _spread(df: DataFrame) -> DataFrame:
    """The segments over all cores: reading their JSON is the costly part, and a file has few splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _placed(df: DataFrame, row_data_col: str, cell: T.StructType) -> DataFrame:
    """Rows with their position, start column and typed cells."""
    rows = F.col(row_data_col)

    def start(name: str) -> Column:
        return (F.col(name) if name in df.columns else F.lit(0)).cast("bigint").alias(name)

    def whole(rows: Column) -> Column:
        return F.transform(rows, lambda row: F.struct(F.call_function("transform", row["values"], F.expr(f"saved -> {typed_sql('saved', cell)}")).alias("values")))

    found = _spread(df).select(*SHEET_KEYS, start("start_row"), start("start_col"), rows.alias("text"))
    if isinstance(df.schema[row_data_col].dataType, T.StringType):
        listed = lambda name: T.ArrayType(T.StructType([T.StructField("values", T.ArrayType(with_extras(cell, name)))]))
        found = found.withColumn("plain", F.from_json("text", listed(SPARE)))
        found = found.withColumn("written", F.to_json("plain"))
        as_text = [name for name in FORMATS if name in cell.names and isinstance(cell[name].dataType, T.StringType)]
        of_row = lambda row: F.flatten(F.transform(row["values"], lambda c: F.array(*[c[name] for name in as_text])))
        objects = F.array_join(F.flatten(F.filter(F.transform("plain", of_row), F.isnotnull)), "") if as_text else None
        known = F.coalesce(as_many_members(F.col("text"), F.col("written"), objects), F.lit(False))
        saved = F.from_json("text", saved_rows(), {"mode": "FAILFAST"})
        rows = F.when(known, F.col("plain").cast(listed(EXTRA))).otherwise(whole(saved))
    else:
        rows = whole(F.col("text"))
    found = found.select(*SHEET_KEYS, "start_row", "start_col", F.posexplode(rows).alias("position", "row"))
    return found.select(*SHEET_KEYS, (F.col("start_row") + F.col("position")).alias("row_idx"), "start_col", F.col("row.values").alias("values"))


def row_positions(df: DataFrame, row_data_col: str = "row_data", cell: T.StructType = CELL) -> DataFrame:
    """The rows of each sheet, with the cells still nested.

    ``start_row`` and ``start_col``, if ``df`` has them, place a segment; cells
    before its first column are null. Segments side by side make one row, nulls
    between them; where they overlap, that which starts further right wins. Only
    the rows of sheets with such segments are grouped.
    """
    rows = _placed(df, row_data_col, cell)
    cells = rows.schema["values"].dataType
    gap = lambda size: F.array_repeat(F.lit(None).cast(cells.elementType), size.cast("int"))
    values = F.when(F.col("start_col") > 0, F.concat(gap(F.col("start_col")), "values")).otherwise(F.col("values"))
    single = rows.select(*SHEET_KEYS, "row_idx", values.alias("values"))
    if "start_col" not in df.columns:
        return single
    column = F.coalesce(F.col("start_col").cast("bigint"), F.lit(0))
    beside = checkpoint_once(df.groupBy(*SHEET_KEYS).agg(F.min(column).alias("least"), F.max(column).alias("most")).filter("least < most").select(*SHEET_KEYS))
    if beside.isEmpty():
        return single

    def put(done: Column, part: Column) -> Column:
        start = part["start_col"].cast("int")
        return F.concat(F.slice(done, F.lit(1), start), gap(F.greatest(start - F.size(done), F.lit(0))), part["values"])

    # A row without cells in any segment stays null.
    part = F.when(F.col("values").isNotNull(), F.struct("start_col", "values"))
    in_order = F.array_sort(F.collect_list(part), lambda a, b: F.signum(a["start_col"] - b["start_col"]).cast("int"))
    joined = F.when(F.size(in_order) > 0, F.aggregate(in_order, F.array().cast(cells), put))
    merged = rows.join(beside, SHEET_KEYS, "left_semi").groupBy(*SHEET_KEYS, "row_idx").agg(joined.alias("values"))
    return single.join(beside, SHEET_KEYS, "left_anti").unionAll(merged)


def read_cell_meta(df: DataFrame, row_data_col: str = "row_data", cell: T.StructType = CELL) -> DataFrame:
    """``cell_meta``: one row per cell; a row without cells contributes none.

    ``row_data_col`` is the row list of one sheet or segment, as JSON text or
    parsed. Members of a cell that ``cell`` does not name are in the map
    ``extra``, and so at every level below it.
    """
    cells = _placed(df, row_data_col, cell).select(*SHEET_KEYS, "row_idx", "start_col", F.posexplode("values").alias("col_idx", "cell"))
    fields = cells.schema["cell"].dataType.names
    return cells.select(
        *SHEET_KEYS,
        "row_idx",
        (F.col("start_col") + F.col("col_idx")).cast("int").alias("col_idx"),
        *[F.col("cell")[field].alias(CELL_COLUMNS.get(field, field)) for field in fields],
    )
