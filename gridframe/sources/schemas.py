"""Schemas of sheet content. Nested field names are those of the saved JSON."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in fields.items()])


TEXT, NUMBER, COUNT, FLAG = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()

SHEET_KEYS = ["workbook_id", "sheet_id"]
ROW_KEYS = [*SHEET_KEYS, "row_idx"]

GRID = T.StructType(
    [
        T.StructField("workbook_id", TEXT),
        T.StructField("sheet_id", TEXT),
        T.StructField("sheet_title", TEXT),
        T.StructField("row_idx", T.LongType()),
        T.StructField("cells", T.ArrayType(TEXT)),
    ]
)

VALUES_BODY = _struct(range=TEXT, majorDimension=TEXT, values=T.ArrayType(T.ArrayType(TEXT)))
VALUES_RECORD = T.StructType([*_struct(workbook_id=TEXT, sheet_id=TEXT, sheet_title=TEXT).fields, *VALUES_BODY.fields])

COLOR = _struct(red=NUMBER, green=NUMBER, blue=NUMBER, alpha=NUMBER)
LINK = _struct(uri=TEXT)
RUN_FORMAT = _struct(
    foregroundColor=COLOR,
    fontFamily=TEXT,
    fontSize=COUNT,
    bold=FLAG,
    italic=FLAG,
    strikethrough=FLAG,
    underline=FLAG,
    link=LINK,
)
TEXT_RUN = _struct(startIndex=COUNT, format=RUN_FORMAT)
CELL_FORMAT = _struct(
    numberFormat=_struct(type=TEXT, pattern=TEXT),
    backgroundColor=COLOR,
    horizontalAlignment=TEXT,
    verticalAlignment=TEXT,
    wrapStrategy=TEXT,
    textDirection=TEXT,
    textFormat=RUN_FORMAT,
    hyperlinkDisplayType=TEXT,
)
CELL_VALUE = _struct(numberValue=NUMBER, stringValue=TEXT, boolValue=FLAG, formulaValue=TEXT)

# The named part of one cell of saved row metadata; everything else is carried beside it.
CELL = _struct(
    userEnteredValue=CELL_VALUE,
    effectiveValue=CELL_VALUE,
    formattedValue=TEXT,
    note=TEXT,
    hyperlink=TEXT,
    textFormatRuns=T.ArrayType(TEXT_RUN),
    effectiveFormat=CELL_FORMAT,
    userEnteredFormat=CELL_FORMAT,
)


def saved_rows() -> T.ArrayType:
    """Rows as they are saved, each cell whole."""
    return T.ArrayType(_struct(values=T.ArrayType(T.VariantType())))


def metadata_record() -> T.StructType:
    segment = _struct(startRow=COUNT, startColumn=COUNT, rowData=saved_rows())
    sheet = _struct(properties=_struct(sheetId=TEXT, title=TEXT), data=T.ArrayType(segment))
    return _struct(spreadsheetId=TEXT, sheets=T.ArrayType(sheet))
