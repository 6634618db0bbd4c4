import json

import pytest
from pyspark.sql import functions as F

import gridframe as gf
from gridframe.functions.json_text import as_many_members

KEYS = ["workbook_id", "sheet_id", "row_idx", "col_idx"]
BOLD = {"textFormat": {"bold": True, "fontFamily": "Arial", "colorStyle": {"theme": "T"}}, "padding": {"top": 2}}
RED = {"backgroundColor": {"red": 0.5}, "wrapStrategy": "CLIP"}
CELLS = [
    {"formattedValue": "a", "effectiveFormat": BOLD, "userEnteredFormat": RED},
    {"formattedValue": 'q"{[:', "effectiveFormat": BOLD, "userEnteredFormat": RED, "dataValidation": {"strict": True}},
    {"hyperlink": "u", "effectiveFormat": RED},
    {"hyperlink": "u", "userEnteredFormat": RED},
    {},
    {"note": "n", "effectiveFormat": {}},
    {"note": "n", "effectiveFormat": None},
]
NAMED = [{"formattedValue": "a", "effectiveFormat": RED}, {"formattedValue": "b", "userEnteredFormat": RED}]


@pytest.fixture
def sheet(spark):
    rows = [{"values": CELLS}, {}, {"values": list(reversed(CELLS))}]
    data = [("w", "0", json.dumps(rows)), ("w", "1", json.dumps([{"values": NAMED}] * 3)), ("w", "2", "[]"), ("w", "3", None)]
    return spark.createDataFrame(data, "workbook_id string, sheet_id string, row_data string")


def written(rows):
    return {(r.workbook_id, r.sheet_id, r.row_idx): json.loads(r.row) for r in rows.collect()}


def of_cells(meta):
    return written(gf.rows_json(gf.assemble_rows(meta)))


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_read_and_back(sheet, limit):
    cells, styles = gf.read_styled(sheet)
    meta = gf.read_cell_meta(sheet)
    whole = gf.styled_meta(cells, styles, limit)
    assert whole.columns == meta.columns and whole.count() == meta.count()
    assert of_cells(whole) == of_cells(meta)
    assert written(gf.styled_rows_json(cells, styles, broadcast_bytes=limit)) == of_cells(meta)


def test_one_entry_for_each_pair(sheet):
    _, styles = gf.read_styled(sheet)
    # both; effective; user; none, which an explicit null is too; an empty one.
    assert styles.count() == styles.select("style_id").distinct().count() == 5


@pytest.mark.parametrize("limit", [0, 1 << 20])
@pytest.mark.parametrize("row", [0, 2, 9])
def test_patches_equal_those_of_cells(sheet, row, limit):
    cells, styles = gf.restyle(*gf.read_styled(sheet), row, horizontal="LEFT", size=11, broadcast_bytes=limit)
    expected = gf.set_font(gf.align(gf.read_cell_meta(sheet), row, horizontal="LEFT"), row, size=11)
    assert of_cells(gf.styled_meta(cells, styles)) == of_cells(expected)
    assert written(gf.styled_rows_json(cells, styles)) == of_cells(expected)


def test_clear_first(sheet):
    cells, styles = gf.restyle(*gf.read_styled(sheet), 1, vertical="TOP", clear_first=True)
    expected = gf.align(gf.clear_formats(gf.read_cell_meta(sheet), 2), 1, vertical="TOP")
    assert of_cells(gf.styled_meta(cells, styles)) == of_cells(expected)


def test_equal_results_share_an_entry(spark):
    formats = [{"horizontalAlignment": side} for side in ("LEFT", "RIGHT", "CENTER")]
    rows = [{"values": [{"effectiveFormat": f, "userEnteredFormat": f} for f in formats]}]
    df = spark.createDataFrame([("w", "0", json.dumps(rows))], "workbook_id string, sheet_id string, row_data string")
    cells, styles = gf.restyle(*gf.read_styled(df), 0, horizontal="LEFT")
    assert cells.select("style_id").distinct().count() == 1
    again, more = gf.restyle(cells, styles, 0, horizontal="LEFT")
    assert more.count() == styles.count() and again.select("style_id").distinct().collect() == cells.select("style_id").distinct().collect()


def test_nothing_to_change(sheet):
    cells, styles = gf.restyle(*gf.read_styled(sheet), 0)
    assert of_cells(gf.styled_meta(cells, styles)) == of_cells(gf.read_cell_meta(sheet))


def test_links_on_styled_cells(sheet):
    cells, styles = gf.read_styled(sheet)
    meta = gf.styled_meta(gf.link_runs(cells, 0), styles)
    assert of_cells(meta) == of_cells(gf.link_runs(gf.read_cell_meta(sheet), 0))


def test_rows_without_cells(sheet):
    cells, styles = gf.read_styled(sheet)
    rows = written(gf.styled_rows_json(cells, styles, gf.row_positions(sheet)))
    assert rows[("w", "0", 1)] == {"values": []} and len(rows) == 6


def test_no_cells(spark):
    df = spark.createDataFrame([], "workbook_id string, sheet_id string, row_data string")
    cells, styles = gf.restyle(*gf.read_styled(df), 0, size=9)
    assert gf.styled_meta(cells, styles).count() == gf.styled_rows_json(cells, styles).count() == 0


@pytest.mark.parametrize("saved", ['"text"', "12", "[1]"])
def test_a_format_that_is_no_object(spark, saved):
    df = spark.createDataFrame([("w", "0", f'[{{"values":[{{"effectiveFormat":{saved}}}]}}]')], "workbook_id string, sheet_id string, row_data string")
    with pytest.raises(Exception, match="MALFORMED|INVALID_VARIANT_CAST"):
        gf.read_styled(df)[1].select(F.to_json("effective_format")).collect()


@pytest.mark.parametrize(
    "saved",
    [
        '{"note" : "x","odd":1}',  # a blank before the colon of a known member and an unknown one
        '{"note"\t:"x","odd":1}',
        '{"note":"a\\":b","odd":1}',
        '{"note":"a\\\\","odd":[1]}',
        '{"note":":[","odd":1}',
        '{"note":"[","hyperlink":":","odd":{"a":[]}}',
        '{"note":{"a":1},"odd":1}',
        '{"note":"\\u0022:","odd":1}',
        '{"textFormatRuns":[{"odd":[]}],"note":"\\u005b"}',
        '{"note": "x" , "hyperlink": "y"}',
        '{"note":null,"odd":null}',
    ],
)
def test_no_member_is_lost(spark, saved):
    df = spark.createDataFrame([("w", "0", f'[{{"values":[{saved}]}}]')], "workbook_id string, sheet_id string, row_data string")
    row = json.loads(gf.rows_json(gf.row_positions(df)).first().row)["values"][0]
    expected = {k: json.dumps(v, separators=(",", ":")) if k == "note" and isinstance(v, dict) else v for k, v in json.loads(saved).items()}
    expected = {k: v for k, v in expected.items() if k == "odd" or v is not None}
    assert row == expected


@pytest.mark.parametrize("text", ['[{"values":[{"effectiveFormat":{"padding":{"top":1}}}]}]', '[{"values":[{"effectiveFormat" : {"wrapStrategy" : "CLIP"}}]},{}]'])
def test_formats_as_text_are_known(spark, text):
    """Such rows are read by the schema alone, whatever their formats hold."""
    df = spark.createDataFrame([("w", "0", text)], "workbook_id string, sheet_id string, row_data string")
    expected = of_cells(gf.read_cell_meta(df))
    assert written(gf.styled_rows_json(*gf.read_styled(df))) == expected


def test_keys_in_single_quotes_hide_nothing(spark):
    df = spark.createDataFrame([(json.dumps([{"note": "x"}]), """[{'note':"x","odd":1}]""")], "written string, saved string")
    assert not df.select(as_many_members(F.col("saved"), F.col("written"))).first()[0]
