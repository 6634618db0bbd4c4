import json
import time

import pytest
from pyspark.sql import functions as F

import gridframe as gf

CELLS = {
    "plain": {"formattedValue": "x", "userEnteredValue": {"stringValue": "x"}},
    "formatted": {
        "effectiveFormat": {"horizontalAlignment": "LEFT", "textFormat": {"fontFamily": "Arial", "fontSize": 8, "bold": True}},
        "userEnteredFormat": {"wrapStrategy": "CLIP", "textFormat": {"italic": True}, "backgroundColor": {"red": 0.5}},
    },
    "runs_absent": {"hyperlink": "u"},
    "runs_empty": {"hyperlink": "u", "textFormatRuns": []},
    "runs_plain": {
        "hyperlink": "u",
        "textFormatRuns": [
            {"format": {"bold": True, "fontFamily": "A"}},
            {"startIndex": 3, "format": {"fontFamily": "B"}},
            {"startIndex": 5},
        ],
    },
    "runs_linked": {"hyperlink": "u", "textFormatRuns": [{"startIndex": 2, "format": {"link": {"uri": "v"}}}]},
    "formula_link": {"hyperlink": "u", "userEnteredValue": {"formulaValue": '=HYPERLINK("u","t")'}},
    "other_formula": {"hyperlink": "u", "userEnteredValue": {"formulaValue": "=A1"}},
    "other_formula_runs": {"hyperlink": "u", "userEnteredValue": {"formulaValue": "=A1"}, "textFormatRuns": []},
}


@pytest.fixture
def sheet(spark):
    rows = [{"values": list(CELLS.values())}, {}, {"values": list(CELLS.values())}, {"values": [{}]}]
    return spark.createDataFrame([("w", "0", json.dumps(rows))], "workbook_id string, sheet_id string, row_data string")


@pytest.fixture
def meta(sheet):
    return gf.read_cell_meta(sheet)


def cells(meta, row=2):
    """The cells of one row as the JSON they would be written as, by name."""
    row = gf.assemble_rows(meta).filter(F.col("row_idx") == row).select(F.to_json(F.struct("values")).alias("j")).first().j
    return dict(zip(CELLS, json.loads(row)["values"]))


def test_reading_keeps_the_content(meta):
    assert meta.groupBy("row_idx").count().orderBy("row_idx").collect() == [(0, 9), (2, 9), (3, 1)]
    assert cells(meta) == CELLS


def test_read_metadata_files(spark, tmp_path):
    record = {
        "spreadsheetId": "w",
        "sheets": [{"properties": {"sheetId": 12, "title": "T"}, "data": [{"rowData": [{"values": [CELLS["formatted"]]}, {}]}]}],
    }
    path = tmp_path / "meta.json"
    path.write_text(json.dumps(record))
    sheets = gf.read_metadata(spark, str(path))
    assert [tuple(r) for r in sheets.select("workbook_id", "sheet_id", "sheet_title").collect()] == [("w", "12", "T")]
    assert gf.read_cell_meta(sheets).first().effective_format.textFormat.fontFamily == "Arial"
    assert gf.row_positions(sheets).count() == 2


def test_clear_formats(meta):
    cleared = gf.clear_formats(meta, 3)
    assert "userEnteredFormat" in cells(cleared, 0)["formatted"]
    assert "userEnteredFormat" not in cells(cleared)["formatted"]


def test_align(meta):
    got = gf.align(meta, 2, horizontal="CENTER", vertical="MIDDLE")
    assert cells(got, 0) == CELLS
    plain = cells(got)["plain"]
    assert plain["effectiveFormat"] == plain["userEnteredFormat"] == {"horizontalAlignment": "CENTER", "verticalAlignment": "MIDDLE"}
    formatted = cells(got)["formatted"]
    assert formatted["userEnteredFormat"]["wrapStrategy"] == "CLIP"
    assert formatted["userEnteredFormat"]["backgroundColor"] == {"red": 0.5}
    assert formatted["effectiveFormat"]["textFormat"] == CELLS["formatted"]["effectiveFormat"]["textFormat"]
    assert cells(gf.align(meta, 2)) == CELLS


def test_set_font(meta):
    got = cells(gf.set_font(meta, 2, family="Barlow", size=10))
    text = {"fontFamily": "Barlow", "fontSize": 10, "bold": True}
    assert got["formatted"]["userEnteredFormat"]["textFormat"] == text
    assert got["formatted"]["effectiveFormat"]["textFormat"] == text
    assert got["plain"]["userEnteredFormat"] == {"textFormat": {"fontFamily": "Barlow", "fontSize": 10}}
    assert "effectiveFormat" not in got["plain"]
    only_size = cells(gf.set_font(meta, 2, size=11))
    assert only_size["formatted"]["userEnteredFormat"]["textFormat"] == {"fontFamily": "Arial", "fontSize": 11, "bold": True}
    assert cells(gf.set_font(meta, 2), 0) == CELLS


def test_link_runs(meta):
    got = cells(gf.link_runs(meta, 2))
    linked = [{"format": {"link": {"uri": "u"}}}]
    assert got["runs_absent"]["textFormatRuns"] == got["other_formula"]["textFormatRuns"] == linked
    for name in ("plain", "runs_empty", "runs_plain", "runs_linked", "formula_link", "other_formula_runs"):
        assert got[name] == CELLS[name]


def test_merge_link_runs(meta):
    got = cells(gf.merge_link_runs(gf.link_runs(meta, 2), 2))
    assert got["runs_plain"]["textFormatRuns"] == [{"format": {"bold": True, "fontFamily": "B", "link": {"uri": "u"}}}]
    assert got["runs_empty"]["textFormatRuns"] == [{"format": {"link": {"uri": "u"}}}]
    for name in ("runs_linked", "formula_link", "other_formula_runs", "plain"):
        assert got[name] == CELLS[name]
    assert cells(gf.merge_link_runs(gf.link_runs(meta, 2), 2), 0) == CELLS


def test_assemble_rows(sheet, meta):
    shuffled = meta.repartition(5, "col_idx")
    rows = gf.assemble_rows(shuffled, gf.row_positions(sheet)).orderBy("row_idx").collect()
    assert [(r.row_idx, len(r["values"])) for r in rows] == [(0, 9), (1, 0), (2, 9), (3, 1)]
    assert rows[0]["values"][0].formattedValue == "x"
    texts = gf.rows_json(gf.assemble_rows(meta, gf.row_positions(sheet))).orderBy("row_idx").collect()
    assert json.loads(texts[1].row) == {"values": []}


def test_html_push(spark, sheet, make_grid, lines):
    cells = ['=HYPERLINK("u.org","one")', 'x <a href="v.org">two</a>, <a href="w.org">three</a>', "<b>plain</b>"]
    df = spark.createDataFrame([tuple(cells)], "first string, second string, third string")
    old = make_grid({("wb", "0", "Sheet1"): [["keep", "top"]] + [["keep", f"o{r}", f"p{r}"] for r in range(5)], ("wb", "1", "Other"): [["x"]]})
    grid, html, rows = gf.refresh_as_html(
        old, df, gf.row_positions(sheet), "wb", "Sheet1", 2, "B", ["first"], horizontalAlignment="LEFT", verticalAlignment="TOP",
        wrapStrategy="CLIP", fontFamily="Inter", fontSize=12, apply_filter_to_column_index=1, starting_row_filter_index=1, starting_column_filter_index=1)
    target = gf.select_sheet(grid, "0")
    assert lines(target) == [["keep", "top"], ["keep", "first", "second", "third"], ["keep", *cells], *[["keep", "", ""]] * 3]
    assert [r.row_idx for r in target.filter("hidden").orderBy("row_idx").collect()] == [3, 4, 5]
    assert lines(gf.select_sheet(grid, "1")) == [["x"]]
    assert [r.html for r in html.collect()] == ['<table border="1" class="dataframe"><tbody><tr>' + "".join(f"<td>{c}</td>" for c in cells) + "</tr></tbody></table>"]
    by_row = {r.row_idx: r["values"] for r in rows.collect()}
    assert set(by_row) == {0, 1, 2, 3}
    for cell in by_row[2] + by_row[3]:
        user = cell.userEnteredFormat
        assert (user.horizontalAlignment, user.verticalAlignment, user.wrapStrategy) == ("LEFT", "TOP", "CLIP")
        assert (user.textFormat.fontFamily, user.textFormat.fontSize) == ("Inter", 12)
    assert by_row[0][0].userEnteredFormat is None


LINKS = [
    ('<a data-href="x" href="y">t</a>', [("y", "t")]),
    ("<a href=y>t</a> <A HREF = \"y\" class=k>T</A >", [("y", "t"), ("y", "T")]),
    ("<a href=\"/it's/long\">t</a>", [("/it's/long", "t")]),
    ("<a href='p?a=1&amp;b=&#34;'>A &amp; B</a>", [('p?a=1&b="', "A &amp; B")]),
    ('=hyperlink( "u" , "t" )', [("u", "t")]),
    ('=HYPERLINK("u")', [("u", "u")]),
    ('=HYPERLINK("u";"say ""hi""")', [("u", 'say "hi"')]),
    ('<a href="1">one<a href="2">two <b>x</b></a>', [("2", "two <b>x</b>")]),
    ('<a title="a > b" href="z"><i>t</i></a>', [("z", "<i>t</i>")]),
    ("<abbr href='n'>t</abbr> <a name=x>no</a> <a>none</a>", []),
    ("<br/><a/href='s'>t</a>", [("s", "t")]),
]


def test_links_of_every_form(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(LINKS)], "k int, c string")
    got = {}
    for r in gf.cell_links(df, "c", ["k"]).orderBy("k", "ord").collect():
        got.setdefault(r.k, []).append((r.uri, r.text))
    assert [got.get(i, []) for i in range(len(LINKS))] == [want for _, want in LINKS]


def test_unclosed_anchors_take_linear_time(spark):
    df = spark.createDataFrame([("<a href='x'> " * 8_000,), ("<a " * 30_000,), ("=HYPERLINK(" * 20_000,)], "c string")
    start = time.perf_counter()
    assert gf.cell_links(df, "c").count() == 0
    assert time.perf_counter() - start < 5


def test_empty_alignment_is_no_alignment(meta):
    done = gf.align(meta, 0, horizontal="", vertical="TOP")
    assert done.filter("effective_format.horizontalAlignment = '' or user_entered_format.horizontalAlignment = ''").count() == 0


@pytest.mark.parametrize("clear_first", [True, False])
def test_nested_patches_equal_the_cell_by_cell_ones(sheet, meta, clear_first):
    step = gf.clear_formats(meta, 3) if clear_first else meta
    step = gf.align(step, 2, horizontal="RIGHT", wrap="CLIP")
    step = gf.merge_link_runs(gf.link_runs(step, 2), 2)
    one_by_one = gf.rows_json(gf.assemble_rows(gf.set_font(step, 2, family="Barlow"), gf.row_positions(sheet)))
    nested = gf.refresh_formats(
        gf.row_positions(sheet), 2, horizontalAlignment="RIGHT", wrapStrategy="CLIP", fontFamily="Barlow", clear_first=clear_first)
    assert gf.rows_json(nested).orderBy("row_idx").collect() == one_by_one.orderBy("row_idx").collect()
    assert "Exchange" not in nested._jdf.queryExecution().executedPlan().toString()


def test_links_in_order_and_across_lines(spark):
    df = spark.createDataFrame([(1, "=HYPERLINK(\"a\",\"A\") <A class='k' HREF='b'>B\nb</A>"), (2, "<a name=x>no</a>"), (3, None)], "k int, c string")
    assert [tuple(r) for r in gf.cell_links(df, "c", ["k"]).orderBy("ord").collect()] == [(1, 1, "a", "A"), (1, 2, "b", "B\nb")]


def test_column_widths(make_grid):
    grid = make_grid({("w", "1", "A"): [["é", "22", None], ["333"]], ("w", "2", "B"): [["x"]]})
    got = {(r.sheet_id, r.col_idx): r.width for r in gf.column_widths(grid).collect()}
    assert got == {("1", 0): 3, ("1", 1): 2, ("1", 2): 0, ("2", 0): 1}
    assert {r.col_idx for r in gf.column_widths(grid, 1, 2).collect()} == {1}
    assert {r.col_idx for r in gf.column_widths(grid, 1).collect()} == {1, 2}


SAVED = {
    "spreadsheetId": "wb",
    "sheets": [{
        "properties": {"sheetId": 3, "title": "T"},
        "data": [
            {"rowData": [{"values": [{
                "formattedValue": "x", "chipRuns": [{"chip": {"a": 1}}], "note": "n\n\"q\"",
                "effectiveValue": {"errorValue": {"type": "REF"}}, "userEnteredValue": {"numberValue": 1.5},
                "effectiveFormat": {"padding": {"top": 2}, "borders": {}, "textFormat": {"fontSize": 9, "foregroundColorStyle": {"themeColor": "TEXT"}}},
                "userEnteredFormat": {"textRotation": {"angle": 45}},
                "textFormatRuns": [{"startIndex": 1, "mark": True, "format": {"bold": True, "chip": "c", "link": {"uri": "u", "kind": "k"}}}],
            }, {}]}, {}]},
            {"startRow": 40, "startColumn": 2, "rowData": [{"values": [{"formattedValue": "far", "dataValidation": {"strict": False, "n": None}}]}]},
        ],
    }],
}


def test_everything_saved_is_written_back(spark, tmp_path):
    (tmp_path / "saved.json").write_text(json.dumps(SAVED))
    segments = gf.read_metadata(spark, str(tmp_path / "saved.json"))
    rows = gf.row_positions(segments)
    written = {r.row_idx: json.loads(r.row) for r in gf.rows_json(rows).collect()}
    first, second = SAVED["sheets"][0]["data"]
    assert written == {0: first["rowData"][0], 1: {}, 40: {"values": [None, None, second["rowData"][0]["values"][0]]}}
    meta = gf.read_cell_meta(segments)
    assert sorted((r.sheet_id, r.row_idx, r.col_idx, r.formatted_value) for r in meta.collect() if r.formatted_value) == [("3", 0, 0, "x"), ("3", 40, 2, "far")]
    again = {r.row_idx: json.loads(r.row) for r in gf.rows_json(gf.assemble_rows(meta)).collect()}
    assert again[0] == written[0] and again[40] == {"values": second["rowData"][0]["values"]}

    patched = gf.rows_json(gf.refresh_formats(rows, 0, horizontalAlignment="LEFT", fontSize=11, clear_first=False)).filter("row_idx = 0")
    cell = json.loads(patched.first().row)["values"][0]
    want = json.loads(json.dumps(first["rowData"][0]["values"][0]))
    text = {"fontSize": 11, "foregroundColorStyle": {"themeColor": "TEXT"}}
    want["effectiveFormat"] |= {"horizontalAlignment": "LEFT", "textFormat": text}
    want["userEnteredFormat"] |= {"horizontalAlignment": "LEFT", "textFormat": text}
    assert cell == want
    cleared = gf.rows_json(gf.refresh_formats(rows, 0, wrapStrategy="CLIP")).filter("row_idx = 0")
    assert json.loads(cleared.first().row)["values"][0]["userEnteredFormat"] == {"wrapStrategy": "CLIP"}


def test_merged_runs_keep_unknown_members(spark):
    runs = [{"format": {"chip": "a", "bold": True}}, {"startIndex": 3, "format": {"chip": "b", "other": 1}}]
    data = json.dumps([{"values": [{"hyperlink": "h", "textFormatRuns": runs}]}])
    df = spark.createDataFrame([("w", "s", data)], "workbook_id string, sheet_id string, row_data string")
    merged = gf.merge_link_runs(gf.read_cell_meta(df), 0)
    cell = json.loads(gf.rows_json(gf.assemble_rows(merged)).first().row)["values"][0]
    assert cell["textFormatRuns"] == [{"format": {"bold": True, "link": {"uri": "h"}, "chip": "b", "other": 1}}]


def test_a_value_of_another_kind_is_an_error(spark):
    df = spark.createDataFrame([("w", "s", '[{"values":[{"textFormatRuns":"x"}]}]')], "workbook_id string, sheet_id string, row_data string")
    with pytest.raises(Exception):
        gf.read_cell_meta(df).collect()


def test_text_read_by_the_schema_alone_equals_text_read_member_by_member(spark):
    from gridframe.functions import json_text

    cells = [
        json.dumps({"formattedValue": 'a: [b] \\ "c: \\"', "note": "x"}),
        '{"effectiveFormat":{"backgroundColor":{"red":1,"green":0.5},"textFormat":{"fontSize":10}}}',
        '{"note":[1,2]}',
        '{"note":null,"hyperlink":"h"}',
        '{"formattedValue":5,"userEnteredFormat":{}}',
        '{"textFormatRuns":[{"startIndex":1,"format":{"bold":true}},{}],"extra":{"k":1}}',
        '{"unknown":{"note":"n"},"note":"n"}',
        "null",
        "{}",
    ]
    rows = [("w", str(i), f'[{{"values":[{cell}]}},{{}},{{"values":[]}}]') for i, cell in enumerate(cells)]
    df = spark.createDataFrame(rows, "workbook_id string, sheet_id string, row_data string").filter("sheet_id <> '2'")
    by_schema = gf.rows_json(gf.row_positions(df)).collect()
    parsed = df.withColumn("row_data", F.from_json("row_data", gf.sources.schemas.saved_rows()))
    by_member = gf.rows_json(gf.row_positions(parsed)).collect()
    assert len(by_schema) == 24 and sorted(by_schema) == sorted(by_member)
    known = df.select("sheet_id", json_text.members(F.col("row_data")).alias("n")).collect()
    assert {r.sheet_id: r.n for r in known}["0"] == 7


def test_segments_side_by_side(spark):
    rows = [
        ("w", "a", 0, 0, '[{"values":[{"note":"1"}]},{}]'),
        ("w", "a", 0, 2, '[{"values":[{"note":"3"}]},{},{"values":[{"note":"z"}]}]'),
        ("w", "a", 0, 1, '[{"values":[{"note":"2"},{"note":"gone"},{"note":"4"}]}]'),
        ("w", "b", 5, 1, '[{"values":[{"note":"only"}]}]'),
    ]
    df = spark.createDataFrame(rows, "workbook_id string, sheet_id string, start_row int, start_col int, row_data string")
    found = {(r.sheet_id, r.row_idx): r["values"] and [v and v.note for v in r["values"]] for r in gf.row_positions(df).collect()}
    assert found == {("a", 0): ["1", "2", "3"], ("a", 1): None, ("a", 2): [None, None, "z"], ("b", 5): [None, "only"]}


def test_rows_of_one_file_split_are_read_on_all_cores(spark):
    """Segments from one partition are parsed in as many tasks as there are cores, with the same rows."""
    text = '[{"values":[{"formattedValue":"a","odd":1}]},{"values":[{"note":"n"}]}]'
    segments = spark.range(0, 200, 1, numPartitions=1).select(
        F.lit("wb").alias("workbook_id"), F.col("id").cast("string").alias("sheet_id"), F.lit(text).alias("row_data")
    )
    rows = gf.row_positions(segments)
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert rows.count() == 400
    assert gf.read_cell_meta(segments).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
