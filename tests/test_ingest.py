import json

import pytest
from pyspark.sql import functions as F

import gridframe as gf

RAGGED = [["A", "B"], [], ["1", "2", "3"], ["", ""]]


def test_values_to_grid(spark, lines):
    body = json.dumps({"range": "'It''s here'!A1:C4", "values": [["Name", "Age"], ["Alice", 28], [], [None, True, "x"]]})
    empty = json.dumps({"range": "Other!A1:Z9", "majorDimension": "ROWS"})
    df = spark.createDataFrame([("wb", "7", body), ("wb", "8", empty)], "workbook_id string, sheet_id string, body string")
    grid = gf.values_to_grid(df, "body")
    assert lines(grid) == [["Name", "Age"], ["Alice", "28"], [], [None, "true", "x"]]
    assert {tuple(r) for r in grid.select("workbook_id", "sheet_id", "sheet_title").collect()} == {("wb", "7", "It's here")}


def test_a_broken_body_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([('{"values": [["a"]',)], "body string")
    with pytest.raises(Exception, match="MALFORMED"):
        gf.values_to_grid(df, "body").collect()
    (tmp_path / "bad.json").write_text('{"values": [["a"]')
    with pytest.raises(Exception, match="MALFORMED"):
        gf.read_values(spark, str(tmp_path / "bad.json")).collect()


def test_read_values_from_files(spark, tmp_path, lines):
    records = [
        {"workbook_id": "w", "sheet_id": "1", "range": "S!A1:B2", "values": [["a", "b"], ["c", "d"]]},
        {"workbook_id": "w", "sheet_id": "1", "range": "S!B4", "values": [["e"], [], ["f"]]},
        {"workbook_id": "w", "sheet_id": "2", "range": "Empty!A1:B2"},
    ]
    path = tmp_path / "bodies.json"
    path.write_text("\n".join(json.dumps(r) for r in records))
    placed = gf.read_values(spark, str(path), positions="range")
    assert lines(placed, sparse=True) == {0: ["a", "b"], 1: ["c", "d"], 3: ["", "e"], 4: [], 5: ["", "f"]}
    assert gf.read_values(spark, str(path)).count() == 5
    with pytest.raises(ValueError):
        gf.read_values(spark, str(path), positions="elsewhere")


def test_select_sheet(make_grid):
    grid = make_grid({("w", "12", "Data"): [["x"]], ("w", "3", "12a"): [["y"]], ("v", "12", "Data"): [["z"]]})
    assert {r.cells[0] for r in gf.select_sheet(grid, "12").collect()} == {"x", "z"}
    assert {r.cells[0] for r in gf.select_sheet(grid, "12a").collect()} == {"y"}
    assert {r.cells[0] for r in gf.select_sheet(grid, 12, workbook_id="v").collect()} == {"z"}
    assert gf.select_sheet(grid, "Data").count() == 2


def test_cell_range(make_grid, lines):
    grid = make_grid([[f"{c}{r}" for c in "ABCDE"] for r in range(1, 6)] + [["A6"]])
    assert lines(gf.cell_range(grid, "B2:C3"), sparse=True) == {0: ["B2", "C2"], 1: ["B3", "C3"]}
    assert lines(gf.cell_range(grid, "D4:Z"), sparse=True) == {0: ["D4", "E4"], 1: ["D5", "E5"], 2: []}
    assert lines(gf.cell_range(grid, "5:6")) == [["A5", "B5", "C5", "D5", "E5"], ["A6"]]
    assert lines(gf.cell_range(grid, None)) == lines(grid)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_pad_drop_promote(make_grid, lines, broadcast_bytes):
    grid = make_grid({("w", "1", "R"): RAGGED, ("w", "2", "S"): [[None, "x"], ["y"]]})
    padded = gf.pad_rows(grid, broadcast_bytes)
    assert lines(padded) == [["A", "B", ""], ["", "", ""], ["1", "2", "3"], ["", "", ""], ["", "x"], ["y", ""]]
    kept = gf.drop_empty_rows(padded)
    assert lines(kept, sparse=False) == [["A", "B", ""], ["1", "2", "3"], ["", "x"], ["y", ""]]
    header, body = gf.promote_header(kept, broadcast_bytes)
    assert [r.header for r in header.orderBy("sheet_id").collect()] == [["a", "b", ""], ["", "x"]]
    assert lines(body) == [["1", "2", "3"], ["y", ""]]


def test_tall_sheet_is_joined_in_chunks(spark, monkeypatch):
    """The way beyond the broadcast limit gives the same rows, and spreads one sheet."""
    from gridframe.operators import extent

    monkeypatch.setattr(extent, "CHUNK_ROWS", 100)
    grid = spark.range(1000).select(
        F.lit("w").alias("workbook_id"),
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("sheet_id"),
        F.lit("t").alias("sheet_title"),
        F.col("id").alias("row_idx"),
        F.transform(F.sequence(F.lit(0), F.col("id") % 4), lambda x: x.cast("string")).alias("cells"),
    )
    small, chunked = gf.pad_rows(grid), gf.pad_rows(grid, broadcast_bytes=-1)
    assert small.exceptAll(chunked).count() == 0 and chunked.exceptAll(small).count() == 0
    assert small.count() == 1000
    plan = chunked._jdf.queryExecution().optimizedPlan().toString()
    assert "__chunk" in plan
    one, other = gf.grid_to_records(grid), gf.grid_to_records(grid, broadcast_bytes=-1)
    as_text = lambda df: sorted(map(str, df.select("sheet_id", "row_idx", F.to_json("record")).collect()))
    assert as_text(one) == as_text(other)


def test_falsy_text_is_kept(make_grid, lines):
    assert lines(gf.drop_empty_rows(make_grid([["0"], ["FALSE"], [" "], [""], [None]]))) == [["0"], ["FALSE"], [" "]]


def test_read_sheet(spark, make_grid):
    grid = make_grid([["", ""], ["First Name", "Age!", "Age?"], ["Al", "28"], [], ["", "", ""], ["Bo", "35", "x"]])
    table = gf.read_sheet(spark, grid, "wb", "0", temp_view_name="people")
    assert table.columns == ["first_name", "age", "age1"]
    assert table.orderBy("first_name").collect() == spark.sql("select * from people order by first_name").collect()
    assert [tuple(r) for r in table.orderBy("first_name").collect()] == [("Al", "28", ""), ("Bo", "35", "x")]
    raw = gf.read_sheet(spark, grid, "wb", "Sheet1", drop_empty_rows=False)
    assert raw.columns == ["_c0", "1", "2"] and raw.count() == 5
    assert gf.read_sheet(spark, grid, "wb", "0", clean_column_names=False).columns == ["first name", "age!", "age?"]
    ranged = gf.read_sheet(spark, grid, "wb", "0", cell_range="A2:B3")
    assert [r.asDict() for r in ranged.collect()] == [{"first_name": "Al", "age": "28"}]
    assert all(f.dataType.simpleString() == "string" for f in table.schema)


def test_dropped_rows_count_for_the_width(spark, make_grid):
    assert gf.read_sheet(spark, make_grid([["a", "b"], ["", "", ""], ["1"]]), "wb", "0").columns == ["a", "b", "_c2"]


def test_names_never_repeat(spark, make_grid):
    grid = make_grid([["A", "a", "a1"], ["1", "2", "3"]])
    for unique in (True, False):
        for clean in (True, False):
            columns = gf.read_sheet(spark, grid, "wb", "0", unique, clean).columns
            assert len(set(columns)) == 3


def test_empty_sheets(spark, make_grid):
    for rows in ([], [["", ""], [""]]):
        table = gf.read_sheet(spark, make_grid(rows), "wb", "0", temp_view_name="nothing")
        assert table.columns == [] and table.count() == 0
        kept = gf.drop_empty_rows(gf.pad_rows(make_grid(rows)))
        header, body = gf.promote_header(kept)
        assert header.count() == 0 and body.count() == 0
        assert gf.grid_to_records(kept).count() == 0
    assert gf.grid_to_table(make_grid([["Only", "header"]])).columns == ["only", "header"]


def test_records_of_sheets_with_differing_headers(make_grid):
    grid = make_grid({("w", "1", "A"): [["Id", "Id", "Na me"], ["1", "2"]], ("w", "2", "B"): [["K", ""], ["v", "w"]]})
    records = {(r.sheet_id, r.row_idx): r.record for r in gf.grid_to_records(grid).collect()}
    assert records == {("1", 1): {"id": "1", "id1": "2", "na_me": ""}, ("2", 1): {"k": "v", "": "w"}}


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_records_without_empty_rows_in_one_pass(make_grid, broadcast_bytes):
    grid = make_grid({
        ("w", "1", "A"): [["", "", "", ""], ["Id", "Na me"], ["", ""], ["1", "2"], [], ["3"]],
        ("w", "2", "B"): [["K"], ["v"]],
        ("w", "3", "C"): [[""], []],
    })
    step_by_step = gf.grid_to_records(gf.drop_empty_rows(gf.pad_rows(grid)))
    at_once = gf.grid_to_records(grid, drop_empty_rows=True, broadcast_bytes=broadcast_bytes)
    records = {(r.sheet_id, r.row_idx): r.record for r in at_once.collect()}
    assert records == {(r.sheet_id, r.row_idx): r.record for r in step_by_step.collect()}
    assert records[("1", 5)] == {"id": "3", "na_me": "", "": "", "1": ""} and len(records) == 3


def test_extents_combine_by_hash_before_the_shuffle(make_grid):
    from gridframe.operators.extent import sheet_extents

    plan = sheet_extents(make_grid([["a"]]))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and plan.count("HashAggregate") == 2


def test_stored_grid_prunes_by_sheet(spark, tmp_path, make_grid, lines):
    grid = make_grid({("w", str(s), f"T{s}"): [[str(s), str(r)] for r in range(20)] for s in range(6)})
    path = str(tmp_path / "grid")
    gf.write_grid(grid, path)
    stored = gf.read_grid(spark, path)
    assert lines(stored) == lines(grid)
    plan = gf.select_sheet(stored, "3")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(sheet_id,3)" in plan


def test_narrow_operators_on_a_stream(spark, tmp_path):
    """Operators without a shuffle run unchanged on a stream of values bodies."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "one.json").write_text(json.dumps({"range": "S!A1", "values": [["a"], [""], ["b"]]}))
    from gridframe.sources.schemas import VALUES_RECORD

    rows = gf.drop_empty_rows(gf.values_to_grid(spark.readStream.schema(VALUES_RECORD).json(str(source))))
    query = rows.writeStream.format("memory").queryName("grid_rows").outputMode("append").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert {r.row_idx for r in spark.table("grid_rows").collect()} == {0, 2}


def test_titles_and_dimensions_of_bodies(spark, lines):
    bodies = [
        {"range": "'Hi! there'!A1:B2", "majorDimension": "COLUMNS", "values": [["a", "b", "c"], ["d"]]},
        {"range": "Hi! you!A1", "majorDimension": "ROWS", "values": [["x"]]},
        {"range": "E!A1", "majorDimension": "COLUMNS", "values": []},
    ]
    grid = gf.values_to_grid(spark.createDataFrame([(json.dumps(b),) for b in bodies], "body string"), "body")
    by_title = {r.sheet_title: [x.cells for x in grid.filter(F.col("sheet_title") == r.sheet_title).orderBy("row_idx").collect()] for r in grid.collect()}
    assert by_title == {"Hi! there": [["a", "d"], ["b", ""], ["c", ""]], "Hi! you": [["x"]]}


def test_a_stored_grid_keeps_what_is_hidden(spark, tmp_path, make_grid):
    grid = gf.apply_filter(make_grid([["h"], ["x"], [""], ["y"]]))
    gf.write_grid(grid, str(tmp_path / "g"), rows_per_file=2)
    back = gf.read_grid(spark, str(tmp_path / "g"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, grid.collect()))
    assert len(list((tmp_path / "g").glob("part-*"))) == 2
    plain = make_grid([["h"]])
    gf.write_grid(plain, str(tmp_path / "p"))
    assert gf.read_grid(spark, str(tmp_path / "p")).columns == plain.columns


def test_a_table_is_one_sheet(make_grid):
    with pytest.raises(ValueError, match="several sheets"):
        gf.grid_to_table(make_grid({("w", "1", "A"): [["a"]], ("w", "2", "B"): [["b"]]}))


def test_a_sheet_is_read_twice(spark, make_grid):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    grid = make_grid([["h", "i"], ["1", "2"], ["", ""]]).coalesce(1)
    grid = grid.mapInArrow(counted, grid.schema)
    assert gf.read_sheet(spark, grid, "wb", "0").count() == 1
    assert reads.value == 2


def test_number_rows_computes_its_frame_three_times(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        reads.add(1)
        yield from batches

    df = spark.range(0, 5000, 1, 1).mapInArrow(counted, "id bigint")
    numbered, total = gf.number_rows(df, ["id"], rows_per_bucket=700)
    assert total == 5000 and numbered.filter("row_idx <> id").count() == 0 and numbered.count() == 5000
    assert reads.value <= 3
