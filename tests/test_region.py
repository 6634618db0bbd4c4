import pytest
from pyspark.sql import functions as F

import gridframe as gf

TARGET = [["r1a", "r1b", "r1c"], ["r2a", "r2b", "r2c"], ["r3a"], ["r4a", "r4b", "r4c", "r4d"]]


def visible(grid):
    return [r.row_idx for r in grid.filter("not hidden").orderBy("row_idx").collect()]


def test_overlay_replaces_keeps_and_extends(make_grid, lines):
    target = make_grid(TARGET)
    payload = make_grid([["X", "Y"], ["Z", "W"]])
    assert lines(gf.overlay(target, payload, 1, 1)) == [
        ["r1a", "r1b", "r1c"], ["r2a", "X", "Y"], ["r3a", "Z", "W"], ["r4a", "r4b", "r4c", "r4d"]]
    assert lines(gf.overlay(make_grid([["a"]]), make_grid([["X", "Y"]]), 0, 3)) == [["a", "", "", "X", "Y"]]
    longer = gf.overlay(make_grid([["a"], ["b"]]), make_grid([["1"], ["2"], ["3"], ["4"]]), 0, 0)
    assert lines(longer) == [["1"], ["2"], ["3"], ["4"]]
    assert lines(gf.overlay(target, payload, 9, 0), sparse=True)[10] == ["Z", "W"]


def test_overlay_leaves_the_rest_untouched(spark, make_grid):
    import random

    rng = random.Random(9)
    for _ in range(5):
        rows = [[f"t{r}{c}" for c in range(rng.randint(0, 6))] for r in range(rng.randint(1, 7))]
        block = [[f"p{r}{c}" for c in range(3)] for r in range(rng.randint(1, 4))]
        row, col = rng.randint(0, 5), rng.randint(0, 5)
        got = {r.row_idx: r.cells for r in gf.overlay(make_grid(rows), make_grid(block), row, col).collect()}
        for r in range(max(len(rows), row + len(block))):
            for c in range(12):
                old = rows[r][c] if r < len(rows) and c < len(rows[r]) else ""
                inside = row <= r < row + len(block) and col <= c < col + 3
                new = block[r - row][c - col] if inside else old
                cells = got.get(r, [])
                assert (cells[c] if c < len(cells) else "") == new


def test_documented_write_block(make_grid, lines):
    block = make_grid([["Town", "Rank"], ["Oslo", "3"], ["Rome", "1"]])
    assert lines(gf.overlay(make_grid([]), block, 0, 0)) == [["Town", "Rank"], ["Oslo", "3"], ["Rome", "1"]]


def test_overlay_many_sheets_and_new_sheet(make_grid):
    target = make_grid({("w", "1", "A"): [["a"]], ("w", "2", "B"): [["b"]]})
    payload = make_grid({("w", "2", "B"): [["x"]], ("w", "3", "C"): [["y"]]})
    got = {(r.sheet_id, r.sheet_title, r.row_idx): r.cells for r in gf.overlay(target, payload, 0, 0).collect()}
    assert got == {("1", "A", 0): ["a"], ("2", "B", 0): ["x"], ("3", "C", 0): ["y"]}


def test_clear_region(make_grid, lines):
    grid = make_grid(TARGET)
    assert lines(gf.clear_region(grid, 1, 1)) == [["r1a", "r1b", "r1c"], ["r2a", "", ""], ["r3a"], ["r4a", "", "", ""]]
    assert lines(gf.clear_region(grid, 1, 0, end_col=2, end_row=3)) == [
        ["r1a", "r1b", "r1c"], ["", "", "r2c"], [""], ["r4a", "r4b", "r4c", "r4d"]]


def test_filters(make_grid):
    grid = make_grid([["h", "x", "out"], ["", "x", "out"], ["k", "x", "no"], ["", "y"], ["m", "z", "out"]])
    assert visible(gf.apply_filter(grid)) == [0, 2, 4]
    by_text = gf.apply_filter(grid, filter_col=2, start_row=1, exclude="out")
    assert visible(by_text) == [0, 1, 2, 3]
    assert visible(gf.apply_filter(grid, filter_col=2)) == [0, 1, 2, 4]
    assert visible(gf.remove_filter(by_text)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        gf.apply_filter(grid, filter_col=-1)


def test_write_batches_round_trip(spark, tmp_path, make_grid, lines):
    grid = make_grid({("w", "1", "A"): [[str(i)] for i in range(12)], ("w", "2", "Hi! it's: B"): [["x", str(i)] for i in range(11)]})
    grid = grid.filter("row_idx not in (0, 3, 6, 7) or sheet_id = '2'").unionAll(make_grid({("w", "1", "A"): [["first"]]}))
    batches = gf.write_batches(grid, rows_per_batch=5)
    got = {(r.sheet_id, r.batch_no): (r.range, r["values"]) for r in batches.collect()}
    assert got == {
        ("1", 0): ("A!A1", [["first"], ["1"], ["2"], [], ["4"]]),
        ("1", 1): ("A!A6", [["5"], [], [], ["8"], ["9"]]),
        ("1", 2): ("A!A11", [["10"], ["11"]]),
        ("2", 0): ("'Hi! it''s: B'!A1", [["x", str(i)] for i in range(5)]),
        ("2", 1): ("'Hi! it''s: B'!A6", [["x", str(i)] for i in range(5, 10)]),
        ("2", 2): ("'Hi! it''s: B'!A11", [["x", "10"]]),
    }
    path = str(tmp_path / "batches")
    batches.write.json(path)
    again = gf.read_values(spark, path, positions="range")
    for title in ("A", "Hi! it's: B"):
        filled = {i: cells for i, cells in lines(again.filter(F.col("sheet_title") == title), sparse=True).items() if cells}
        assert filled == lines(grid.filter(F.col("sheet_title") == title), sparse=True)


def test_batch_address_with_colon_title(make_grid):
    assert gf.write_batches(make_grid([["x"]], title="Q1:Q2")).first().range == "'Q1:Q2'!A1"


PEOPLE = [("Ines", 41), ("Hugo", 52), ("Clara", 63)]


def test_documented_refresh(spark, make_grid, lines):
    df = spark.createDataFrame(PEOPLE, "name string, age bigint")
    old = make_grid({("wb", "0", "Sheet1"): [["keep"]] + [[f"o{r}", f"p{r}", f"q{r}"] for r in range(8)], ("wb", "1", "Other"): [["x"]]})
    new = gf.refresh(old, df, "wb", "Sheet1", 2, "A", ["name"], starting_row_filter_index=1, starting_column_filter_index=0,
                     apply_filter_to_column_index=1)
    sheet = lines(gf.select_sheet(new, "0"))
    assert sheet[:5] == [["keep"], ["name", "age", "q0"], ["Clara", "63", ""], ["Hugo", "52", ""], ["Ines", "41", ""]]
    assert all(set(cells) == {""} for cells in sheet[5:]) and len(sheet) == 9
    # The filter hides the rows whose column B is blank, below its own header row.
    assert visible(gf.select_sheet(new, "0")) == [0, 1, 2, 3, 4]
    assert lines(gf.select_sheet(new, "1")) == [["x"]]
    with pytest.raises(ValueError):
        gf.refresh(old, df, "wb", "0", 2, "A", ["name"], apply_filter_to_column_index=1)


def test_refresh_keeps_other_content(spark, make_grid, lines):
    df = spark.createDataFrame(PEOPLE[:2], "name string, age bigint")
    rows = [[f"{c}{r}" for c in "ABCDE"] for r in range(1, 8)]
    kept = gf.refresh(make_grid(rows), df, "wb", "0", 2, "B", ["name"], col_count=5, preserve_last_n_columns=1)
    assert lines(kept)[1] == ["A2", "name", "age", "D2", "E2"]
    assert lines(kept)[2] == ["A3", "Hugo", "52", "", "E3"]
    assert lines(kept)[6] == ["A7", "", "", "", "E7"]
    by_count = gf.refresh(make_grid(rows), df, "wb", "0", 2, "B", ["name"], col_count=4, preserve_last_n_columns=1)
    assert lines(by_count)[6] == ["A7", "", "", "D7", "E7"]
    # Bounded: two body rows and one more, two columns from the start column.
    bounded = gf.refresh(make_grid(rows), df, "wb", "0", 2, "B", ["name"], do_not_clear_entire_target_sheet_range=True)
    assert lines(bounded)[2:6] == [
        ["A3", "Hugo", "52", "D3", "E3"], ["A4", "Ines", "41", "D4", "E4"],
        ["A5", "", "", "D5", "E5"], ["A6", "B6", "C6", "D6", "E6"]]


def test_refresh_of_empty_things(spark, make_grid, lines):
    df = spark.createDataFrame(PEOPLE, "name string, age bigint")
    fresh = gf.refresh(make_grid([]), df, "wb", "0", 1, "C", ["age"], create=True)
    assert lines(fresh)[:2] == [["", "", "name", "age"], ["", "", "Ines", "41"]]
    with pytest.raises(ValueError, match="no sheet"):
        gf.refresh(make_grid([["a"]]), df, "wb", "Shet1", 1, "A", ["age"])
    with pytest.raises(ValueError, match="column count"):
        gf.refresh(make_grid([["a"]]), df, "wb", "0", 1, "A", ["age"], preserve_last_n_columns=2)
    listed = spark.createDataFrame([("wb", "0", "Sheet1", 100, 4)], "workbook_id string, sheet_id string, sheet_title string, row_count int, col_count int")
    by_properties = gf.refresh(make_grid([list("abcd")] * 3), df, "wb", "0", 1, "A", ["age"], sheets=listed, preserve_last_n_columns=1)
    assert lines(by_properties)[1] == ["Ines", "41", "", "d"]
    assert lines(gf.refresh(make_grid([]), df, "wb", "0", 1, "A", ["age"], sheets=listed))[1] == ["Ines", "41"]
    only_header = gf.refresh(make_grid([["a"], ["b"]]), df.limit(0), "wb", "0", 1, "A", ["age"])
    assert lines(only_header) == [["name", "age"], [""]]
    bounded = gf.refresh(make_grid([["a"], ["b"], ["c"]]), df.limit(0), "wb", "0", 1, "A", ["age"],
                         do_not_clear_entire_target_sheet_range=True)
    assert lines(bounded) == [["name", "age"], [""], ["c"]]


def test_sheets_without_title_pass_through(spark, make_grid):
    df = spark.createDataFrame(PEOPLE, "name string, age bigint")
    grid = make_grid({("wb", "5", None): [["x"]], ("wb", "0", "Sheet1"): [["y"]]})
    new = gf.refresh(grid, df, "wb", "Sheet1", 1, "A", ["age"])
    assert new.filter("sheet_id = '5'").count() == 1


def test_read_after_refresh_is_the_rendered_frame(spark, make_grid):
    df = spark.createDataFrame(
        [(i, None if i % 3 == 0 else i / 8, f"n{i % 5}", i % 2 == 0, [str(i)] * (i % 3)) for i in range(40)],
        "id int, x double, n string, b boolean, a array<string>",
    )
    sheet = gf.refresh(make_grid([["old"] * 7] * 60), df, "wb", "0", 1, "A", ["id"], rows_per_bucket=9)
    back = gf.read_sheet(spark, sheet, "wb", "0").select(*df.columns)
    text = gf.to_text(df)
    assert back.exceptAll(text).count() == 0 and text.exceptAll(back).count() == 0


def test_refresh_reads_its_sheet_by_pushed_filters(spark, tmp_path, make_grid):
    path = str(tmp_path / "grid")
    gf.write_grid(make_grid({("wb", str(s), f"T{s}"): [["x"]] for s in range(3)}), path)
    new = gf.refresh(gf.read_grid(spark, path), spark.range(3).select("id"), "wb", "1", 1, "A", ["id"])
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(workbook_id,wb), EqualTo(sheet_id,1)" in plan
    assert new.filter("sheet_id = '1'").count() == 4 and new.count() == 6


def test_refresh_joins_once(spark, make_grid):
    df = spark.range(1000).select("id")
    grid = spark.range(1000).select(
        F.lit("wb").alias("workbook_id"), F.lit("0").alias("sheet_id"), F.lit("S").alias("sheet_title"),
        F.col("id").alias("row_idx"), F.array(F.col("id").cast("string")).alias("cells"))
    plan = gf.refresh(grid, df, "wb", "0", 1, "A", ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join") == 2
