import random

import pytest
from pyspark.sql import functions as F

import gridframe as gf


def files(folder):
    return {str(f.relative_to(folder)) for f in folder.rglob("*.parquet")}


def cells(grid):
    return {(r.workbook_id, r.sheet_id, r.row_idx): (r.sheet_title, r.cells, r.hidden) for r in grid.collect()}


@pytest.mark.parametrize(
    "options",
    [
        {"row_number_to_push_into": 26, "column_letter_to_push_into": "B", "do_not_clear_entire_target_sheet_range": True},
        {"row_number_to_push_into": 71, "column_letter_to_push_into": "A"},
        {"row_number_to_push_into": 71, "column_letter_to_push_into": "A", "sheet_name_or_id": "5", "col_count": 3},
        {"row_number_to_push_into": 95, "column_letter_to_push_into": "C", "starting_row_filter_index": 42, "starting_column_filter_index": 0, "apply_filter_to_column_index": 0, "string_exclusion_filter": "r50"},
    ],
)
def test_refresh_in_place_equals_refresh_and_touches_only_its_chunks(spark, tmp_path, make_grid, options):
    options = {"sheet_name_or_id": "S", **options}
    rows = {("wb", "5", "S"): [[f"r{i}", "x", "y"] for i in range(100)], ("wb", "", "T"): [["t"]] * 30, ("w2", "5", "S"): [["other"]] * 15}
    grid = make_grid(rows).withColumn("hidden", (F.col("row_idx") == 3) & (F.col("sheet_title") == "S") & (F.col("workbook_id") == "wb"))
    path = tmp_path / "grid"
    gf.store_grid(grid, str(path), chunk_rows=10)
    df = spark.createDataFrame([(i, f"n{i}") for i in range(8)], "k long, v string")
    expected = cells(gf.refresh(grid, df, "wb", order_by=["k"], **options))
    assert cells(gf.read_stored(spark, str(path))) == cells(grid)
    before = files(path)
    gf.refresh_stored(spark, str(path), df, "wb", order_by=["k"], **options)
    assert cells(gf.read_stored(spark, str(path))) == expected
    kept = before & files(path)
    first = options["row_number_to_push_into"] - 1
    last = first + 10 if "do_not_clear_entire_target_sheet_range" in options else 99
    first = min(first, options.get("starting_row_filter_index", first))
    changed = {0} | set(range(first // 10, last // 10 + 1))  # the hidden row is in chunk 0
    gone = {name for name in before if "workbook_id=wb/sheet_id=5/" in name and int(name.split("chunk=")[1].split("/")[0]) in changed}
    assert gone and before - kept == gone


def test_new_sheet_in_place(spark, tmp_path, make_grid):
    path = str(tmp_path / "grid")
    gf.store_grid(make_grid([["a"]] * 25), path, chunk_rows=10)
    df = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(ValueError):
        gf.refresh_stored(spark, path, df, "wb", "New", 1, "A", ["k"])
    gf.refresh_stored(spark, path, df, "wb", "New", 1, "A", ["k"], create=True)
    found = cells(gf.read_stored(spark, path))
    assert found["wb", "", 0] == ("New", ["k"], False) and found["wb", "", 1] == ("New", ["1"], False) and len(found) == 27


def test_blocks_in_one_pass_equal_blocks_in_turn(spark, make_grid):
    rng = random.Random(1)
    grid = make_grid({("w", "a", "A"): [["0"] * 4] * 6, ("w", "b", "B"): [[]]})
    blocks = []
    for place in range(25):
        values = [rng.choice([None, [], [f"{place}.{j}"] * rng.randrange(1, 4)]) for j in range(rng.randrange(1, 4))]
        blocks.append(("w", rng.choice(["a", "b", "new"]), place, rng.randrange(9), rng.randrange(6), values))
    df = spark.createDataFrame(blocks, "workbook_id string, sheet_id string, place int, row int, col int, values array<array<string>>").repartition(3)
    found = {(r.sheet_id, r.row_idx): r.cells for r in gf.overlay_blocks(grid, df).collect()}
    expected = {("a", i): ["0"] * 4 for i in range(6)} | {("b", 0): []}
    for _, sheet, _, row, col, values in blocks:
        for j, line in enumerate(values):
            if line is not None:
                old = expected.get((sheet, row + j), [])
                old = old + [""] * (col - len(old))
                expected[sheet, row + j] = old[:col] + line + old[col + len(line) :]
    assert found == expected
    assert gf.overlay_blocks(grid, df.limit(0)).count() == grid.count()


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_criteria_of_several_columns_and_sheets(spark, make_grid, broadcast_bytes):
    sheet = [["h", "h"], ["a", "1"], ["b", "2"], ["", None], ["c"], ["a", "3"]]
    grid = make_grid({("w", "x", "X"): sheet, ("w", "y", "Y"): sheet, ("w", "z", "Z"): sheet}).withColumn("hidden", F.col("row_idx") == 1)
    criteria = [("w", "x", 0, "a"), ("w", "x", 0, "a"), ("w", "x", 1, None), ("w", "x", 0, "h"), ("w", "y", 7, "q"), ("w", "none", 0, "a")]
    df = spark.createDataFrame(criteria, "workbook_id string, sheet_id string, column int, value string")
    hidden = sorted((r.sheet_id, r.row_idx) for r in gf.apply_criteria(grid, df, 0, broadcast_bytes).filter("hidden").collect())
    # Sheet y has criteria that hide nothing; z has none and stays as it was.
    assert hidden == [("x", 1), ("x", 3), ("x", 4), ("x", 5), ("z", 1)]
    assert gf.apply_criteria(grid, df, 0, broadcast_bytes).count() == 18
