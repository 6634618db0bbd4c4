import random

import pytest
from pyspark.sql import functions as F

import gridframe as gf
from gridframe.sources.schemas import GRID


def grid_of(spark, rows, title="Sheet1"):
    """``rows`` is ``{(sheet_id, row_idx): cells}``."""
    return spark.createDataFrame([("wb", s, title, r, cells) for (s, r), cells in rows.items()], GRID)


def texts(grid):
    """Cells that are not blank, by place."""
    return {(g.sheet_id, g.row_idx, c): v for g in grid.collect() for c, v in enumerate(g.cells or []) if v}


def sequential(old, new, height):
    """The same blocks by one pass over the rows, top down."""
    blocks, open_spans = set(), {}
    cell = lambda rows, key, c: (rows[key][c] if key in rows and rows[key] and c < len(rows[key]) else "") or ""
    for key in sorted({*old, *new}):
        wide = max(len(v) for rows in (old, new) for k, v in rows.items() if k == key and v is not None) if any(rows.get(key) for rows in (old, new)) else 0
        row, c = [], 0
        while c < wide:
            if cell(old, key, c) == cell(new, key, c):
                c += 1
                continue
            start = c
            while c < wide and cell(old, key, c) != cell(new, key, c):
                c += 1
            row.append((start, c))
        sheet, r = key
        now = {}
        for span in row:
            first = open_spans.get((sheet, r - 1, span)) if r % height else None
            now[sheet, r, span] = r if first is None else first
        for (s, r0, span), first in now.items():
            blocks.discard((s, first, r0, span))
            blocks.add((s, first, r0 + 1, span))
        open_spans = now
    return blocks


def test_blocks_turn_the_old_version_into_the_new(spark):
    rng = random.Random(4)
    cell = lambda: rng.choice(["a", "b", "", None])
    for height in (1, 4, 500):
        old, new = ({(s, r): [cell() for _ in range(rng.randint(0, 6))] for s in "pq" for r in range(14) if rng.random() < 0.8} for _ in "on")
        # Long equal stretches, so that blocks are tall.
        new |= {("p", r): [*(old.get(("p", r)) or []), "z", "z"][:4] for r in range(5, 10)}
        before, after = grid_of(spark, old), grid_of(spark, new)
        blocks = gf.changed_blocks(before, after, height)
        found = [(b.sheet_id, b.row, b.end_row, (b.col, b.end_col)) for b in blocks.collect()]
        assert len(found) == len(set(found)) and set(found) == sequential(old, new, height)
        assert texts(gf.overlay_blocks(before, blocks)) == texts(after)


def test_block_shape_title_and_address(spark):
    old = grid_of(spark, {("p", 1): ["a", "b"], ("p", 2): ["a", "b"], ("p", 9): ["x"]}, "It's")
    new = grid_of(spark, {("p", 1): ["a", "c", "d"], ("p", 2): ["a", "e", "f"], ("q", 0): ["n"]}, "Other")
    got = {b.range: b for b in gf.changed_blocks(old, new).collect()}
    assert set(got) == {"'It''s'!B2", "'It''s'!A10", "Other!A1"}
    block = got["'It''s'!B2"]
    assert (block.row, block.end_row, block.col, block.end_col, block["values"]) == (1, 3, 1, 3, [["c", "d"], ["e", "f"]])
    assert got["'It''s'!A10"]["values"] == [[""]]


def test_equal_versions_have_no_blocks(spark):
    old = grid_of(spark, {("p", 0): ["a", None, ""], ("p", 1): None, ("p", 2): []})
    assert gf.changed_blocks(old, grid_of(spark, {("p", 0): ["a"], ("p", 3): ["", None]})).count() == 0
    assert gf.changed_blocks(old.limit(0), old.limit(0)).count() == 0
    with pytest.raises(ValueError):
        gf.changed_blocks(old, old, 0)


def test_blocks_spread_a_tall_sheet(spark):
    tall = spark.range(5_000).select(
        F.lit("wb").alias("workbook_id"), F.lit("p").alias("sheet_id"), F.lit("T").alias("sheet_title"), F.col("id").alias("row_idx"), F.array(F.lit("a")).alias("cells")
    )
    blocks = gf.changed_blocks(tall, tall.withColumn("cells", F.array(F.lit("b"))), 1_000).orderBy("row").collect()
    assert [(b.row, b.end_row, len(b["values"])) for b in blocks] == [(i, i + 1_000, 1_000) for i in range(0, 5_000, 1_000)]


def test_batches_by_bytes_are_those_of_a_sequential_pass(spark):
    import json

    rng = random.Random(8)
    as_json = lambda value: json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    rows = {r: [rng.choice(["", 'q"', "ü" * rng.randint(0, 30), "x" * rng.randint(0, 90)]) for _ in range(rng.randint(0, 3))] for r in range(120) if rng.random() < 0.7}
    grid = grid_of(spark, {("p", r): cells for r, cells in rows.items()})
    for budget in (1, 60, 300, 10**6):
        wanted = []
        for r in sorted(rows):
            last = wanted[-1] if wanted else None
            longer = last and last[2] + [[]] * (r - last[1] - len(last[2])) + [rows[r]]
            if last and r // 50 == last[0] and len(as_json(longer).encode()) - 1 <= budget:
                last[2] = longer
            else:
                wanted.append([r // 50, r, [rows[r]]])
        got = gf.write_batches(grid, 50, budget).orderBy("batch_no", "part_no").collect()
        assert [(b.batch_no, b.range, b["values"]) for b in got] == [(n, f"Sheet1!A{r + 1}", v) for n, r, v in wanted]
    with pytest.raises(ValueError):
        gf.write_batches(grid, 50, 0)
