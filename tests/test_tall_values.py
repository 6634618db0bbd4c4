import json
import random

import pytest

import gridframe as gf

SPLIT_SETTINGS = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    before = {key: spark.conf.get(key) for key in SPLIT_SETTINGS}
    for key, value in SPLIT_SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def write(folder, bodies):
    folder.mkdir()
    for name, body in bodies.items():
        (folder / name).write_text(body, encoding="utf-8", newline="")
    return str(folder)


def rows(grid):
    return sorted((r.workbook_id, r.sheet_id, r.sheet_title, r.row_idx, r.cells) for r in grid.collect())


def test_rows_equal_those_of_the_whole_body_reader(small_splits, tmp_path):
    rng = random.Random(5)
    bits = ["a", "]", "[", '"', "\\", "\\\\", "],[", '["', '"]', "é🙂", "\n", "\t", ",", "{", "}", " ", "x" * 150]
    cell = lambda: rng.choice([None, True, 7, 1.5, "".join(rng.choice(bits) for _ in range(rng.randrange(6)))])
    lists = [[[cell() for _ in range(rng.randrange(5))] for _ in range(rng.choice([0, 1, 3, 80, 80]))] for _ in range(12)]
    records = [{"range": f"'S[{i}] \"x\"'!C{i + 3}:Z99", "majorDimension": "ROWS", "values": values} for i, values in enumerate(lists)]
    records[3] = {"values": lists[2] or [["y"]], "range": "late]!B2", "workbook_id": "w[1]", "sheet_id": 5}
    records.append({"range": "no values]!A1"})
    records.append({})
    bodies = {f"{i}.json": json.dumps(r, indent=i % 3 or None, ensure_ascii=bool(i % 2)) + "\n" * (i % 2) for i, r in enumerate(records)}
    tall, lines = write(tmp_path / "tall", bodies | {"empty.json": "", "blank.json": " \n"}), write(tmp_path / "lines", {"all.json": "\n".join(map(json.dumps, records))})
    splits = small_splits.read.option("lineSep", "]").text(tall).rdd.getNumPartitions()
    assert splits > 20
    for positions in ("body", "range"):
        expected = rows(gf.read_values(small_splits, lines, positions=positions))
        assert len(expected) > 90 and rows(gf.read_tall_values(small_splits, tall, positions=positions)) == expected


def test_facts_of_many_splits_are_joined(small_splits, tmp_path, monkeypatch):
    from gridframe.sources import tall

    body = json.dumps({"range": "S!A1", "values": [[f"r{i}", "[x]" * (i % 4)] for i in range(300)]})
    monkeypatch.setattr(tall, "BROADCAST_SPLITS", 0)
    found = rows(gf.read_tall_values(small_splits, write(tmp_path / "one", {"a.json": body})))
    exploded = gf.grid_to_cells(gf.read_tall_values(small_splits, str(tmp_path / "one")))
    assert exploded.count() == 600
    assert [(i, cells) for *_, i, cells in found] == [(i, [f"r{i}", "[x]" * (i % 4)]) for i in range(300)]


@pytest.mark.parametrize(
    ("body", "fault"),
    [
        ('{"values":[["a"],["b', "ends early"),
        ('{"values":[["a"],["b"]', "ends early"),
        ('{"values":[["a"],["b"]]}\n{"values":[["c"]]}', "more than one body"),
        ('{"values":["a","b"]}', "not lists"),
        ('{"values":[["a"],null,["b"]]}', "not lists"),
        ('{"values":[["a",["b"]],["c"]]}', ""),
        ('{"majorDimension":"COLUMNS","values":[["a"]]}', "by columns"),
        ('{"range":"S!A1","values":[["a"]]', "ends early|Malformed|malformed"),
    ],
)
def test_faulty_files_are_errors(spark, tmp_path, body, fault):
    with pytest.raises(Exception, match=f"(?s){fault}"):
        gf.read_tall_values(spark, write(tmp_path / "bad", {"a.json": body})).collect()


def test_counts_within_a_split_hold_no_window_over_the_split(spark, tmp_path):
    """A window over a whole split buffers and spills all its pieces in one task; the counts stream instead."""
    from gridframe.sources import tall

    body = json.dumps({"range": "S!A1", "majorDimension": "ROWS", "values": [[str(i), f"[{i}]"] for i in range(50)]})
    counted = tall._counted(tall._pieces(spark, write(tmp_path / "w", {"a.json": body})))
    assert "Window" not in counted._jdf.queryExecution().executedPlan().toString()
    first = counted.filter("opening").collect()
    assert len(first) == 1 and first[0].starts_out == 1
