import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridframe import clean_names, col_letters, col_number, column_index, distinct_names, parse_range, range_address, unique_names
from gridframe.functions.address import address_cells, address_title, letters_of
from gridframe.functions.names import clean_name_list, table_name_list, unique_name_list
from gridframe.functions.names import record_names

REPEATED = [
    (["a", "a", "a"], ["a", "a1", "a2"]),
    (["a", "a", "b", "a"], ["a", "a1", "b", "a2"]),
    (["a", "a", "a1"], ["a", "a1", "a1"]),
    ([], []),
    (["", ""], ["", "1"]),
]
DIRTY = [("First Name", "first_name"), (" X y__", "_x_y"), ("é%", ""), ("a b", "a_b"), ("a-b", "a_b"), ("A  -- b!!", "a_b")]


def names_of(spark, function, headers):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i int, h array<string>")
    return [r.o for r in df.select("i", function(F.col("h")).alias("o")).orderBy("i").collect()]


def test_unique_names(spark):
    assert names_of(spark, unique_names, [h for h, _ in REPEATED]) == [o for _, o in REPEATED]
    assert [unique_name_list(h) for h, _ in REPEATED] == [o for _, o in REPEATED]


def test_clean_names(spark):
    raw, expected = zip(*DIRTY)
    assert names_of(spark, clean_names, [list(raw)]) == [list(expected)]
    assert clean_name_list(list(raw)) == list(expected)


def test_column_and_list_forms_agree(spark):
    rng = random.Random(5)
    headers = [["".join(rng.choices("ab1 _é", k=rng.randint(0, 3))) for _ in range(rng.randint(0, 9))] for _ in range(60)]
    assert names_of(spark, unique_names, headers) == [unique_name_list(h) for h in headers]
    assert names_of(spark, clean_names, headers) == [clean_name_list(h) for h in headers]


def test_names_end_up_distinct(spark):
    rng = random.Random(6)
    headers = [[rng.choice(["a", "a1", "a2", "a11", "a_c1", ""]) for _ in range(rng.randint(1, 9))] for _ in range(200)]
    for header, names in zip(headers, names_of(spark, distinct_names, headers)):
        assert len(set(names)) == len(header)
        listed = table_name_list(header)
        assert len(set(listed)) == len(header) and all(listed)
    assert table_name_list(["a b", "a-b", "%"]) == ["a_b", "a_b1", "_c2"]


def test_column_letters(spark):
    known = {1: "A", 26: "Z", 27: "AA", 52: "AZ", 702: "ZZ", 703: "AAA", 18278: "ZZZ", 18279: "AAAA"}
    df = spark.createDataFrame([(n,) for n in known], "n bigint").select("n", col_letters(F.col("n")).alias("s"))
    assert {r.n: r.s for r in df.collect()} == known
    assert {column_index(s) + 1: s for s in known.values()} == known
    assert spark.range(1, 20000).filter(col_number(col_letters(F.col("id"))) != F.col("id")).count() == 0
    empty = spark.range(-1, 1).select(col_letters(F.col("id")).alias("s")).collect()
    assert [r.s for r in empty] == ["", ""]


def test_range_address(spark):
    def address(title, *bounds, **options):
        columns = [None if b is None else F.lit(b) for b in bounds]
        return spark.range(1).select(range_address(F.lit(title), *columns, **options).alias("a")).first().a

    assert address("T", 2, 0) == "T!A3"
    assert address("T", 2, 0, None, 26) == "T!A3:Z"
    assert address("T", 2, 0, 9, 3) == "T!A3:C9"
    assert address("Q1:Q2", 2, 0) == "Q1:Q2"
    assert address("Q1:Q2", 2, 0, None, 3, for_write=False) == "Q1:Q2!A3:C"


def test_parse_range():
    assert parse_range("B2:D9") == (1, 9, 1, 4)
    assert parse_range("A3:Z") == (2, None, 0, 26)
    assert parse_range("Sheet!1!C4") == (3, 4, 2, 3)
    assert parse_range("$A:$C") == (0, None, 0, 3)
    assert parse_range("2:5") == (1, 5, 0, None)
    for bad in ("", "nonsense here", "1A:2B", ":"):
        with pytest.raises(ValueError):
            parse_range(bad)


def test_letters_of_every_bigint(spark):
    numbers = [8353082582, 8353082583, 2**62, 2**63 - 1]
    rows = spark.createDataFrame([(n,) for n in numbers], "n bigint").select("n", col_letters(F.col("n")).alias("s")).collect()
    assert [column_index(r.s) + 1 for r in rows] == numbers and [r.s for r in rows] == [letters_of(n) for n in numbers]
    assert rows[0].s == "ZZZZZZZ" and rows[1].s == "AAAAAAAA"


def test_corners_in_either_order():
    assert parse_range("D9:B2") == parse_range("B2:D9") == parse_range("B9:D2")
    assert parse_range("C:A") == (0, None, 0, 3) and parse_range("5:2") == (1, 5, 0, None)


def test_titles_are_read_back(spark):
    titles = ["Plain", "Hi! there", "a:b", "it's", "''", "'", "!", "x!A1:B2", "two words", "", "A1", "line\n", "é" * 9000]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    address = range_address(F.col("t"), F.lit(4), 2, quote=True)
    rows = df.select("t", address_title(address).alias("title"), address_cells(address).alias("cells")).collect()
    assert all(r.title == r.t and r.cells == "C5" for r in rows)
    bare = spark.createDataFrame([("S!A1:B2", "S", "A1:B2"), ("S", "S", ""), ("Hi! there!B2", "Hi! there", "B2"), ("'q:r'", "q:r", "")], "a string, t string, c string")
    assert all(r.t == r.title and r.c == r.cells for r in bare.select("t", "c", address_title(F.col("a")).alias("title"), address_cells(F.col("a")).alias("cells")).collect())


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(headers=st.lists(st.lists(st.sampled_from(["a", "a1", "a11", "a111", "a2", "b", "b 1", "B-1"]), min_size=1, max_size=9), min_size=100, max_size=100))
def test_record_and_table_names_are_equal(spark, headers):
    headers = [["a", "a", "a1", "a11", "a111"], *headers]
    for unique, clean in ((True, True), (True, False), (False, True), (False, False)):
        got = names_of(spark, lambda h: record_names(h, unique, clean), headers)
        assert got == [table_name_list(h, unique, clean) for h in headers]


def test_wide_headers_are_quick(spark):
    header = ["a"] * 400 + [f"a{i}" for i in range(300)] + ["b", "b1"] * 150
    start = time.perf_counter()
    got = names_of(spark, lambda h: record_names(h, True, True), [header] * 3)
    assert got == [table_name_list(header)] * 3 and time.perf_counter() - start < 20


def test_names_as_rows_equal_names_as_arrays(spark):
    import random

    from pyspark.sql import functions as F

    from gridframe.functions.names import clean_name_list, unique_name_list
    from gridframe.operators.naming import settled_names

    rng = random.Random(2)
    bits = ["a", "A", "a1", "a-1", "b c", "b-c", "", "_", "é", "a11", "1"]
    headers = [[rng.choice(bits) for _ in range(rng.randrange(12))] for _ in range(60)]
    headers += [["a"] + ["a" + "1" * i for i in range(12)] + ["a"], ["x"] * 2000, []]
    df = spark.createDataFrame([("w", str(i), header) for i, header in enumerate(headers)], "workbook_id string, sheet_id string, header array<string>")

    def repaired(header, unique, clean):
        header = unique_name_list(header) if unique else header
        header = clean_name_list(header) if clean else header
        while len(set(header)) < len(header):
            header = unique_name_list(header)
        return header

    for unique, clean in ((True, True), (False, True), (False, False)):
        found = {int(r.sheet_id): r.header for r in settled_names(df, unique, clean).collect()}
        assert found == {i: repaired(header, unique, clean) for i, header in enumerate(headers)}
    wide = spark.createDataFrame([("w", "0", [f"n{i % 9000}" for i in range(16_000)])], df.schema)
    assert settled_names(wide, True, True).select(F.size(F.array_distinct("header")).alias("n")).first().n == 16_000
