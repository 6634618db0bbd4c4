import datetime as dt
import decimal
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

import gridframe as gf
from gridframe.operators.export import row_texts


def texts(df):
    return [r.cells for r in df.selectExpr(f"array({', '.join(row_texts(df))}) as cells").collect()]


def double_texts(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return [r.t for r in df.select(gf.double_text("v").alias("t")).collect()]


def test_known_doubles(spark):
    values = [1e7, 1e15, 1e16, 1e-3, 1e-4, 1e-5, math.inf, -math.inf, 0.0, -0.0, -1.5e7, -2.5e-5, 1.0e100, 5e-1, 1e22, 2.0**63]
    assert double_texts(spark, values) == [repr(v) for v in values]
    assert double_texts(spark, [math.nan]) == ["nan"]


def test_random_doubles(spark):
    rng = random.Random(11)
    values = [rng.choice((1, -1)) * 10 ** rng.uniform(low, high) for low, high in
              ((-6, 0), (0, 7), (7, 16), (15.9, 19), (18.9, 25), (-300, 300)) for _ in range(4000)]
    values += [round(rng.uniform(0, 1e5), 2) for _ in range(4000)]
    values += [float(rng.randrange(10**16, 2**63)) for _ in range(4000)]
    values += [float(f"{rng.randrange(1, 999)}e{rng.randrange(14, 19)}") for _ in range(2000)]
    values += [float(f"{m}e{e}") for m in (1, 2, 9.5) for e in range(-323, 308)]
    values += [v for k in range(-1074, 1024) for v in (2.0**k, math.nextafter(2.0**k, math.inf), math.nextafter(2.0**k, 0))]
    wrong = [(v, t) for v, t in zip(values, double_texts(spark, values)) if t != repr(v)]
    assert not wrong, (len(wrong), wrong[:20])


def test_single_precision(spark):
    import numpy as np

    rng = random.Random(12)
    values = [float(np.float32(10 ** rng.uniform(-6, 15))) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v float")
    # Half-precision of the double: the text must read back as the same float.
    back = [struct.unpack("f", struct.pack("f", float(t[0])))[0] for t in texts(df)]
    assert back == values
    assert texts(spark.createDataFrame([(0.1,), (1e10,)], "v float")) == [["0.1"], ["10000000000.0"]]


def test_typed_cells(spark):
    row = (
        True, 3, 12345678901, 2.5, decimal.Decimal("12.30"), dt.date(2020, 1, 2), dt.datetime(2020, 1, 2, 3, 4, 5, 120000),
        ["a", None, "it's"], [1, 2], [True, False], {"k": 1}, (1, "z"), bytearray(b"hi"), "text",
    )
    schema = (
        "b boolean, i int, l bigint, d double, m decimal(10,2), day date, t timestamp, sa array<string>, ia array<int>,"
        "ba array<boolean>, mp map<string,int>, st struct<x:int,y:string>, bin binary, s string"
    )
    df = spark.createDataFrame([row, (None,) * 14], schema)
    assert texts(df) == [
        ["True", "3", "12345678901", "2.5", "12.30", "2020-01-02", "2020-01-02 03:04:05.12", "['a', None, \"it's\"]", "[1, 2]",
         "[True, False]", '{"k":1}', '{"x":1,"y":"z"}', "hi", "text"],
        ["False", "", "", "", "", "", "", "[]", "[]", "[]", "", "", "", ""],
    ]


def test_list_text_is_a_python_list(spark):
    values = [["plain", "it's", 'say "x"', "both ' and \"", "back\\slash", "line\nbreak", "tab\t", ""], [], ["é"]]
    df = spark.createDataFrame([(v,) for v in values], "v array<string>")
    assert texts(df) == [[str(v)] for v in values]
    assert texts(spark.createDataFrame([([1.0, 1e16],)], "v array<double>")) == [["[1.0, 1e+16]"]]
    assert texts(spark.createDataFrame([([[1], None],)], "v array<array<int>>")) == [["[[1], None]"]]


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NaN",), ("nan",), ("None",), ("none",), ("None of it",), (" nan",), ("NONE",), (None,)], "s string")
    assert [r.s for r in gf.blank_nulls(df).collect()] == ["", "", "", "", "None of it", " nan", "NONE", ""]
    assert texts(spark.createDataFrame([(math.nan,)], "d double")) == [[""]]


def test_steps_of_the_chain(spark):
    df = spark.createDataFrame([(None, None, 1), (True, [1], None)], "b boolean, a array<int>, i int")
    assert [r.b for r in gf.fill_booleans(df).collect()] == [False, True]
    assert [r.a for r in gf.fill_arrays(df).collect()] == [[], [1]]
    assert [tuple(r) for r in gf.stringify(df).collect()] == [(None, None, "1"), ("True", "[1]", None)]
    assert [tuple(r) for r in gf.to_text(df).collect()] == [("False", "[]", "1"), ("True", "[1]", "")]
    nested = spark.createDataFrame([(None,)], "m map<string,array<int>>")
    assert gf.fill_arrays(nested).first().m is None


def test_repeated_and_odd_column_names(spark, lines):
    names = ["k", "a.b", "A", "a", "A"]
    df = spark.createDataFrame([(1, "x", True, None, 2)], "k int, s string, b boolean, c boolean, n int").toDF(*names)
    assert gf.positional(df)[0].columns == ["_c0", "_c1", "_c2", "_c3", "_c4"] and gf.positional(df)[1] == names
    assert lines(gf.to_cells(df, ["k"])) == [["1", "x", "True", "False", "2"]]
    assert gf.stringify(df).columns == names
    with pytest.raises(ValueError):
        gf.to_cells(df, ["A"])


@pytest.mark.parametrize("rows_per_bucket", [7, 60, 10**6])
def test_numbering_is_dense_and_ordered(spark, rows_per_bucket):
    rng = random.Random(3)
    keys = rng.sample(range(10**6), 500)
    rows = [(f"g{k % 3}", k, None if k % 11 == 0 else k / 7, dt.datetime(2020, 1, 1) + dt.timedelta(seconds=k % 5)) for k in keys]
    df = spark.createDataFrame(rows, "g string, k int, d double, t timestamp_ntz").repartition(6)
    for order in (["k"], ["g", "k"], ["t", "d", "k"]):
        numbered, total = gf.number_rows(df, order, rows_per_bucket=rows_per_bucket)
        got = [tuple(r[c] for c in ("g", "k", "d", "t")) for r in numbered.orderBy("row_idx").collect()]
        assert total == 500
        assert [r.row_idx for r in numbered.orderBy("row_idx").collect()] == list(range(500))
        assert got == [tuple(r) for r in df.orderBy(*order).collect()]


def test_numbering_spreads_a_heavy_tie(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"))
    numbered, _ = gf.number_rows(df, ["k"], rows_per_bucket=100)
    rows = numbered.collect()
    assert sorted(r.row_idx for r in rows) == list(range(3000))
    assert all(r.row_idx < 2000 for r in rows if r.k == 0)
    assert all(r.row_idx == r.id for r in rows if r.k)


def test_numbering_other_key_types(spark):
    df = spark.range(300).select(
        F.col("id"), F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")).alias("day"),
        (F.col("id") / 3).cast("decimal(12,4)").alias("m"), F.to_binary(F.lpad(F.hex("id"), 8, "0"), F.lit("hex")).alias("b"),
        F.create_map(F.lit("k"), F.col("id")).alias("carried"),
    )
    for key in ("day", "m", "b"):
        numbered, _ = gf.number_rows(df, [key], rows_per_bucket=20)
        assert numbered.filter("row_idx <> id").count() == 0


def test_numbering_has_no_single_task_window(spark):
    numbered, _ = gf.number_rows(spark.range(1000), ["id"], rows_per_bucket=50)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and plan.count("Exchange") == 1


def test_numbering_reads_small_buckets_in_few_tasks(spark):
    df = spark.range(0, 6000, 1, 3).select(F.lit("copy").alias("k"))
    numbered, total = gf.number_rows(df, ["k"], rows_per_bucket=50)
    assert total == 6000 and sorted(r.row_idx for r in numbered.collect()) == list(range(6000))
    assert numbered.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism


def test_html_rows_and_table(spark):
    long = "x" * 80
    df = spark.createDataFrame([(2, "<b>&</b>"), (1, long)], "k int, v string")
    rows = [r.html for r in gf.to_html_rows(df, ["k"]).orderBy("row_idx").collect()]
    assert rows == [f"<tr><td>1</td><td>{long}</td></tr>", "<tr><td>2</td><td><b>&</b></td></tr>"]
    table = gf.to_html_table(df, ["k"]).collect()
    assert [r.html for r in table] == ['<table border="1" class="dataframe"><tbody>' + "".join(rows) + "</tbody></table>"]
    styled = gf.to_html_table(df, ["k"], table_style="color:red").first().html
    assert styled.startswith('<table style="color:red" border="1" class="dataframe"><tbody>')


def test_tall_html_table_comes_in_fragments(spark):
    df = spark.range(25).select("id")
    whole = gf.to_html_table(df, ["id"]).first().html
    parts = gf.to_html_table(df, ["id"], rows_per_fragment=10, rows_per_bucket=4).orderBy("fragment_no").collect()
    assert [r.fragment_no for r in parts] == [0, 1, 2]
    assert "".join(r.html for r in parts) == whole
    empty = gf.to_html_table(df.limit(0), ["id"]).collect()
    assert [r.html for r in empty] == ['<table border="1" class="dataframe"><tbody></tbody></table>']


def test_empty_frame(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert gf.to_cells(df, ["a"]).count() == 0
    assert gf.to_html_rows(df, ["a"]).count() == 0


def test_copies_are_dealt_out_alike_whatever_the_order_in_a_task(spark):
    from collections import Counter

    from gridframe.operators.numbering import _row_hash, dealt

    rows = [(i % 3, "copy") for i in range(600)] + [(i, "own") for i in range(50)]

    def buckets(order):
        df = spark.createDataFrame(rows, "k long, v string").coalesce(1).sortWithinPartitions(order)
        ranged = dealt(df.withColumn("__tie", _row_hash(df))).repartitionByRange(5, "k", "__tie", "__deal")
        return Counter((r.k, r.v, r.b) for r in ranged.withColumn("b", F.spark_partition_id()).collect())

    first = buckets(F.col("v"))
    assert first == buckets(F.col("k").desc()) == buckets(F.hash("v", "k")) and sum(first.values()) == 650
    assert len({b for k, v, b in first if (k, v) == (1, "copy")}) > 1
