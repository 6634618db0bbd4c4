"""Names of many headers at once, each name a row: sorting and counting in place of nested arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.functions.names import clean_names, distinct_names
from gridframe.operators.extent import checkpoint_once
from gridframe.sources.schemas import SHEET_KEYS

# Passes over headers that still clash; one that needs more goes on by itself, as an array.
PASSES = 30


def settled_names(headers: DataFrame, make_columns_unique: bool, clean_column_names: bool) -> DataFrame:
    """``headers`` (one row per sheet) with the names in ``header`` repaired as asked and without repeats.

    Same names as ``distinct_names`` gives. A pass numbers equal names by
    position; only headers in which it changed a name are looked at again.
    """
    names = headers.select(*SHEET_KEYS, F.posexplode("header").alias("position", "name"))
    if make_columns_unique:
        names = _suffixed(names).drop("changed")
    if clean_column_names:
        names = names.withColumn("name", F.get(clean_names(F.array("name")), F.lit(0)))
    done: list[DataFrame] = []
    for _ in range(PASSES):
        names = checkpoint_once(_suffixed(names))
        open_sheets = names.filter("changed").select(*SHEET_KEYS).distinct()
        done.append(_joined(names.join(open_sheets, SHEET_KEYS, "left_anti")))
        names = names.join(open_sheets, SHEET_KEYS, "left_semi").drop("changed")
        if names.isEmpty():
            break
    else:
        done.append(_joined(names).withColumn("names", distinct_names(F.col("names"))))
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    named = headers.join(found, SHEET_KEYS, "left")
    return named.withColumn("header", F.coalesce("names", "header")).drop("names").select(*headers.columns)


def _suffixed(names: DataFrame) -> DataFrame:
    """The n-th repeat of a name in its header gets n behind it; ``changed`` says which did."""
    earlier = F.row_number().over(Window.partitionBy(*SHEET_KEYS, "name").orderBy("position")) - 1
    numbered = names.withColumn("earlier", earlier)
    name: Column = F.when(F.col("earlier") > 0, F.concat("name", F.col("earlier").cast("string"))).otherwise(F.col("name"))
    return numbered.select(*SHEET_KEYS, "position", name.alias("name"), (F.col("earlier") > 0).alias("changed"))


def _joined(names: DataFrame) -> DataFrame:
    in_order = F.array_sort(F.collect_list(F.struct("position", "name")))
    return names.groupBy(*SHEET_KEYS).agg(F.transform(in_order, lambda pair: pair["name"]).alias("names"))
