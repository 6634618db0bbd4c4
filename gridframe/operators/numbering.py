"""Dense row numbers in a given order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once

# Rows numbered by one task, on average; a smaller table is still spread over the cores.
ROWS_PER_BUCKET = 250_000
LEAST_ROWS = 1_000
# Starts of so many buckets (16 bytes each) are sent to every task; those of more are joined.
BROADCAST_BUCKETS = 500_000
# A task's running row number is in the low bits of Spark's increasing id.
ROW_BITS = 33


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    column: str = "row_idx",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, int]:
    """``df`` with dense 0-based positions in ``order_by`` order, and the row count.

    ``order_by`` is an ascending key. The rows are sorted by range and stored in
    the shared checkpoint folder, each with its bucket and its place there; a
    count per bucket then gives where each bucket starts. ``df`` is computed
    three times: for the count, for the ranges and for the rows. The number of
    buckets follows the row count without a ceiling, and no key comes to the
    driver other than those Spark itself samples for the ranges.

    The key should be unique. Rows that tie are ordered by a hash of the whole
    row. Exact copies, whose order cannot matter, are dealt out by their places
    in their task's rows, sorted by that hash: a bucket is never larger for them,
    and a task that runs again with its rows in another order deals out the same.
    """
    keys = [F.col(key) if isinstance(key, str) else key for key in order_by]
    if not keys:
        raise ValueError("order_by needs at least one key")
    total = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, -(-total // rows_per_bucket), min(cores, total // LEAST_ROWS))
    named = {f"__key{i}": key for i, key in enumerate(keys)}
    ranged = dealt(df.withColumns({**named, "__tie": _row_hash(df)}))
    ranged = ranged.repartitionByRange(buckets, *named, "__tie", "__deal").sortWithinPartitions(*named, "__tie")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = ranged.drop(*named, "__tie", "__deal").withColumns({"__bucket": F.spark_partition_id(), "__place": place})
    # Stored and read back in tasks of about ROWS_PER_BUCKET rows, not one per
    # bucket: every task sends its result to the driver, and small buckets are
    # many. Bucket and place are set before, so they are those of the ranges.
    tasks = min(buckets, max(cores, -(-total // ROWS_PER_BUCKET)))
    stored = checkpoint_once(placed.coalesce(tasks))
    counts = stored.groupBy("__bucket").count()
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each bucket.
    starts = checkpoint_once(counts.select("__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start")))
    if buckets <= BROADCAST_BUCKETS:
        starts = F.broadcast(starts)
    numbered = stored.join(starts, "__bucket").withColumn(column, F.col("__start") + F.col("__place"))
    return numbered.drop("__bucket", "__place", "__start"), total


def dealt(hashed: DataFrame) -> DataFrame:
    """Rows with a number ``__deal`` that tells copies apart, by row hash ``__tie`` and place in the sorted task.

    The copies that a task holds have the same numbers in whatever order its
    rows come, so a shuffle by them can be repeated task by task.
    """
    ordered = hashed.sortWithinPartitions("__tie")
    return ordered.withColumn("__deal", F.xxhash64("__tie", F.monotonically_increasing_id()))


def _row_hash(df: DataFrame) -> Column:
    """Hash of the whole row; columns holding maps or variants, which have no hash, go in as JSON."""
    hashed = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        hashed.append(F.to_json(F.struct(column)) if "map<" in kind or "variant" in kind else column)
    return F.xxhash64(*hashed)
