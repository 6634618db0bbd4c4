"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and, over training time 0 to 1, a schedule by which
its share rises or falls. Targets follow the weights, stop at a multiple of a
source's size and hand their excess on. A source's documents are put in a fixed
pseudo-random order and repeated in it until the target is met. Integrating its
schedule gives the share of its words that training has asked for by any time;
inverting that at a copy's place in the cumulative words gives the copy's time,
its training position. Sorting by position by range is the mix.

Cumulative words of a source are summed over buckets of the order first and
inside a bucket second, so a source that holds most rows is spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once

WEIGHTS = (5, 2, 1)
# Words a source gives at most, as a multiple of its size.
MOST_REPEATS = 3
# Weight of a source over time: straight from the first number to the second. Taken in turn by the sources in order.
SCHEDULES = ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))
# Documents of a bucket of the order, on average.
BUCKET_ROWS = 1_000
# Rows of a table that is still sent to every task; a larger one is joined by key.
SENT_ROWS = 100_000
SPACE, SEED = 1 << 40, 11


def words_in(text: Column) -> Column:
    """Number of runs of anything but ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """``source, source_size, no, target`` for rows ``source, source_size``, one for each source.

    Sources go by code point, null last, and take the weights in turn. Targets
    share the sum of all sizes by weight; what exceeds ``most`` times a size is
    shared again among the others, until none exceeds it. Nothing to share gives
    targets of 0.
    """
    place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("no", F.lit(len(weights))) + 1).cast("int"))
    # One row per source: their number is that of sources, not of documents.
    ranked = sizes.withColumn("no", place).withColumn("weight", weight).withColumn("most", F.col("source_size") * float(most))
    ranked = checkpoint_once(ranked)
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        free = F.col("weight") * level < F.col("most")
        row = ranked.agg(F.sum(F.when(free, F.col("weight"))), F.sum(F.when(~free, F.col("most")))).first()
        if not row[0]:
            break
        raised = max(level, (total - (row[1] or 0.0)) / row[0])
        if raised == level:
            break
        level = raised
    return ranked.select("source", "source_size", "no", F.least("most", F.col("weight") * level).alias("target"))


def order_of(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Place of a document in its source's fixed order."""
    return F.pmod(F.xxhash64(F.lit(seed), doc_id.cast("string"), text), F.lit(SPACE))


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, most: float = MOST_REPEATS, schedules: Sequence[tuple[float, float]] = SCHEDULES, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id, order, source, size, source_size, target, copies, taken, positions`` for each row of ``df``.

    ``copies`` is how often the mix takes the document, ``taken`` its words times
    that, ``positions`` the training times of the copies, from 0 to 1. A source
    takes whole passes over its documents, then those whose middle word lies
    within what is left, so it misses its target by less than half a document.

    A document without words has size 0 and belongs to the mix once, in its place.
    A null source is a source; null ids, repeated rows and ties are documents
    like others (equal rows may share their copies in either order). The order
    comes from a hash of id, text and ``seed``, so reruns agree. Other columns
    are not looked at.
    """
    body = F.col(f"`{text}`")
    order = order_of(F.col(f"`{doc_id}`"), body, seed)
    docs = checkpoint_once(df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), words_in(body).alias("size"), order.alias("order")))
    per_source = docs.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    per_source = checkpoint_once(per_source)
    targets = source_targets(per_source.select("source", "source_size"), weights, most)
    facts = targets.alias("t").join(per_source.alias("p"), F.col("t.source").eqNullSafe(F.col("p.source")))
    rate = lambda i: F.element_at(F.array(*[F.lit(float(s[i])) for s in schedules]), (F.pmod("no", F.lit(len(schedules))) + 1).cast("int"))
    facts = checkpoint_once(facts.select("t.source", "t.source_size", "target", F.ceil(F.col("rows") / bucket_rows).alias("buckets"), rate(0).alias("early"), rate(1).alias("late")))

    facts = _sent_if_small(facts.withColumnRenamed("source", "__source"))
    rows = docs.join(facts, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rows = rows.withColumn("bucket", F.floor(F.col("order") * F.col("buckets") / SPACE).cast("bigint"))
    in_bucket = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = in_bucket.select(F.col("source").alias("__source"), F.col("bucket").alias("__bucket"), F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("start"))
    starts = _sent_if_small(checkpoint_once(starts))
    rows = rows.join(starts, F.col("source").eqNullSafe(F.col("__source")) & (F.col("bucket") == F.col("__bucket"))).drop("__source", "__bucket")
    within = Window.partitionBy("source", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / 2
    rows = rows.withColumn("middle", middle)

    passes = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)).cast("int")
    left = F.col("target") - passes * F.col("source_size")
    one_more = ((F.col("middle") < left) & (passes < most)).cast("int")
    copies = F.when(F.col("size") == 0, 1).otherwise(passes + one_more)
    rows = rows.withColumn("copies", copies)
    # The schedule runs from early to late, so the share asked for by time t is (e t + (l - e) t^2 / 2) / ((e + l) / 2).
    early, slope = F.col("early"), F.col("late") - F.col("early")
    asked = lambda share: share * (F.col("early") + F.col("late")) / 2
    time = lambda share: F.when(F.abs(slope) < 1e-9, share).otherwise((F.sqrt(F.greatest(early * early + 2 * slope * asked(share), F.lit(0.0))) - early) / slope)
    share_of = lambda i: F.least(F.lit(1.0), (F.col("middle") + i * F.col("source_size")) / F.greatest(F.col("target"), F.lit(1.0)))
    numbers = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>"))
    positions = F.transform(numbers, lambda i: time(share_of(i)))
    return rows.select("doc_id", "order", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("bigint").alias("taken"), positions.alias("positions"))


def _sent_if_small(stored: DataFrame) -> DataFrame:
    """A stored table of two or three short columns, broadcast only after its rows have been counted."""
    return F.broadcast(stored) if stored.count() <= SENT_ROWS else stored


def in_training_order(mixed: DataFrame) -> DataFrame:
    """One row for each copy, with its ``position``, sorted by range over the whole table."""
    copies = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return copies.orderBy("position", "source", "doc_id")
