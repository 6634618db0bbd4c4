"""How quality filters interact: what each removes, repeats and costs, in every order of application.

Four filters look at a text alone; the fifth fails a text that a smaller id also
has. A counting Bloom sketch finds the texts that occur once for certain, so
only possible repeats are shuffled whole. What the filters say is one mask a
document, and documents of one mask are one number: all orders are then sums
over at most 32 masks of a part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridframe.operators.extent import checkpoint_once

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
SPACES = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Cells of the sketch for each row; three of them are a text's own.
CELLS_A_ROW = 8
CELLS_OF_TEXT = 3
# A text's cells lie in one block of 2 ** BLOCK_BITS cells, 4 KB as bits.
BLOCK_BITS = 15
# The merged sketch has one bit a cell and goes to every task: 64 MB at most. A
# table of more rows fills it further, so more unique texts are shuffled; none is missed.
MOST_CELLS = 1 << 29
# Distinct cells a task gathers before it hands on what it has.
CELLS_IN_TASK = 1 << 20


def digests(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def failures(text: Column) -> Column:
    """Mask of the filters A to D that a text fails; a null text counts as empty."""
    words = F.array_remove(F.split(text, SPACES), "")
    n, points = F.size(words).cast("bigint"), F.char_length(text).cast("bigint")
    capitals = points - F.char_length(F.translate(text, CAPITALS, ""))
    failed = [
        n < 100,
        100 * F.size(F.array_distinct(words)).cast("bigint") < 80 * n,
        100 * capitals > 10 * points,
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(fails, 1 << i).otherwise(0) for i, fails in enumerate(failed)), F.lit(0)).alias("mask")


def _block(blocks: int) -> Column:
    return F.pmod("h1", F.lit(blocks)).alias("block")


def _cells() -> list[Column]:
    """Where in its block a text's cells are: disjoint bits of its second hash."""
    return [F.shiftrightunsigned("h2", i * BLOCK_BITS).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int") for i in range(CELLS_OF_TEXT)]


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's sketch: its cells by block, each with its count, where two stands for any more."""

    def emit(cells: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        blocks, first = np.unique(cells >> BLOCK_BITS, return_index=True)
        inside = (cells & ((1 << BLOCK_BITS) - 1)).astype(np.uint16)
        bounds = [*first.tolist(), len(cells)]
        parts = list(zip(bounds[:-1], bounds[1:], strict=True))
        return pa.record_batch(
            [
                pa.array(blocks, pa.int64()),
                pa.array([inside[a:b].tobytes() for a, b in parts], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in parts], pa.binary()),
            ],
            names=["block", "cells", "counts"],
        )

    kept, seen = np.empty(0, np.int64), np.empty(0, np.uint8)
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False).astype(np.int64) << BLOCK_BITS
        # A text counts once in each of its cells, also where two of them are one.
        own = np.sort(np.stack([block | batch.column(f"c{i}").to_numpy(zero_copy_only=False) for i in range(CELLS_OF_TEXT)]), axis=0)
        fresh = np.ones_like(own, dtype=bool)
        fresh[1:] = own[1:] != own[:-1]
        cells = np.concatenate([kept, own[fresh]])
        counts = np.concatenate([seen, np.ones(len(cells) - len(kept), np.uint8)])
        kept, where = np.unique(cells, return_inverse=True)
        seen = np.minimum(np.bincount(where, weights=counts, minlength=len(kept)), 2).astype(np.uint8)
        if len(kept) >= CELLS_IN_TASK:
            yield emit(kept, seen)
            kept, seen = kept[:0], seen[:0]
    if len(kept):
        yield emit(kept, seen)


def _merged(key: tuple, parts: pa.Table) -> pa.Table:
    """One block of the merged sketch: which cells were counted twice or more, as 64-bit words."""
    counts = np.zeros(1 << BLOCK_BITS, np.uint8)
    for cells, seen in zip(parts.column("cells").to_pylist(), parts.column("counts").to_pylist(), strict=True):
        at = np.frombuffer(cells, np.uint16)
        counts[at] = np.minimum(counts[at] + np.frombuffer(seen, np.uint8), 2)
    words = np.packbits(counts >= 2, bitorder="little").view("<i8")
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([words.tolist()], pa.list_(pa.int64()))})


def sketch(keys: DataFrame, rows: int, most_cells: int = MOST_CELLS) -> tuple[DataFrame, int]:
    """The merged sketch of all rows of ``keys`` (``h1``, ``h2``), one row a block, and the number of blocks."""
    wanted = max(1, -(-rows * CELLS_A_ROW >> BLOCK_BITS))
    blocks = min(1 << (wanted - 1).bit_length(), most_cells >> BLOCK_BITS)
    cells = keys.select(_block(blocks), *[cell.alias(f"c{i}") for i, cell in enumerate(_cells())])
    partial = cells.mapInArrow(_partial, "block bigint, cells binary, counts binary")
    return checkpoint_once(partial.groupBy("block").applyInArrow(_merged, "block bigint, words array<bigint>")), blocks


def possible_repeats(rows: DataFrame, merged: DataFrame, blocks: int) -> DataFrame:
    """Rows whose cells were all counted twice or more; every other text occurs once for certain."""
    twice = [F.getbit(F.get("words", (cell / 64).cast("int")), cell % 64) == 1 for cell in _cells()]
    marked = rows.withColumn("block", _block(blocks)).join(F.broadcast(merged), "block")
    return marked.filter(twice[0] & twice[1] & twice[2]).drop("block", "words")


def repeated(docs: DataFrame, keys: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """``keys`` with ``again``: whether a smaller id has exactly the same text.

    Whole texts are grouped only where the sketch leaves it open, each task
    sending a text once with the least id it saw. A row whose id is the least of
    its text is not a repeat, nor is a row without an id. Rows meet that least
    id by their own id, so copies of one text are never gathered.
    """
    merged, blocks = sketch(keys, keys.count(), most_cells)
    text = F.coalesce("text", F.lit("")).alias("text")
    open_texts = possible_repeats(docs.select("doc_id", text).select("doc_id", "text", *digests(F.col("text"))), merged, blocks)
    least = open_texts.filter(F.col("doc_id").isNotNull()).groupBy("h1", "h2", "text").agg(F.min("doc_id").alias("doc_id"))
    least = least.select("doc_id", "h1", "h2").distinct().withColumn("least", F.lit(True))
    unclear = possible_repeats(keys, merged, blocks).filter(F.col("doc_id").isNotNull()).select("doc_id", "h1", "h2").distinct()
    again = unclear.join(least, ["doc_id", "h1", "h2"], "left").filter(F.col("least").isNull()).select("doc_id", "h1", "h2", F.lit(True).alias("again"))
    with_id = keys.filter(F.col("doc_id").isNotNull()).join(again, ["doc_id", "h1", "h2"], "left")
    without = keys.filter(F.col("doc_id").isNull()).withColumn("again", F.lit(None).cast("boolean")).select(*with_id.columns)
    return with_id.unionAll(without).withColumn("again", F.coalesce("again", F.lit(False)))


def mask_counts(docs: DataFrame, labels: DataFrame, most_cells: int = MOST_CELLS) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by language and set of failed filters, additive over parts.

    ``docs`` has ``doc_id, text, lang``, ``labels`` has ``doc_id, quality,
    toxic``; other columns are ignored. Null texts count as empty, a null
    language as the empty one. A document is good or toxic if any of its labels
    says 1; rows equal in all columns count as often as they occur.
    """
    text = F.coalesce("text", F.lit(""))
    plain = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    keys = checkpoint_once(plain.select("doc_id", "part", failures(F.col("text")), *digests(F.col("text"))))
    says = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    judged = repeated(docs, keys, most_cells)
    judged = judged.select("doc_id", "part", (F.col("mask") + F.when(F.col("again"), REPEAT).otherwise(0)).alias("mask"))
    with_id = judged.filter(F.col("doc_id").isNotNull()).join(known, "doc_id", "left").select("part", "mask", "good", "toxic")
    without = judged.filter(F.col("doc_id").isNull()).select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return with_id.unionAll(without).groupBy("part", "mask").agg(F.count("*").alias("n"), total("good"), total("toxic"))


def _steps() -> Column:
    """All orders of the filters, each with its steps: which filters came before, and the one applied."""
    steps = [
        {"order": "".join(order), "step": i + 1, "before": sum(1 << FILTERS.index(x) for x in order[:i]), "own": 1 << FILTERS.index(order[i])}
        for order in permutations(FILTERS)
        for i in range(len(FILTERS))
    ]
    return F.explode(F.from_json(F.lit(json.dumps(steps)), "array<struct<order: string, step: int, before: int, own: int>>"))


def audit(counts: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, from additive mask counts.

    ``kept`` after the step, ``removed`` by it, ``redundant`` (failing its filter
    but removed earlier), ``unique_fails`` (failing that filter only),
    ``good_lost``, ``toxic_lost`` and ``shapley``: what its filter removes, over
    all orders. A document that fails k filters is removed by each of them in
    one of k orders.
    """
    orders = len(list(permutations(FILTERS)))
    own, before, mask = F.col("at.own"), F.col("at.before"), F.col("mask")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    share = F.call_function("div", F.lit(orders), F.greatest(F.bit_count(mask), F.lit(1)))
    here = fails & ~gone

    def total(condition: Column, value: Column | str = "n") -> Column:
        return F.sum(F.when(condition, value if isinstance(value, Column) else F.col(value)).otherwise(0)).cast("bigint")

    rows = counts.withColumn("mask", mask.cast("int")).select("*", _steps().alias("at"))
    return rows.groupBy("part", F.col("at.order").alias("filter_order"), F.col("at.step").alias("step")).agg(
        total(~fails & ~gone).alias("kept"),
        total(here).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == own).alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        total(fails, F.col("n") * share).alias("shapley"),
    )
