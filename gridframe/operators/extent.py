"""Facts per sheet (extent, header) and how they reach the sheet's rows."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridframe.sources.schemas import SHEET_KEYS

# A fact table is broadcast only while its measured size stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024
# Beyond it rows meet their sheet's facts in chunks of this many row positions,
# so a sheet holding most of the rows is spread over many tasks.
CHUNK_ROWS = 1_000_000


def checkpoint_once(df: DataFrame) -> DataFrame:
    """Compute a small derived table once; later plans read the stored result."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for stored intermediate tables, which all executors share.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only local mode
    makes one of its own where that is unset.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not re.fullmatch(r"local(\[.*\])?", context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="gridframe-checkpoint-")
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def sheet_extents(grid: DataFrame, content: Column | None = None) -> DataFrame:
    """First and last row position and widest row of every sheet.

    With ``content``, a predicate on rows, positions count only where it holds,
    and a sheet without such a row has none. All three are fixed-width, so each
    task combines them by hash before the shuffle and a sheet of any height
    sends one row per task.
    """
    position = F.col("row_idx") if content is None else F.when(content, F.col("row_idx"))
    extents = grid.groupBy(*SHEET_KEYS).agg(
        F.min(position).alias("first_row"),
        F.max(position).alias("last_row"),
        F.max(F.size("cells")).alias("width"),
    )
    return extents.filter(F.col("first_row").isNotNull())


def measured_bytes(df: DataFrame) -> int:
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0


def attach_facts(rows: DataFrame, facts: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows with their sheet's facts beside them; rows of a sheet without facts go.

    ``facts`` is a checkpointed table with one row per sheet that holds
    ``first_row`` and ``last_row``. Small facts are broadcast and the rows stay
    where they are. Larger ones are joined by sheet and row chunk.
    """
    if measured_bytes(facts) <= broadcast_bytes:
        return rows.join(F.broadcast(facts), SHEET_KEYS)

    def chunk(row_idx: Column) -> Column:
        return F.call_function("div", row_idx, F.lit(CHUNK_ROWS))

    # Only chunks that hold rows: positions may be sparse keys, with few rows among very many.
    chunks = rows.select(*SHEET_KEYS, chunk(F.col("row_idx")).alias("__chunk")).distinct().join(facts, SHEET_KEYS)
    return rows.withColumn("__chunk", chunk(F.col("row_idx"))).join(chunks, [*SHEET_KEYS, "__chunk"]).drop("__chunk")
