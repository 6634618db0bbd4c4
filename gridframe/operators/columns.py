"""Facts about cells and columns: links and widths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridframe.functions.links import link_matches, link_text, link_uri
from gridframe.sources.schemas import SHEET_KEYS


def cell_links(df: DataFrame, col: str, keep: Sequence[str] = ()) -> DataFrame:
    """``ord, uri, text`` of every link in a cell, in order of appearance, beside the ``keep`` columns."""
    found = df.select(*keep, F.posexplode(link_matches(F.col(col))).alias("ord", "__match"))
    return found.select(
        *keep,
        (F.col("ord") + 1).alias("ord"),
        link_uri(F.col("__match")).alias("uri"),
        link_text(F.col("__match")).alias("text"),
    )


def column_widths(grid: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """Longest cell, in characters, of every column in ``[start, end)``."""
    cells = F.slice("cells", F.lit(start + 1), F.lit(end - start) if end is not None else F.greatest(F.size("cells"), F.lit(0)))
    return (
        grid.select(*SHEET_KEYS, F.posexplode(cells).alias("offset", "value"))
        .groupBy(*SHEET_KEYS, (F.col("offset") + start).alias("col_idx"))
        .agg(F.max(F.length(F.coalesce("value", F.lit("")))).alias("width"))
    )
