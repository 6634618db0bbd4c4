"""What both vector searches share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, vec, dim`` of rows with an id and a vector of finite numbers."""
    vec = F.col(f"`{vector}`").cast("array<double>")

    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    rows = df.select(F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), vec.alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(F.forall("vec", finite)).withColumn("dim", F.size("vec"))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of a column of equally long vectors."""
    return np.array([np.asarray(v, np.float64) for v in vectors]).reshape(len(vectors), -1)


def blocks_for(rows: int, size: int) -> int:
    return max(1, -(-rows // size))
