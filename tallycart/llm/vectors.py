"""Vectors of the two searches: which rows take part, and the merge of what the tasks found."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, nonzero: bool) -> DataFrame:
    """(vec_id, embedding) of rows with an id and a vector of finite numbers, not all zero if asked."""
    sound = "vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = vectors.select("vec_id", "embedding").filter(sound)
    return rows.filter("exists(embedding, x -> x != 0)") if nonzero else rows


def query_rows(rows: DataFrame, every: int) -> DataFrame:
    """One row per id divisible by ``every``; of several, the one with the smallest vector."""
    return rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows of doubles; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), max(width, int(sizes.max()) if len(sizes) else 0)))
    out[np.arange(out.shape[1]) < sizes[:, None]] = values
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))  # type: ignore[return-value]


def best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` highest scores of each query, ties to the smaller id, with ``rank`` from 1."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
