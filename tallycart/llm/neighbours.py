"""Nearest neighbours by cosine as a block matrix join.

Queries and vectors are cut into blocks by a hash of the id; each pair of blocks is one task. In
a task the unit vectors are rounded to whole numbers of -127 to 127; the product of two rounded
blocks gives every cosine with a bound of its error, from the rounding errors' lengths.
Per query only pairs whose upper bound reaches the k-th best lower bound survive;
these are computed again in double precision on the original vectors, in component
order, and merged by heaps, first per task and then over all tasks. The bounds make it exact.

Vectors that are null, zero or hold null or non-finite components take no part; shorter
vectors count as filled up with zeros. A query is an id (see ``query_rows``); every row with
another id is a candidate, repeated rows each for themselves. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .vectors import best, matrix, query_rows, same_width, usable

BLOCK = 8192
QUERY_BLOCK = 2048
#: Query rows of a block whose products are held at once.
STRIPE = 256


def rounded(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers, their unit, the length of the rounded vector, and that of its error."""
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    unit = vectors / largest
    unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
    step = np.abs(unit).max(axis=1, keepdims=True) / 127
    whole = np.rint(unit / step)
    error = np.sqrt(((unit - whole * step) ** 2).sum(axis=1))
    return whole.astype(np.int8), step[:, 0], np.sqrt(((whole * step) ** 2).sum(axis=1)), error


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, added up component by component."""
    dot, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for i in range(a.shape[1]):
        dot += a[:, i] * b[:, i]
        aa += a[:, i] * a[:, i]
        bb += b[:, i] * b[:, i]
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        out = dot / (np.sqrt(aa) * np.sqrt(bb))
    odd = ~np.isfinite(out) | (aa < 1e-290) | (bb < 1e-290)
    if odd.any():  # lengths outside the range of doubles: scale first
        x, y = (v[odd] / np.abs(v[odd]).max(axis=1, keepdims=True) for v in (a, b))
        out[odd] = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
    return np.clip(out, -1.0, 1.0)


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """The ``k`` best (query_id, vec_id, score) of each query among the vectors of one block."""
    queries, vectors = same_width(queries, vectors)
    q, q_step, q_length, q_error = rounded(queries)
    v, v_step, v_length, v_error = rounded(vectors)
    # Products of such whole numbers and sums of up to a thousand of them are exact in single precision.
    exact = np.float32 if vectors.shape[1] <= 1000 else np.float64
    columns = v.astype(exact).T
    for begin in range(0, len(q), STRIPE):
        part = slice(begin, begin + STRIPE)
        product = (q[part].astype(exact) @ columns) * q_step[part, None] * v_step
        bound = q_error[part, None] * v_length + q_length[part, None] * v_error + q_error[part, None] * v_error + 1e-5
        own = query_ids[part, None] == ids
        product[own] = -np.inf
        lower = product - bound
        if len(ids) > k:
            enough = np.partition(lower, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            enough = np.full(len(product), -np.inf)
        row, column = np.nonzero((product + bound >= enough[:, None]) & ~own)
        score = cosines(queries[part][row], vectors[column])
        for r in np.unique(row):
            mine = row == r
            for s, less in heapq.nlargest(k, zip(score[mine].tolist(), (-ids[column[mine]]).tolist())):
                yield int(query_ids[begin + r]), -less, s


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of each row whose id is divisible by ``every``."""
    rows = store(usable(vectors, nonzero=True), "neighbour-vectors")
    asked = query_rows(rows, every)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    blocks, query_blocks = -(-counts["n"] // block) or 1, -(-counts["q"] // query_block) or 1

    def dealt(frame: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        frame = frame.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(own_blocks)).cast("int"))
        return frame.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1))))

    def join(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = list(tile(left["vec_id"].to_numpy(), matrix(left["embedding"]), right["vec_id"].to_numpy(), matrix(right["embedding"]), k))
        query, vec, score = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})

    left = dealt(asked, "qb", query_blocks, "vb", blocks).groupBy("qb", "vb")
    right = dealt(rows, "vb", blocks, "qb", query_blocks).groupBy("qb", "vb")
    return best(left.cogroup(right).applyInArrow(join, "query_id bigint, vec_id bigint, score double"), k)
