"""Hard negatives: rows of other labels that score nearly as high as an anchor's positives.

The score is the integer inner product of floor(scale * x). Every vector's segments keep their mean
and deviation (the length of what the mean leaves over). For one segment, the product of two vectors
is the product of the means times the length of the segment, give or take the product of the
deviations; summed over segments this bounds the score. Pairs whose bounds cannot reach a place
in the result go; segments of the others are cut finer, level by level, and what is left at the end is scored
exactly. Coarser segments cost less, finer ones bound closer.

Positives come first: blocks of one label, so anchors meet rows of their label only; a hot
label has many blocks. Negatives follow: every anchor with the window that each of its positives allows meets
all rows, block by block. Tasks keep the best of a block, and the best of all blocks are taken by a
ranked window per anchor, or anchor and positive, over at most ``k`` rows a block.

Rows with a null id, label or vector, or with null or non-finite components, take no part. Labels of
ids divisible by ``noisy`` move on by one, modulo ten, before anything else. An anchor is an id divisible by ``every``: of
several rows with that id the one with the smallest label and vector; rows with its own id
are never its candidates, other repeated ids count each for themselves. Ties go to the smaller id,
then to the earlier row of equal ids. Shorter vectors count as filled up with zeros. Components beyond ``LARGEST`` after
scaling are held there, so that scores are exact. Empty tables give empty results; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import store
from .vectors import matrix

SCALE = 256
LARGEST = 1 << 22
BLOCK = 8192
ANCHOR_BLOCK = 1024
#: Anchors of a block whose bounds are held at once.
STRIPE = 128
#: Lengths of segments, coarse to fine.
SEGMENTS = (16, 4)
#: Share of pairs above which all of a stripe is scored by one matrix product.
DENSE = 0.02
#: A negative scores at least and at most this many hundredths of the positive.
LEAST, MOST = 50, 95


class Summary:
    """Means (times the root of the segment's length) and deviations of all segments of a length."""

    def __init__(self, vectors: np.ndarray, length: int) -> None:
        rows, width = vectors.shape
        many = max(1, -(-width // length))
        cut = np.pad(vectors, ((0, 0), (0, many * length - width))).reshape(rows, many, length)
        means = cut.mean(axis=2)
        self.means = (means * np.sqrt(length)).astype(np.float32)
        self.deviations = np.sqrt(((cut - means[:, :, None]) ** 2).sum(axis=2)).astype(np.float32)
        self.lengths = np.sqrt((vectors * vectors).sum(axis=1)).astype(np.float32)


def bounds(a: Summary, b: Summary) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each pair, single precision allowed for."""
    middle = a.means @ b.means.T
    reach = a.deviations @ b.deviations.T
    rounding = np.float32(4e-7 * (16 + a.means.shape[1]))
    reach += rounding * np.outer(a.lengths, b.lengths) + np.float32(1)
    return middle - reach, middle + reach


def exact_scores(queries: np.ndarray, vectors: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, score) of the pairs marked in ``open_``."""
    row, column = np.nonzero(open_)
    width = queries.shape[1]
    top = max(np.abs(queries).max(initial=0), 1) * max(np.abs(vectors).max(initial=0), 1) * max(width, 1)
    if top < 2**53 and len(row) > DENSE * open_.size:
        score = (queries @ vectors.T)[row, column].astype(np.int64)
    else:
        score = np.empty(len(row), np.int64)
        for begin in range(0, len(row), 1 << 16):
            part = slice(begin, begin + (1 << 16))
            score[part] = (queries[row[part]].astype(np.int64) * vectors[column[part]].astype(np.int64)).sum(axis=1)
    return row, column, score


def _kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, minus infinity where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf, np.float32)
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def _first(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each row: highest score, then smaller id."""
    order = np.lexsort((ids, -score, row))
    starts = np.unique(row[order], return_index=True)[1]
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


def _levels(vectors: np.ndarray) -> list[Summary]:
    return [Summary(vectors, length) for length in SEGMENTS]


def _part(summary: Summary, some: slice) -> Summary:
    out = object.__new__(Summary)
    out.means, out.deviations, out.lengths = summary.means[some], summary.deviations[some], summary.lengths[some]
    return out


def best_in_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(place of the query, id, score) of the ``k`` highest scores of each query among rows with other ids."""
    ours, theirs = _levels(queries), _levels(vectors)
    for begin in range(0, len(queries), STRIPE):
        some = slice(begin, begin + STRIPE)
        open_ = query_ids[some, None] != ids
        for a, b in zip(ours, theirs):
            low, high = bounds(_part(a, some), b)
            low[~open_] = -np.inf
            open_ &= high >= _kth_largest(low, k)[:, None]
        row, column, score = exact_scores(queries[some], vectors, open_)
        chosen = _first(row, ids[column], score, k)
        yield begin + row[chosen], ids[column[chosen]], score[chosen]


def windowed_in_block(
    query_ids: np.ndarray, labels: np.ndarray, queries: np.ndarray, least: np.ndarray, most: np.ndarray, ids: np.ndarray, other_labels: np.ndarray, vectors: np.ndarray, k: int
) -> Iterator[tuple[np.ndarray, ...]]:
    """(query, window, id, score) of the ``k`` highest scores inside each window of each query, other labels only.

    ``least`` and ``most`` are queries x windows; a window with least above most is empty.
    """
    ours, theirs = _levels(queries), _levels(vectors)
    for begin in range(0, len(queries), STRIPE):
        some = slice(begin, begin + STRIPE)
        floor, roof = least[some], most[some]
        allowed = (query_ids[some, None] != ids) & (labels[some, None] != other_labels)
        bottom, top = floor.min(axis=1, initial=np.inf), np.where(floor <= roof, roof, -np.inf).max(axis=1, initial=-np.inf)
        for a, b in zip(ours, theirs):
            low, high = bounds(_part(a, some), b)
            allowed &= (low <= top[:, None]) & (high >= bottom[:, None])
            # the k-th score known to lie in a window shuts out what stays below it
            need = np.full(floor.shape, np.inf)
            for w in range(floor.shape[1]):
                inside = np.where(allowed & (low >= floor[:, w, None]) & (high <= roof[:, w, None]), low, -np.inf)
                need[:, w] = np.where(floor[:, w] <= roof[:, w], np.maximum(floor[:, w], _kth_largest(inside, k)), np.inf)
            allowed &= high >= need.min(axis=1, initial=np.inf)[:, None]
        row, column, score = exact_scores(queries[some], vectors, allowed)
        for w in range(floor.shape[1]):
            fits = np.nonzero((score >= floor[row, w]) & (score <= roof[row, w]))[0]
            chosen = fits[_first(row[fits], ids[column[fits]], score[fits], k)]
            yield begin + row[chosen], np.full(len(chosen), w), ids[column[chosen]], score[chosen]


def labelled(vectors: DataFrame, scale: int = SCALE, noisy: int = 7) -> DataFrame:
    """(vec_id, label, embedding) with whole components of the rows that take part."""
    sound = vectors.filter(
        "vec_id is not null and label is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )
    label = F.col("label").cast("bigint")
    if noisy:
        label = F.when(F.col("vec_id") % noisy == 0, (label + 1) % 10).otherwise(label)

    def floored(x):
        held = F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x.cast("double") * scale))
        return F.floor(held).cast("bigint")

    return sound.select(F.col("vec_id").cast("bigint"), label.alias("label"), F.transform("embedding", floored).alias("embedding"))


def _merged(found: DataFrame, keys: list[str], id_column: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), id_column)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def positives(rows: DataFrame, anchors: DataFrame, k: int = 5, block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """(anchor_id, rank, positive_id, score): the ``k`` best rows of each anchor's label; ``rows`` from ``labelled``."""
    # how many blocks a label's rows and anchors take: one row per label, stored, so that its size is known
    asked = anchors.groupBy("label").agg(F.count(F.lit(1)).alias("a"))
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).join(asked, "label")
    blocks = [F.expr(f"cast(({n} + {size - 1}) div {size} as int) as {name}") for n, size, name in (("n", block, "vbs"), ("a", anchor_block, "abs_"))]
    counts = store(counts.select("label", *blocks), "label-blocks")

    def dealt(frame: DataFrame, own: str, many: str, other: str, others: str) -> DataFrame:
        placed = frame.join(counts, "label").withColumn(own, F.pmod(F.xxhash64("vec_id", "embedding"), F.col(many)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop("vbs", "abs_")

    def search(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 3]
        if left.num_rows and right.num_rows:
            width = _width(left, right)
            found += best_in_block(
                left["vec_id"].to_numpy(), matrix(left["embedding"], width), right["vec_id"].to_numpy(), matrix(right["embedding"], width), k
            )
        place, ids, score = (np.concatenate(x) for x in zip(*found))
        anchor = left["vec_id"].to_numpy()[place] if left.num_rows else place
        return pa.table({"anchor_id": pa.array(anchor, pa.int64()), "positive_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())})

    keys = ("label", "ab", "vb")
    left = dealt(anchors, "ab", "abs_", "vb", "vbs").groupBy(*keys)
    right = dealt(rows, "vb", "vbs", "ab", "abs_").groupBy(*keys)
    found = left.cogroup(right).applyInArrow(search, "anchor_id bigint, positive_id bigint, score bigint")
    return _merged(found, ["anchor_id"], "positive_id", k).select("anchor_id", "rank", "positive_id", "score")


def anchor_rows(rows: DataFrame, every: int) -> DataFrame:
    """One row per id divisible by ``every``."""
    least = F.min(F.struct("label", "embedding")).alias("row")
    return rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(least).select("vec_id", "row.label", "row.embedding")


def _width(*tables: pa.Table) -> int:
    return max((matrix(t["embedding"]).shape[1] for t in tables if t.num_rows), default=0)


def mined(
    vectors: DataFrame, every: int = 50, k_positive: int = 5, k_negative: int = 3, least: int = LEAST, most: int = MOST, scale: int = SCALE, noisy: int = 7, block: int = BLOCK, anchor_block: int = ANCHOR_BLOCK
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = store(labelled(vectors, scale, noisy), "labelled-vectors")
    anchors = store(anchor_rows(rows, every), "anchors")
    near = store(positives(rows, anchors, k_positive, block, anchor_block), "anchor-positives")
    windows = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "score"))).alias("positives"))
    # the anchor's label travels with it: rows of its own label are no negatives
    asked = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "embedding", "positives")
    blocks, anchor_blocks = -(-rows.count() // block) or 1, -(-anchors.count() // anchor_block) or 1

    def dealt(frame: DataFrame, own: str, many: int, other: str, others: int) -> DataFrame:
        placed = frame.withColumn(own, F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(many)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    def search(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 4]
        ids = np.zeros((left.num_rows, k_positive), np.int64)
        scores = np.zeros((left.num_rows, k_positive), np.int64)
        if left.num_rows and right.num_rows:
            width = _width(left, right)
            low, high = np.full(ids.shape, np.inf), np.full(ids.shape, -np.inf)
            for i, chosen in enumerate(left["positives"].to_pylist()):
                for w, one in enumerate(chosen):
                    ids[i, w], scores[i, w] = one["positive_id"], one["score"]
                    low[i, w], high[i, w] = -(-least * one["score"] // 100), most * one["score"] // 100
            found += windowed_in_block(
                left["vec_id"].to_numpy(), left["label"].to_numpy(), matrix(left["embedding"], width), low, high,
                right["vec_id"].to_numpy(), right["label"].to_numpy(), matrix(right["embedding"], width), k_negative,
            )
        place, window, negative, score = (np.concatenate(x) for x in zip(*found))
        anchor = left["vec_id"].to_numpy()[place] if left.num_rows else place
        columns = [anchor, ids[place, window] if left.num_rows else place, scores[place, window] if left.num_rows else place, window, negative, score]
        names = ["anchor_id", "positive_id", "positive_score", "window", "negative_id", "score"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    left = dealt(asked, "ab", anchor_blocks, "vb", blocks).groupBy("ab", "vb")
    right = dealt(rows, "vb", blocks, "ab", anchor_blocks).groupBy("ab", "vb")
    kind = "anchor_id bigint, positive_id bigint, positive_score bigint, window bigint, negative_id bigint, score bigint"
    found = left.cogroup(right).applyInArrow(search, kind)
    return _merged(found, ["anchor_id", "window"], "negative_id", k_negative).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )
