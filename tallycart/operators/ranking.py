"""Global order without a one-task window.

``Window.orderBy`` without a partition sends every row to one task. That is
right for tables bounded by the calendar and wrong for users or products.
Here a table larger than ``ROWS_PER_TASK`` is range partitioned on a unique
key (what ``sort`` does), each range is numbered on its own, and the ranges'
starting offsets - one row per range - are added back.

The range number is written with the rows before it is used twice, so a lost
executor cannot renumber ranges between the two uses.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import materialize

ROWS_PER_TASK = 1_000_000
# orderBy().limit(n) keeps n rows per task; beyond this a range sort is used.
TOP_ROWS = 100_000


def with_running(
    table: DataFrame,
    order: Sequence[Column],
    value: str | None = None,
    rows_per_task: int | None = None,
    upto: int | None = None,
) -> DataFrame:
    """Add ``row_no`` (1-based) and, for ``value``, ``running`` over ``order``.

    ``order`` must end in a unique key. ``table`` is read more than once, so
    pass a materialized one. With ``upto`` only the first rows are returned and
    ranges behind them are not sorted.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    parts = math.ceil(table.count() / rows_per_task)
    up_to_here = (Window.unboundedPreceding, Window.currentRow)
    if parts <= 1:
        one = Window.orderBy(*order)
        out = table.withColumn("row_no", F.row_number().over(one).cast("bigint"))
        if value:
            out = out.withColumn("running", F.sum(value).over(one.rowsBetween(*up_to_here)))
        return out if upto is None else out.filter(F.col("row_no") <= upto)

    ranged = table.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    sizes = ranged.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"),
        (F.sum(value) if value else F.lit(0)).alias("_sum"),
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select(
        "_range",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum0"),
    )
    if upto is not None:
        starts = starts.filter(F.col("_n0") < upto)
    local = Window.partitionBy("_range").orderBy(*order)
    out = ranged.join(F.broadcast(starts), "_range")  # at most `parts` rows
    out = out.withColumn("row_no", F.row_number().over(local) + F.col("_n0"))
    if value:
        out = out.withColumn("running", F.sum(value).over(local.rowsBetween(*up_to_here)) + F.col("_sum0"))
    out = out.drop("_range", "_n0", "_sum0")
    return out if upto is None else out.filter(F.col("row_no") <= upto)


def first_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of ``order``; large ``n`` never meets in one task."""
    if n <= TOP_ROWS:
        return df.orderBy(*order).limit(n)
    # equal rows get a stored number each, so that even a third of all rows
    # being alike can be cut into ranges
    stored = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "capped")
    return with_running(stored, [*order, F.col("_tie")], upto=n).drop("row_no", "_tie")


def bucket_starts(n: int, q: int = 5) -> list[int]:
    """Ranks at which quantile buckets 2..min(q, n) of ranks 1..n begin.

    Bucket of rank r is max(1, ceil((r-1) * q / (n-1))), the right-closed
    linear-interpolation quantile bucket of a rank column.
    """
    q = min(q, n)
    return [j * (n - 1) // q + 2 for j in range(1, q)]


def quantile_buckets(
    table: DataFrame,
    key: str,
    metrics: dict[str, Column],
    q: int = 5,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add a 1-based quantile bucket per metric, rank ties broken by ``key``.

    ``metrics`` maps output column to a BIGINT expression ranked ascending.
    All metrics are ranked in one range sort of (metric, value, key) rows, of
    which only the few rows where a bucket starts are kept; the table itself
    is then labelled in place by comparing with those rows, without a shuffle.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    n = table.count()
    starts = bucket_starts(n, q)
    if not starts:
        return table.select("*", *[F.lit(1).alias(name) for name in metrics])

    long = table.select(
        key,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("metric"), expr.cast("bigint").alias("value"))
                    for i, expr in enumerate(metrics.values())
                ]
            )
        ).alias("m"),
    ).select("m.metric", "m.value", key)
    cuts = _rows_at(long, ["metric"], ["value", key], starts, n * len(metrics), rows_per_task)
    one_row = cuts.agg(
        *[
            F.max(
                F.when(
                    (F.col("metric") == i) & (F.col("_rank") == rank),
                    F.struct(F.col("value"), F.col(key).alias("key")),
                )
            ).alias(f"c{i}_{j}")
            for i in range(len(metrics))
            for j, rank in enumerate(starts)
        ]
    )
    bounds = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("b"))
    labelled = table.withColumn("_cuts", bounds.scalar())
    for i, (name, expr) in enumerate(metrics.items()):
        here = F.struct(expr.cast("bigint").alias("value"), F.col(key).alias("key"))
        passed = [(here >= F.col(f"_cuts.c{i}_{j}")).cast("int") for j in range(len(starts))]
        labelled = labelled.withColumn(name, sum(passed, F.lit(1)))
    return labelled.drop("_cuts")


def _rows_at(
    df: DataFrame,
    group: list[str],
    order: list[str],
    ranks: Sequence[int],
    rows: int,
    rows_per_task: int,
) -> DataFrame:
    """The rows holding the given ranks within each of a few large groups."""
    parts = math.ceil(rows / rows_per_task)
    if parts <= 1:
        local = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn("_rank", F.row_number().over(local)).filter(F.col("_rank").isin(list(ranks)))

    ranged = df.repartitionByRange(parts, *group, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranks")
    sizes = ranged.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        sizes.withColumn("_n0", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn("_rank", F.explode(F.array(*[F.lit(r) for r in ranks])))
        .filter((F.col("_rank") > F.col("_n0")) & (F.col("_rank") <= F.col("_n0") + F.col("_n")))
        .select(*group, "_range", "_n0", "_rank")
    )
    # ranks x groups rows: a handful, so only the ranges that hold a wanted row are sorted
    hits = wanted.select(*group, "_range", "_n0").distinct()
    local = Window.partitionBy(*group, "_range").orderBy(*order)
    numbered = (
        ranged.join(F.broadcast(hits), [*group, "_range"])
        .withColumn("_rank", F.row_number().over(local) + F.col("_n0"))
        .drop("_range", "_n0")
    )
    return numbered.filter(F.col("_rank").isin(list(ranks)))
