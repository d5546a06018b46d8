"""Exact distinct buyers and orders of any range of days, from staged bitmaps.

Orders and buyers are numbered without gaps in the order of their first day, so the ids of one day lie close together.
Per day and category one bitmap for each block of 32,768 numbers that occurs tells who bought and which orders
there were. A range ORs the bitmaps of its days and counts bits: no event is read, and nobody seen on
two days or in two categories counts twice.

A bitmap has 4 KB before compression. Days hold bitmaps of few blocks because numbers follow first days;
returning buyers spread over older blocks, at worst one bitmap per buyer, day and category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import money, units_ratio
from ..sources.scratch import materialize
from .filters import filter_view, ordered_range
from .ranking import with_running

KINDS = {"order": "order_id", "user": "user_id"}


def numbered(grain: DataFrame, key: str) -> DataFrame:
    """(key, number): numbers from 1 in the order of first days, then keys."""
    first = grain.groupBy(key).agg(F.min("event_date").alias("first_day")).withColumn("one", F.lit(1).cast("bigint"))
    stored = materialize(first, f"first-{key}")
    return with_running(stored, [F.col("first_day"), F.col(key)], "one").select(key, F.col("running").cast("bigint").alias("number"))


def range_bitmaps(orders: DataFrame, buyers: DataFrame) -> DataFrame:
    """(event_date, category, kind, block, bits) from the order and the buyer grain.

    The numbers themselves are dealt to their bitmaps, at most 32,768 to each. Bitmaps made before the exchange
    would have 4 KB for each few numbers a task holds, and sorting those took most of the time.
    """

    def places(kind: str, grain: DataFrame) -> DataFrame:
        key = KINDS[kind]
        days = grain.select(key, "event_date", "category").distinct().join(numbered(grain, key), key)
        block, place = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
        return days.select("event_date", "category", F.lit(kind).alias("kind"), block.alias("block"), place.alias("place"))

    one = ("event_date", "category", "kind", "block")
    both = places("order", orders).unionByName(places("user", buyers))
    return both.repartition(*one).groupBy(*one).agg(F.bitmap_construct_agg("place").alias("bits"))


def distinct_in_range(bitmaps: DataFrame, start: str | None = None, end: str | None = None, category: str | None = None) -> DataFrame:
    """One row: exact ``orders`` and ``buyers`` of the days and the category, all where none is given."""
    start, end = ordered_range(start, end)
    chosen = filter_view(bitmaps, start, end)
    if category:
        chosen = chosen.filter(F.col("category") == category)
    blocks = chosen.groupBy("kind", "block").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))

    def of(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).cast("bigint")

    return blocks.agg(of("order").alias("orders"), of("user").alias("buyers"))


def exact_view(bitmaps: DataFrame, category_daily: DataFrame, start: str | None = None, end: str | None = None, category: str | None = None) -> DataFrame:
    """Revenue, orders, buyers and average order value of a range and a category, from staged tables alone."""
    start, end = ordered_range(start, end)
    days = filter_view(category_daily, start, end)
    if category:
        days = days.filter(F.col("category") == category)
    revenue = days.agg(F.coalesce(F.sum("revenue_e4"), F.lit(0))).scalar()
    counts = distinct_in_range(bitmaps, start, end, category).withColumn("revenue_e4", revenue)
    return counts.select(
        money("revenue_e4").alias("revenue"), "orders", "buyers", units_ratio("revenue_e4", "orders", default=0).alias("avg_order_value")
    )
