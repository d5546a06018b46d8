"""Promotion attribution.

A promotion covers its categories on its days. Promotions are spelled out as
(category, day) cells, so attribution is an equality join on both columns
instead of a range join on a hot category. The first and last promoted day bound
the purchase time, so the scan skips the rest; cells are joined before anything is
grouped. No hint stands in the way: adaptive execution broadcasts cells by their
measured bytes, or shuffles and splits hot cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import money, ratio
from ..sources.scratch import materialize
from .clean import between_days


def promotion_cells(promotions: DataFrame, with_baseline: bool = False) -> DataFrame:
    """(promotion_id, category, event_date, active) per covered day.

    With a baseline, the equally long period just before is added with
    ``active = false``.
    """
    length = F.datediff("end_date", "start_date") + 1
    first = F.date_sub("start_date", length) if with_baseline else F.col("start_date")
    return (
        promotions.filter("start_date <= end_date")
        .select(
            "promotion_id",
            "discount_pct",
            "start_date",
            F.explode(F.array_distinct("categories")).alias("category"),
            first.alias("first"),
            "end_date",
        )
        .select("*", F.explode(F.sequence("first", "end_date")).alias("event_date"))
        .select(
            "promotion_id",
            "discount_pct",
            "category",
            "event_date",
            (F.col("event_date") >= F.col("start_date")).alias("active"),
        )
    )


def promoted_days(purchases: DataFrame, promotions: DataFrame, with_baseline: bool = False) -> DataFrame:
    """Purchases between the first and the last day any promotion (or its baseline) covers.

    The bounds are one row, read when the plan is built, so that they reach the scan.
    """
    length = F.datediff("end_date", "start_date") + 1
    first = F.date_sub("start_date", length) if with_baseline else F.col("start_date")
    bounds = promotions.filter("start_date <= end_date").agg(
        F.min(first).cast("string").alias("first"), F.max("end_date").cast("string").alias("last")
    )
    row = bounds.first()
    return between_days(purchases, row["first"], row["last"]) if row["first"] else purchases.filter(F.lit(False))


def promotion_performance(purchases: DataFrame, promotions: DataFrame) -> DataFrame:
    """Orders, revenue, participants, repeat buyers and lift per promotion.

    Lift compares distinct orders with those of the equally long period just
    before in the same categories; NULL when that period had none.
    """
    cells = promotion_cells(promotions, with_baseline=True).drop("discount_pct")
    covered = promoted_days(purchases, promotions, with_baseline=True)
    covered = covered.select("category", "event_date", "order_id", "user_id", "revenue_e4")
    matched = (
        covered.join(cells, ["category", "event_date"])
        .groupBy("promotion_id", "user_id", "order_id")
        .agg(
            F.sum(F.when(F.col("active"), F.col("revenue_e4"))).alias("revenue_e4"),
            F.bool_or("active").alias("inside"),
            F.bool_or(~F.col("active")).alias("before"),
        )
    )
    matched = materialize(matched, "promotion-orders")
    per_promotion = matched.groupBy("promotion_id").agg(
        F.count_distinct(F.when(F.col("inside"), F.col("order_id"))).alias("orders_generated"),
        F.count_distinct(F.when(F.col("before"), F.col("order_id"))).alias("orders_before"),
        F.sum("revenue_e4").alias("revenue_e4"),
    )
    per_user = (
        matched.filter("inside")
        .groupBy("promotion_id", "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("promotion_id")
        .agg(F.count(F.lit(1)).alias("participants"), F.count_if(F.col("n") >= 2).alias("repeaters"))
    )
    zero = F.lit(0)
    found = (
        promotions.select("promotion_id").distinct()
        .join(per_promotion, "promotion_id", "left")
        .join(per_user, "promotion_id", "left")
        .fillna(0)
    )
    inside, before = F.col("orders_generated"), F.col("orders_before")
    return found.select(
        "promotion_id",
        inside.alias("orders_generated"),
        money(F.coalesce("revenue_e4", zero)).alias("revenue_generated"),
        F.col("participants").alias("total_participants"),
        ratio("repeaters", "participants", 100, default=0).alias("repeat_purchase_rate_pct"),
        ratio(inside - before, before, 100).alias("order_lift_pct"),
    )


def with_promotion_flag(purchases: DataFrame, promotions: DataFrame) -> DataFrame:
    """Add ``promoted``: covered by at least one promotion."""
    cells = promotion_cells(promotions).select("category", "event_date").distinct().withColumn("hit", F.lit(True))
    joined = purchases.join(cells, ["category", "event_date"], "left")
    return joined.withColumn("promoted", F.coalesce("hit", F.lit(False))).drop("hit")


def promotion_share(purchases: DataFrame, promotions: DataFrame, grain: Column) -> DataFrame:
    """Per ``grain``: percent of orders touched by a promotion and of revenue under one."""
    order = F.when(F.col("promoted"), F.col("order_id"))
    revenue = F.sum(F.when(F.col("promoted"), F.col("revenue_e4")).otherwise(0))
    return (
        with_promotion_flag(purchases, promotions)
        .groupBy(grain)
        .agg(
            ratio(F.count_distinct(order), F.count_distinct("order_id"), 100, default=0).alias("promotion_orders_pct"),
            ratio(revenue, F.sum("revenue_e4"), 100, default=0).alias("promotion_contribution_pct"),
        )
    )


def promotion_discount(purchases: DataFrame, promotions: DataFrame) -> DataFrame:
    """Mean discount over covered purchase events, one row."""
    cells = promotion_cells(promotions).select("category", "event_date", "discount_pct")
    hits = promoted_days(purchases, promotions).select("category", "event_date").join(cells, ["category", "event_date"])
    # count per discount first: the mean then adds few numbers in a fixed type
    counted = hits.groupBy("discount_pct").agg(F.count(F.lit(1)).alias("n"))
    units = F.col("discount_pct").cast("decimal(18,4)") * F.col("n")
    mean = F.round(F.try_divide(F.sum(units), F.sum("n")), 2).cast("double")
    return counted.agg(F.coalesce(mean, F.lit(0.0)).alias("avg_promotion_discount_pct"))
