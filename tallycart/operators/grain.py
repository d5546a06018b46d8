"""Reduced grains that the aggregate tables roll up from.

Three tables stand between the events and the cubes, each combined before its exchange, so that a
hot order, buyer or visitor shrinks to what the calendar and the categories allow:

* order grain: revenue per (order, day, hour, category);
* buyer grain: (buyer, day, category);
* visits: events per (type, session, user, day), of all events.

They are stored in buckets of the order, the buyer and the user. A distinct count over any
key is then two plain sums: one row per (key, order) within a bucket, and those rows counted per
key. The first needs no exchange, the second moves one row per key and task. Nothing is expanded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import materialize_by

FIGURES = ("revenue_e4", "orders", "buyers")


def order_grain(purchases: DataFrame) -> DataFrame:
    return purchases.groupBy("order_id", "event_date", "hour", "category").agg(F.sum("revenue_e4").alias("revenue_e4"))


def buyer_grain(purchases: DataFrame) -> DataFrame:
    return purchases.select("user_id", "event_date", "category").distinct()


def visits(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", "order_id", "user_id", "event_date").agg(F.count(F.lit(1)).alias("count"))


def stored_orders(purchases: DataFrame) -> DataFrame:
    return materialize_by(order_grain(purchases), "order_id", "order-grain")


def stored_buyers(purchases: DataFrame) -> DataFrame:
    return materialize_by(buyer_grain(purchases), "user_id", "buyer-grain")


def stored_visits(events: DataFrame) -> DataFrame:
    return materialize_by(visits(events), "user_id", "visits")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _one() -> Column:
    return F.lit(1).cast("bigint")


def order_figures(orders: DataFrame, *by: Column | str) -> DataFrame:
    """Revenue and distinct orders per key."""
    names = orders.select(*by).columns
    each = orders.groupBy("order_id", *by).agg(F.sum("revenue_e4").alias("revenue_e4"))
    return each.groupBy(*names).agg(F.sum("revenue_e4").alias("revenue_e4"), F.count(F.lit(1)).alias("orders"))


def figures(orders: DataFrame, buyers: DataFrame, *by: Column | str) -> DataFrame:
    """Revenue, distinct orders and distinct buyers per key, from the order and the buyer grain.

    One row per (key, order) and one per (key, buyer) are added up together, so the two sides
    meet without a join.
    """
    names = orders.select(*by).columns
    sold = orders.groupBy("order_id", *by).agg(F.sum("revenue_e4").alias("revenue_e4"))
    bought = buyers.select("user_id", *by).distinct()
    rows = sold.select(*names, "revenue_e4", _one().alias("orders"), _zero().alias("buyers")).unionByName(
        bought.select(*names, _zero().alias("revenue_e4"), _zero().alias("orders"), _one().alias("buyers"))
    )
    return rows.groupBy(*names).agg(*[F.sum(f).alias(f) for f in FIGURES])
