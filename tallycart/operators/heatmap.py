"""Weekday by hour: at most 168 cells, or 24 per day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import day_code, day_text, money, ratio


def _cells(purchases: DataFrame, *keys) -> DataFrame:
    return purchases.groupBy(*keys).agg(
        F.sum("revenue_e4").alias("revenue_e4"), F.count_distinct("order_id").alias("orders")
    )


def heatmap_cube(purchases: DataFrame) -> DataFrame:
    return _cells(purchases, F.dayofweek("event_date").alias("weekday"), "hour")


def heatmap_daily_cube(purchases: DataFrame) -> DataFrame:
    """Per day and hour; the weekday follows from the day."""
    return _cells(purchases, "event_date", "hour").select(
        "event_date", F.dayofweek("event_date").alias("weekday"), "hour", "revenue_e4", "orders"
    )


def heatmap(cells: DataFrame) -> DataFrame:
    return cells.select(
        "weekday", day_code("weekday").alias("day_name"), "hour", money("revenue_e4").alias("revenue"), "orders"
    )


def heatmap_daily(cells: DataFrame) -> DataFrame:
    return cells.select(
        day_text("event_date").alias("event_date"), "weekday", "hour", money("revenue_e4").alias("revenue"), "orders"
    )


def heatmap_intensity(cells: DataFrame) -> DataFrame:
    """Orders as a share of the busiest cell."""
    busiest = cells.agg(F.greatest(F.max("orders"), F.lit(1)).cast("bigint"))
    return heatmap(cells).withColumn("intensity", ratio("orders", busiest.scalar(), 1, 4))


def peak_window(cells: DataFrame) -> DataFrame:
    """The cell with most orders, then most revenue; no row without purchases."""
    busiest = cells.orderBy(F.col("orders").desc(), F.col("revenue_e4").desc(), "weekday", "hour").limit(1)
    return heatmap(busiest)


def hourly_pattern(purchases: DataFrame) -> DataFrame:
    return _cells(purchases, "hour").select("hour", money("revenue_e4").alias("revenue"), "orders").orderBy("hour")


def hourly_cells(cells: DataFrame) -> DataFrame:
    """Hours added up from the weekday cells; an order is counted once per weekday."""
    sums = cells.groupBy("hour").agg(F.sum("revenue_e4").alias("revenue_e4"), F.sum("orders").alias("orders"))
    return sums.select("hour", money("revenue_e4").alias("revenue"), "orders").orderBy("hour")
