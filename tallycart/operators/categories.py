"""Category metrics.

Shares divide by a scalar subquery and top lists use a bounded sort, so the
number of categories is never assumed to be small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import day_text, money, ratio, title_case, units_ratio
from ..sources.scratch import materialize
from .ranking import first_rows, with_running
from .series import totals_by

FILTER_LIST_SIZE = 50
HERO_SHARE_PCT = 30
CORE_SHARE_PCT = 80


def category_cube(purchases: DataFrame) -> DataFrame:
    return totals_by(purchases, "category")


def category_daily_cube(purchases: DataFrame) -> DataFrame:
    return totals_by(purchases, "event_date", "category")


def category_summary(categories: DataFrame) -> DataFrame:
    return categories.select("category", money("revenue_e4").alias("revenue"), "orders", "buyers").orderBy(
        F.col("revenue").desc(), "category"
    )


def category_daily(cube: DataFrame) -> DataFrame:
    return cube.select(
        day_text("event_date").alias("event_date"),
        "category",
        money("revenue_e4").alias("revenue"),
        "orders",
        "buyers",
    )


def total_units(table: DataFrame):
    """Scalar: summed revenue of a table, NULL when empty."""
    return table.agg(F.sum(F.col("revenue_e4").cast("decimal(28,0)")).cast("decimal(20,0)")).scalar()


def category_share(categories: DataFrame) -> DataFrame:
    """Share of revenue and average order value."""
    return categories.select(
        "category",
        title_case("category").alias("label"),
        money("revenue_e4").alias("revenue"),
        "orders",
        "buyers",
        ratio("revenue_e4", total_units(categories), 100).alias("revenue_share_pct"),
        units_ratio("revenue_e4", "orders", default=0).alias("avg_order_value"),
    ).orderBy(F.col("revenue").desc(), "category")


def category_growth(purchases: DataFrame) -> DataFrame:
    """Each category's last month against its month before."""
    months = purchases.groupBy("category", F.trunc("event_date", "MM").alias("month")).agg(
        F.sum("revenue_e4").alias("revenue_e4")
    )
    w = Window.partitionBy("category").orderBy("month")  # one row per month
    return (
        months.withColumn("prev", F.lag("revenue_e4").over(w))
        .groupBy("category")
        .agg(F.max_by(F.struct("month", "revenue_e4", "prev"), "month").alias("m"))
        .select(
            "category",
            F.date_format("m.month", "yyyy-MM").alias("month"),
            money("m.revenue_e4").alias("revenue"),
            ratio(F.col("m.revenue_e4") - F.col("m.prev"), "m.prev", 100).alias("growth_pct"),
        )
        .orderBy("category")
    )


def category_filter_list(categories: DataFrame, size: int = FILTER_LIST_SIZE) -> DataFrame:
    """The first categories by revenue, with their position."""
    top = first_rows(categories, [F.col("revenue_e4").desc(), F.col("category")], size)
    w = Window.orderBy(F.col("revenue_e4").desc(), "category")  # at most `size` rows
    return top.select("category", F.row_number().over(w).alias("position"))


def abc_class(share: str):
    """Tag of a cumulative share in percent."""
    return (
        F.when(F.col(share) <= HERO_SHARE_PCT, "Hero SKU")
        .when(F.col(share) <= CORE_SHARE_PCT, "Core")
        .otherwise("Long Tail")
    )


def category_pareto(categories: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Categories standing in for products: running share with one place, and its tag."""
    table = materialize(categories, "categories")
    order = [F.col("revenue_e4").desc(), F.col("category")]
    return (
        with_running(table, order, "revenue_e4", rows_per_task)
        .select(
            "category",
            title_case("category").alias("product_name"),
            money("revenue_e4").alias("revenue"),
            F.col("orders").alias("quantity"),
            ratio("running", total_units(table), 100, 1).alias("cumulative_share_pct"),
        )
        .withColumn("abc_class", abc_class("cumulative_share_pct"))
    )
