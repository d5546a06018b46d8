"""Headline figures as one row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import avg_ratio, money, ratio, units_ratio
from ..functions.numbers import exact_ratio
from .funnel import STEPS, funnel, step_totals
from .series import revenue_growth


def purchase_totals(purchases: DataFrame) -> DataFrame:
    """Revenue, distinct orders and average order value."""
    sums = purchases.agg(
        F.coalesce(F.sum("revenue_e4"), F.lit(0)).alias("revenue_e4"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    return totals_row(sums)


def totals_row(sums: DataFrame) -> DataFrame:
    """The published totals from ``revenue_e4`` and ``total_orders``."""
    return sums.select(
        money("revenue_e4").alias("total_revenue"),
        "total_orders",
        # the published revenue has two places; the average divides that figure
        units_ratio(F.round(F.col("revenue_e4").cast("decimal(20,0)"), -2), "total_orders", default=0).alias(
            "average_order_value"
        ),
    )


def mean_clv(users: DataFrame) -> DataFrame:
    """Mean over buyers of revenue per order."""
    clv = exact_ratio("revenue_e4", F.col("orders") * 10_000)
    return users.agg(F.round(F.avg(F.coalesce(clv, F.lit(0)).cast("decimal(28,10)")), 2).cast("double").alias("clv"))


def kpi_totals(counts: DataFrame, purchases: DataFrame, daily: DataFrame, users: DataFrame) -> DataFrame:
    """All headline figures; every part is a one-row result read as a scalar."""
    steps = step_totals(counts)
    rates = funnel(counts)
    per_day = daily.agg(avg_ratio("buyers").alias("v"))
    return purchase_totals(purchases).select(
        steps.select(sum((F.col(s) for s in STEPS), F.lit(0)).cast("bigint")).scalar().alias("total_events"),
        "total_revenue",
        "total_orders",
        "average_order_value",
        per_day.scalar().alias("daily_active_users_avg"),
        mean_clv(users).scalar().alias("estimated_clv"),
        rates.select("cart_to_purchase_pct").scalar().alias("conversion_rate_pct"),
        steps.select(ratio("purchase", "view", 100, default=0)).scalar().alias("overall_conversion_pct"),
        revenue_growth(daily).scalar().alias("revenue_growth_pct"),
    )
