"""The dashboard as one long table, and the insight cards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio, title_case

CARDS = 4


def _rows(df: DataFrame, dimension: Column | None, **metrics: str) -> DataFrame:
    """Unpivot columns of a small report to (metric, dimension, value)."""
    dim = dimension if dimension is not None else F.lit(None).cast("string")
    cells = [
        F.struct(F.lit(name).alias("metric"), dim.alias("dimension"), F.col(column).cast("double").alias("value"))
        for name, column in metrics.items()
    ]
    return df.select(F.inline(F.array(*cells)))


def dashboard_snapshot(
    kpis: DataFrame,
    cards: DataFrame,
    delta: DataFrame,
    categories: DataFrame,
    products: DataFrame,
    funnel_row: DataFrame,
    segments: DataFrame,
    peak: DataFrame,
    top: int = 5,
) -> DataFrame:
    """Everything the dashboard shows as (metric, dimension, value) rows."""
    best_categories = categories.orderBy(F.col("revenue").desc(), "category").limit(top)
    best_products = products.orderBy(F.col("revenue").desc(), "product_id").limit(top)
    parts = [
        _rows(
            kpis,
            None,
            total_revenue="total_revenue",
            total_orders="total_orders",
            average_order_value="average_order_value",
            daily_active_users_avg="daily_active_users_avg",
            conversion_rate_pct="conversion_rate_pct",
        ),
        _rows(cards, None, returning_customers_pct="returning_pct", churn_list="churn_list", churn_candidates="churn_candidates"),
        _rows(
            delta,
            F.col("current_month"),
            month_revenue_pct="revenue_pct",
            month_orders_pct="orders_pct",
            month_buyers_pct="buyers_pct",
        ),
        _rows(best_categories, F.col("category"), category_revenue="revenue", category_orders="orders"),
        _rows(best_products, F.col("product_id").cast("string"), product_revenue="revenue"),
        _rows(
            funnel_row,
            None,
            view="view",
            cart="cart",
            purchase="purchase",
            view_to_cart_pct="view_to_cart_pct",
            cart_to_purchase_pct="cart_to_purchase_pct",
        ),
        _rows(segments, F.col("segment"), segment_customers="customers", segment_revenue="revenue"),
        _rows(peak, None, peak_weekday="weekday", peak_hour="hour", peak_orders="orders", peak_revenue="revenue"),
    ]
    return reduce(DataFrame.unionByName, parts)


def _card(df: DataFrame, position: int, title: str, detail: Column, action: str) -> DataFrame:
    return df.select(
        F.lit(position).alias("position"), F.lit(title).alias("title"), detail.alias("detail"), F.lit(action).alias("action")
    )


def insights(
    pareto: DataFrame,
    peak: DataFrame,
    funnel_row: DataFrame,
    categories: DataFrame,
    capabilities: DataFrame,
    cards: int = CARDS,
) -> DataFrame:
    """Cards worded from the figures; one more when traffic events are missing."""
    share = ratio("top_products_for_80pct", "product_count", 100, 1)
    gap = categories.agg(
        F.max_by("category", F.struct("revenue", "category")).alias("best"),
        F.min_by("category", F.struct("revenue", "category")).alias("worst"),
    ).filter("best <> worst")
    parts = [
        _card(
            pareto.filter("product_count > 0"),
            1,
            "Revenue concentration",
            F.concat(share.cast("decimal(10,1)").cast("string"), F.lit("% of products bring in 80% of revenue.")),
            "Keep these products in stock first.",
        ),
        _card(
            peak,
            2,
            "Busiest hour",
            F.concat(F.lit("Most orders arrive on "), F.col("day_name"), F.lit(" at "), F.lpad(F.col("hour").cast("string"), 2, "0"), F.lit(":00.")),
            "Time campaigns to this hour.",
        ),
        _card(
            funnel_row.filter(F.col("available") & (F.col("drop_off_cart_to_purchase_pct") > 0)),
            3,
            "Lost carts",
            F.concat(F.col("drop_off_cart_to_purchase_pct").cast("decimal(10,2)").cast("string"), F.lit("% of carts do not end in a purchase.")),
            "Review the checkout steps.",
        ),
        _card(
            gap,
            4,
            "Category gap",
            F.concat(title_case("best"), F.lit(" earns most and "), title_case("worst"), F.lit(" least.")),
            "Check range and placement of the weakest category.",
        ),
        _card(
            capabilities.filter(~F.col("traffic_events_available")),
            5,
            "No traffic data",
            F.lit("The source holds no view events."),
            "Add a traffic source to see the funnel.",
        ),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("position").limit(cards)
