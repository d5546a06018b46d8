"""Filtered dashboard views over the day-grain cubes.

Everything here reads cubes whose size depends on days, categories and hours,
not on events. Figures that add daily distinct counts keep the dashboard's
additive meaning; ``exact_range`` and ``estimated_range`` give the distinct
counts of an arbitrary range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import avg_ratio, money, ratio, units_ratio
from .filters import filter_view, ordered_range
from .clean import between_days
from .series import date_range


def reaggregate(cube: DataFrame, *keys: str) -> DataFrame:
    """Add up a cube's additive columns over fewer keys; missing numbers count as 0."""
    names = [c for c in ("revenue_e4", "orders", "buyers") if c in cube.columns]
    kept = cube.dropna(subset=list(keys))
    for key in keys:
        if dict(cube.dtypes)[key] == "string":
            kept = kept.filter(F.col(key) != "")  # an unnamed key is no key
    return kept.groupBy(*keys).agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in names])


def view_categories(category_daily: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Categories of the range, best first. The chosen category does not filter them."""
    return (
        reaggregate(filter_view(category_daily, start, end), "category")
        .select("category", money("revenue_e4").alias("revenue"), "orders", "buyers")
        .orderBy(F.col("revenue").desc(), "category")
    )


def view_heatmap(heatmap_daily: DataFrame, start: str | None, end: str | None) -> DataFrame:
    return reaggregate(filter_view(heatmap_daily, start, end), "weekday", "hour").select(
        "weekday", "hour", money("revenue_e4").alias("revenue"), "orders"
    )


def chosen_share(category_daily: DataFrame, category: str | None) -> Column:
    """Scalar: the chosen category's part of revenue; 1 without one or when unknown."""
    if not category:
        return F.lit(1.0)
    mine = F.sum(F.when(F.col("category") == category, F.col("revenue_e4")))
    share = F.try_divide(mine.cast("double"), F.sum("revenue_e4").cast("double"))
    return category_daily.agg(F.coalesce(share, F.lit(1.0))).scalar()


def _scaled(value: Column, share: Column, digits: int = 2) -> Column:
    return F.round((value * share).cast("decimal(38,8)"), digits).cast("double")


def view_allocation(
    daily: DataFrame,
    category_daily: DataFrame,
    start: str | None,
    end: str | None,
    category: str | None,
) -> DataFrame:
    """Daily figures scaled by the chosen category's share: an estimate."""
    share = chosen_share(filter_view(category_daily, start, end), category)
    return (
        filter_view(daily, start, end)
        .select(
            F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
            _scaled(F.col("revenue_e4") / F.lit(10_000.0), share).alias("revenue"),
            _scaled(F.col("orders").cast("double"), share).alias("orders"),
            _scaled(F.col("buyers").cast("double"), share).alias("dau"),
        )
        .orderBy("event_date")
    )


def view_heatmap_allocated(
    heatmap_daily: DataFrame,
    category_daily: DataFrame,
    start: str | None,
    end: str | None,
    category: str | None,
) -> DataFrame:
    """Heatmap scaled by the chosen category's share."""
    share = chosen_share(filter_view(category_daily, start, end), category)
    return reaggregate(filter_view(heatmap_daily, start, end), "weekday", "hour").select(
        "weekday",
        "hour",
        _scaled(F.col("revenue_e4") / F.lit(10_000.0), share).alias("revenue"),
        _scaled(F.col("orders").cast("double"), share).alias("orders"),
    )


def view_funnel(
    funnel_row: DataFrame, category_daily: DataFrame, start: str | None, end: str | None, category: str | None
) -> DataFrame:
    """Funnel counts scaled by the chosen category's share; rates stay."""
    share = chosen_share(filter_view(category_daily, start, end), category)
    scaled = {s: F.floor(F.col(s) * share + F.lit(0.5)) for s in ("view", "cart", "purchase")}
    return funnel_row.withColumns(scaled)


def is_filtered(daily: DataFrame, category_daily: DataFrame, start, end, category) -> Column:
    """Scalar: a bound differs from the data's range or a known category is chosen."""
    whole = date_range(daily)
    tests = [F.lit(False)]
    if start:
        tests.append(whole.select(F.col("start") != start).scalar())
    if end:
        tests.append(whole.select(F.col("end") != end).scalar())
    if category:
        in_range = filter_view(category_daily, start, end)
        known = in_range.agg(F.coalesce(F.bool_or(F.col("category") == category), F.lit(False)))
        tests.append(known.scalar())
    out = tests[0]
    for t in tests[1:]:
        out = out | F.coalesce(t, F.lit(False))
    return out


def view_kpis(
    totals: DataFrame,
    daily: DataFrame,
    category_daily: DataFrame,
    start: str | None = None,
    end: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """Headline figures under a filter; the whole-data figures when nothing is filtered.

    ``totals`` is the one-row frame of ``kpi.purchase_totals``.
    """
    start, end = ordered_range(start, end)
    in_range = filter_view(category_daily, start, end)
    share = chosen_share(in_range, category)
    sums = filter_view(daily, start, end).agg(
        F.coalesce(F.sum("revenue_e4"), F.lit(0)).alias("revenue_e4"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.coalesce(F.sum("buyers"), F.lit(0)).alias("buyers"),
        F.count(F.lit(1)).alias("days"),
    )
    whole_dau = daily.agg(avg_ratio("buyers")).scalar()
    mine = F.lit(None).cast("bigint")
    if category:
        mine = in_range.filter(F.col("category") == category).agg(F.sum("buyers")).scalar()
    flag = is_filtered(daily, category_daily, start, end, category)
    dau = F.coalesce(
        F.try_divide(F.col("buyers").cast("double") * share, F.col("days").cast("double")), F.lit(0.0)
    )

    def pick(filtered: Column, name: str) -> Column:
        return F.when(F.col("is_filtered"), filtered).otherwise(F.col(f"whole.{name}")).alias(name)

    # one struct, so that the totals are computed once and not per figure
    whole = totals.select(F.struct(*totals.columns)).scalar()
    return sums.withColumn("is_filtered", flag).withColumn("whole", whole).select(
        "is_filtered",
        pick(_scaled(F.col("revenue_e4") / F.lit(10_000.0), share), "total_revenue"),
        pick(F.floor(F.col("orders") * share + F.lit(0.5)), "total_orders"),
        pick(units_ratio("revenue_e4", "orders", default=0), "average_order_value"),
        F.when(F.col("is_filtered"), F.round(dau.cast("decimal(38,8)"), 2).cast("double"))
        .otherwise(whole_dau)
        .alias("daily_active_users_avg"),
        F.when(F.col("is_filtered"), mine).alias("total_buyers"),
    )


def daily_signals(daily: DataFrame, peak: DataFrame) -> DataFrame:
    """Per-day means and the peak hour, for sources without a funnel."""
    return daily.agg(
        F.coalesce(avg_ratio("buyers"), F.lit(0.0)).alias("avg_buyers"),
        F.coalesce(avg_ratio("orders"), F.lit(0.0)).alias("avg_orders"),
        F.coalesce(units_ratio(F.sum("revenue_e4"), F.count(F.lit(1))), F.lit(0.0)).alias("avg_revenue"),
        peak.select("hour").scalar().alias("peak_hour"),
        peak.select("orders").scalar().alias("peak_orders"),
    )


def exact_range(
    purchases: DataFrame, start: str | None = None, end: str | None = None, category: str | None = None
) -> DataFrame:
    """Exact revenue, orders and buyers of a range, from the events themselves."""
    chosen = between_days(purchases, start, end)
    if category:
        chosen = chosen.filter(F.col("category") == category)
    sums = chosen.agg(
        F.coalesce(F.sum("revenue_e4"), F.lit(0)).alias("revenue_e4"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("user_id").alias("buyers"),
    )
    return sums.select(
        money("revenue_e4").alias("revenue"),
        "orders",
        "buyers",
        units_ratio("revenue_e4", "orders", default=0).alias("avg_order_value"),
    )


def daily_sketches(purchases: DataFrame) -> DataFrame:
    """Mergeable distinct-count sketches per day."""
    return purchases.groupBy("event_date").agg(
        F.hll_sketch_agg("user_id").alias("buyers_sketch"),
        F.hll_sketch_agg("order_id").alias("orders_sketch"),
    )


def estimated_range(sketches: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Estimated distinct buyers and orders of a range, without touching events."""
    return filter_view(sketches, start, end).agg(
        F.hll_sketch_estimate(F.hll_union_agg("buyers_sketch")).alias("buyers_estimate"),
        F.hll_sketch_estimate(F.hll_union_agg("orders_sketch")).alias("orders_estimate"),
    )


def category_donut(categories_view: DataFrame) -> DataFrame:
    """Percent of revenue per category of a view."""
    cents = F.round(F.col("revenue") * 100, 0).cast("bigint")
    total = categories_view.agg(F.sum(cents)).scalar()
    return categories_view.select("category", "revenue", ratio(cents, total, 100).alias("share_pct"))
