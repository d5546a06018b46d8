"""One call that answers every tab of the dashboard for a range and a category.

All parts read staged cubes; day tables are bounded by their month folders and
file statistics, so the range decides what is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import customers, funnel, heatmap, range_counts, series, views
from ..operators.filters import filter_rows, filter_view, ordered_range
from . import snapshot
from .document import section


def view(
    cubes: dict[str, DataFrame], start: str | None = None, end: str | None = None, category: str | None = None
) -> dict[str, DataFrame]:
    """The tables of a filtered dashboard by name; nothing runs before one is read.

    Bounds may come in either order. Money, orders and buyers of a category are the additive
    estimates of ``operators.views``, and exact in ``exact`` where bitmaps are staged; customer segments and rates are those of the whole data.
    """
    start, end = ordered_range(start, end)
    daily, by_category = cubes["daily"], cubes["category_daily"]
    rates = funnel.funnel(cubes["event_counts"])
    kpis = views.view_kpis(cubes["totals"], daily, by_category, start, end, category)
    chosen = views.view_categories(by_category, start, end)
    out = {
        "kpis": kpis.withColumn("conversion_rate_pct", rates.select("cart_to_purchase_pct").scalar()),
        "daily": views.view_allocation(daily, by_category, start, end, category),
        "monthly": series.month_totals_additive(filter_view(daily, start, end)),
        "month_delta": series.month_delta(filter_view(daily, start, end)),
        "categories": chosen,
        "donut": views.category_donut(chosen),
        "heatmap": views.view_heatmap_allocated(cubes["heatmap_daily"], by_category, start, end, category),
        "peak_window": heatmap.peak_window(views.reaggregate(filter_view(cubes["heatmap_daily"], start, end), "weekday", "hour")),
        "funnel": views.view_funnel(rates, by_category, start, end, category),
        "products": section(cubes, "products", category=category)["top_by_revenue"],
    }
    if "range_bitmaps" in cubes:
        out["exact"] = range_counts.exact_view(cubes["range_bitmaps"], by_category, start, end, category)
    if "user_days" in cubes:
        days = filter_rows(cubes["user_days"], start, end)
        out["new_vs_returning"] = customers.new_vs_returning_report(days)
    return out


def view_snapshot(
    cubes: dict[str, DataFrame],
    scored: DataFrame,
    start: str | None = None,
    end: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """The snapshot rows of a filtered view; ``scored`` are the stored buyers with their segments."""
    parts = view(cubes, start, end, category)
    return snapshot.dashboard_snapshot(
        parts["kpis"],
        customers.customer_cards(scored),
        parts["month_delta"],
        parts["categories"],
        parts["products"],
        parts["funnel"],
        customers.segment_summary(scored),
        parts["peak_window"],
    )
