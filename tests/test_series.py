from __future__ import annotations

import pytest
from helpers import dicts, one, purchases, sale

from tallycart.operators import categories, funnel, heatmap, kpi, series
from tallycart.operators.customers import user_cube


@pytest.fixture(scope="module")
def gaps(spark):
    """Ten present days with gaps; day 4 has no revenue; one session spans NULLs."""
    days = ["2019-10-01", "2019-10-02", "2019-10-05", "2019-10-09", "2019-10-10", "2019-10-20", "2019-10-21", "2019-10-22", "2019-11-01", "2019-11-03"]
    prices = [10.0, 20.0, 30.0, 0.0, 50.0, 60.0, 70.0, 80.0, 90.0, 100.0]
    return purchases(spark, *[sale(d, i % 3, f"s{i}", p) for i, (d, p) in enumerate(zip(days, prices))])


def test_rolling_counts_rows_not_days(spark, gaps):
    rows = dicts(series.daily_series(series.daily_cube(gaps)))
    revenue = [r["revenue"] for r in rows]
    for i, row in enumerate(rows):
        window = revenue[max(0, i - 6) : i + 1]
        assert row["rolling_7d"] == round(sum(window) / len(window), 2)
    assert rows[0]["prev_revenue"] is None and rows[1]["prev_revenue"] == 10.0


def test_growth_skips_days_after_zero_and_takes_last_seven(spark, gaps):
    daily = series.daily_cube(gaps)
    rows = dicts(series.day_growth(daily))
    assert len(rows) == 8 and "2019-10-10" not in [r["event_date"] for r in rows]
    pcts = [(r["revenue"] - r["prev_revenue"]) / r["prev_revenue"] * 100 for r in rows][-7:]
    assert one(series.revenue_growth(daily))["revenue_growth_pct"] == pytest.approx(sum(pcts) / 7, abs=0.005)


def test_growth_is_zero_without_candidates(spark):
    daily = series.daily_cube(purchases(spark, sale("2019-10-01", 1, "a", 5.0)))
    assert one(series.revenue_growth(daily))["revenue_growth_pct"] == 0.0


def test_monthly_against_previous_present_month(spark):
    p = purchases(
        spark,
        sale("2019-01-05", 1, "a", 0.0),
        sale("2019-03-05", 1, "b", 30.0),
        sale("2019-03-06", 2, "c", 30.0),
        sale("2019-04-06", 2, "d", 15.0),
    )
    jan, mar, apr = dicts(series.monthly_summary(series.monthly_cube(p)))
    assert jan["revenue_pct_vs_prev"] is None and jan["avg_order_value"] == 0.0
    assert mar["revenue_pct_vs_prev"] is None  # previous month earned nothing
    assert mar["orders_pct_vs_prev"] == 100.0 and mar["buyers_pct_vs_prev"] == 100.0
    assert apr["revenue_pct_vs_prev"] == -75.0 and apr["orders_pct_vs_prev"] == -50.0


def test_month_delta(spark, gaps):
    row = one(series.month_delta(series.daily_cube(gaps)))
    assert (row["current_month"], row["previous_month"]) == ("2019-11", "2019-10")
    assert row["revenue_pct"] == -40.63  # -40.625: ties round away from zero
    assert row["revenue_direction"] == "down"
    assert row["aov_pct"] == round((190 / 2 - 320 / 8) / (320 / 8) * 100, 2)


def test_month_delta_needs_two_months(spark):
    assert dicts(series.month_delta(series.daily_cube(purchases(spark, sale("2019-10-01", 1, "a", 5.0))))) == []


def test_null_sessions_are_one_order(spark):
    p = purchases(spark, sale("2019-10-01", 1, None, 5.0), sale("2019-10-01", 2, None, 5.0), sale("2019-10-01", 2, "x", 5.0))
    row = one(series.daily_series(series.daily_cube(p)))
    assert (row["orders"], row["dau"], row["revenue"]) == (2, 2, 15.0)


def test_empty_input(spark):
    p = purchases(spark, sale("2019-10-01", 1, "a", 1.0)).filter("user_id = 99")
    daily = series.daily_cube(p)
    assert dicts(series.daily_series(daily)) == []
    assert dicts(categories.category_share(categories.category_cube(p))) == []
    assert dicts(heatmap.peak_window(heatmap.heatmap_cube(p))) == []
    totals = one(kpi.kpi_totals(funnel.event_counts(p), p, daily, user_cube(p)))
    assert totals["total_revenue"] == 0.0 and totals["average_order_value"] == 0.0 and totals["total_orders"] == 0


def test_funnel_keeps_negative_drop_off(spark):
    counts = spark.createDataFrame([("view", 200), ("cart", 20), ("purchase", 23), ("other", 9)], "event_type string, count bigint")
    row = one(funnel.funnel(counts))
    assert row["cart_to_purchase_pct"] == 115.0 and row["drop_off_cart_to_purchase_pct"] == -15.0
    assert row["available"] and row["view_to_cart_pct"] == 10.0 and row["drop_off_view_to_cart_pct"] == 90.0


def test_funnel_without_traffic(spark):
    row = one(funnel.funnel(spark.createDataFrame([("purchase", 5)], "event_type string, count bigint")))
    assert not row["available"] and row["purchase"] == 5 and row["view"] == 0
    assert {row[k] for k in row if k.endswith("_pct")} == {0.0}


def test_funnel_step_width_has_a_floor(spark):
    counts = spark.createDataFrame([("view", 1000), ("cart", 15), ("purchase", 1)], "event_type string, count bigint")
    steps = dicts(funnel.funnel_steps(funnel.funnel(counts)))
    assert [s["width_pct"] for s in steps] == [100, 2, 1]


def test_category_share_and_growth(spark):
    p = purchases(
        spark,
        sale("2019-01-05", 1, "a", 10.0, category_code="x.1"),
        sale("2019-02-05", 1, "b", 15.0, category_code="x.2"),
        sale("2019-02-05", 2, "c", 75.0, category_code="y.1"),
    )
    share = {r["category"]: r["revenue_share_pct"] for r in dicts(categories.category_share(categories.category_cube(p)))}
    assert share == {"x": 25.0, "y": 75.0}
    growth = {r["category"]: r["growth_pct"] for r in dicts(categories.category_growth(p))}
    assert growth == {"x": 50.0, "y": None}


def test_category_pareto_on_ranges_equals_one_task(spark):
    p = purchases(spark, *[sale("2019-01-05", 1, f"s{i}", float(i % 5 + 1), category_code=f"c{i}") for i in range(40)])
    cube = categories.category_cube(p)
    assert sorted(categories.category_pareto(cube, 6).collect()) == sorted(categories.category_pareto(cube).collect())


def test_peak_breaks_ties_by_revenue(spark):
    p = purchases(
        spark,
        sale("2019-10-07 09:00:00", 1, "a", 10.0),
        sale("2019-10-08 09:00:00", 1, "b", 20.0),
        sale("2019-10-08 08:00:00", 1, "c", 20.0),
    )
    row = one(heatmap.peak_window(heatmap.heatmap_cube(p)))
    assert (row["day_name"], row["hour"]) == ("Tue", 8)
