from __future__ import annotations

import random

import pytest
from helpers import dicts, one, purchases, sale

from tallycart.operators import categories, filters, heatmap, kpi, series, views


@pytest.fixture(scope="module")
def shop(spark):
    rnd = random.Random(2)
    rows = [
        sale(f"2019-1{rnd.randint(0, 1)}-{rnd.randint(1, 28):02d} {rnd.randint(0, 23):02d}:00:00", rnd.randint(1, 20), f"s{rnd.randint(1, 90)}", float(rnd.randint(1, 50)), category_code=f"{rnd.choice('abc')}.x")
        for _ in range(300)
    ]
    return purchases(spark, *rows)


def text_dates(spark):
    return spark.createDataFrame(
        [("2019-10-01", "a", 1), ("2019-10-05", "b", None), (None, "a", 3)], "event_date string, category string, product_id bigint"
    )


def test_section_filter(spark):
    df = text_dates(spark)
    count = lambda **f: filters.filter_rows(df, **f).count()
    assert count() == 3
    assert count(start="2019-10-01") == 2  # a missing date fails a start bound
    assert count(end="2019-10-01") == 2  # and passes an end bound
    assert count(category="a") == 2 and count(product_id=3) == 1 and count(product_id=-1) == 1
    assert filters.filter_rows(df.drop("category"), category="a").count() == 0


def test_view_filter(spark):
    df = text_dates(spark)
    assert filters.filter_view(df, "2019-10-02", "2019-10-31").count() == 2  # a missing date passes
    assert filters.filter_view(df.drop("category"), category="a").count() == 3
    months = spark.createDataFrame([("2019-10",), ("2019-12",)], "month string")
    assert filters.filter_view(months, "2019-11", None).count() == 1


def test_bounds_swap():
    assert filters.ordered_range("2020-02-01", "2020-01-01") == ("2020-01-01", "2020-02-01")
    assert filters.ordered_range(None, "2020-01-01") == (None, "2020-01-01")


def test_period_is_clamped(shop):
    daily = series.daily_cube(shop)
    whole = one(series.date_range(daily))
    assert str(one(filters.period(daily, 10_000))["start"]) == whole["start"]
    assert str(one(filters.period(daily, None))["start"]) == whole["start"]
    assert filters.last_days(daily, daily, 1).count() == 1


def test_heatmap_adds_up_from_days(shop):
    whole = {(r["weekday"], r["hour"]): r["revenue"] for r in dicts(heatmap.heatmap(heatmap.heatmap_cube(shop)))}
    summed = {(r["weekday"], r["hour"]): r["revenue"] for r in dicts(views.view_heatmap(heatmap.heatmap_daily_cube(shop), None, None))}
    assert whole == summed


def test_allocation_over_all_categories_is_the_total(shop):
    daily, cd = series.daily_cube(shop), categories.category_daily_cube(shop)
    total = sum(r["revenue"] for c in "abc" for r in dicts(views.view_allocation(daily, cd, "2019-10-05", "2019-11-20", c)))
    plain = sum(r["revenue"] for r in dicts(views.view_allocation(daily, cd, "2019-10-05", "2019-11-20", None)))
    assert total == pytest.approx(plain, abs=0.5)


def test_unknown_category_changes_nothing(shop):
    daily, cd = series.daily_cube(shop), categories.category_daily_cube(shop)
    totals = kpi.purchase_totals(shop)
    plain = one(views.view_kpis(totals, daily, cd))
    assert not plain["is_filtered"] and plain["total_buyers"] is None
    assert one(views.view_kpis(totals, daily, cd, category="nope")) == plain
    whole = one(series.date_range(daily))
    assert one(views.view_kpis(totals, daily, cd, whole["start"], whole["end"])) == plain


def test_filtered_kpis(shop):
    daily, cd = series.daily_cube(shop), categories.category_daily_cube(shop)
    got = one(views.view_kpis(kpi.purchase_totals(shop), daily, cd, "2019-11-20", "2019-10-05", "a"))
    days = [r for r in dicts(daily) if "2019-10-05" <= str(r["event_date"]) <= "2019-11-20"]
    cats = [r for r in dicts(cd) if "2019-10-05" <= str(r["event_date"]) <= "2019-11-20"]
    share = sum(r["revenue_e4"] for r in cats if r["category"] == "a") / sum(r["revenue_e4"] for r in cats)
    assert got["is_filtered"]
    assert got["total_revenue"] == pytest.approx(sum(r["revenue_e4"] for r in days) / 1e4 * share, abs=0.0051)
    assert got["total_orders"] == int(sum(r["orders"] for r in days) * share + 0.5)
    assert got["total_buyers"] == sum(r["buyers"] for r in cats if r["category"] == "a")


def test_exact_range_does_not_add_days(shop):
    exact = one(views.exact_range(shop, "2019-10-05", "2019-11-20"))
    rows = [r for r in dicts(shop) if "2019-10-05" <= str(r["event_date"]) <= "2019-11-20"]
    assert exact["buyers"] == len({r["user_id"] for r in rows}) and exact["orders"] == len({r["order_id"] for r in rows})
    estimate = one(views.estimated_range(views.daily_sketches(shop), "2019-10-05", "2019-11-20"))
    assert estimate["buyers_estimate"] == pytest.approx(exact["buyers"], rel=0.1)
    assert estimate["orders_estimate"] == pytest.approx(exact["orders"], rel=0.1)


def test_signals(shop):
    row = one(views.daily_signals(series.daily_cube(shop), heatmap.peak_window(heatmap.heatmap_cube(shop))))
    assert row["peak_hour"] is not None and row["avg_orders"] > 0
    none = shop.filter("user_id < 0")
    row = one(views.daily_signals(series.daily_cube(none), heatmap.peak_window(heatmap.heatmap_cube(none))))
    assert row["peak_hour"] is None and row["avg_revenue"] == 0.0
