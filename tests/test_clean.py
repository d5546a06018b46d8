from __future__ import annotations

from helpers import dicts, one, purchases, raw, sale
from pyspark.sql import functions as F

from tallycart.functions import direction, money, product_label, ratio, title_case, to_units
from tallycart.operators.clean import between_days, clean_events, event_report


def test_missing_fields_are_filled(spark):
    row = one(event_report(clean_events(raw(spark, dict(event_time="2019-10-05 23:59:59 UTC", event_type="view", user_id=7)))))
    assert row["category_code"] == "unknown.general" and row["category"] == "unknown"
    assert row["brand"] == "unknown" and row["revenue"] == 0.0 and row["order_id"] == "unknown_session"
    assert row["quantity"] == 1 and row["event_date"] == "2019-10-05" and row["month"] == "2019-10"
    assert row["hour"] == 23 and row["weekday"] == 7  # a Saturday


def test_events_without_time_or_user_are_dropped(spark):
    events = clean_events(
        raw(
            spark,
            dict(event_time="not a time", event_type="view", user_id=1),
            dict(event_time=None, event_type="view", user_id=1),
            dict(event_time="2019-10-01 00:00:00 UTC", event_type="view", user_id=None),
            dict(event_time="2019-10-01 00:00:00 UTC", event_type="view", user_id=3),
        )
    )
    assert [r["user_id"] for r in dicts(events)] == [3]


def test_category_is_text_before_first_dot(spark):
    rows = [dict(event_time="2019-10-01 00:00:00", event_type="view", user_id=i, category_code=c) for i, c in enumerate(["a.b.c", "plain", ".x"])]
    assert [r["category"] for r in dicts(clean_events(raw(spark, *rows)).orderBy("user_id"))] == ["a", "plain", ""]


def test_nan_price_counts_as_zero(spark):
    assert one(purchases(spark, sale("2019-10-01", 1, "s", float("nan"))))["revenue_e4"] == 0


def test_between_days_is_inclusive(spark):
    p = purchases(
        spark,
        sale("2019-10-01 00:00:00", 1, "a", 1.0),
        sale("2019-10-02 23:59:59", 2, "b", 1.0),
        sale("2019-10-03 00:00:00", 3, "c", 1.0),
    )
    assert {r["user_id"] for r in dicts(between_days(p, "2019-10-01", "2019-10-02"))} == {1, 2}
    assert {r["user_id"] for r in dicts(between_days(p, "2019-10-02", None))} == {2, 3}


def test_columns(spark):
    df = spark.range(1)
    values = df.select(
        to_units(F.lit(0.29)).alias("u"),
        money(F.lit(1250).cast("bigint")).alias("m"),
        ratio(F.lit(1), F.lit(0)).alias("none"),
        ratio(F.lit(1), F.lit(0), default=0).alias("zero"),
        ratio(F.lit(201), F.lit(40)).alias("tie"),  # 5.025 rounds up
        ratio(F.lit(-201), F.lit(40)).alias("negative_tie"),
        title_case(F.lit("home_living iPHONE  x")).alias("t"),
        title_case(F.lit(None).cast("string")).alias("t0"),
        product_label(F.lit("n"), F.lit(5)).alias("p1"),
        product_label(F.lit(""), F.lit(5)).alias("p2"),
        product_label(F.lit(None).cast("string"), F.lit(0)).alias("p3"),
        direction(F.lit(0.0)).alias("d0"),
        direction(F.lit(-0.1)).alias("d1"),
        direction(F.lit(None).cast("double")).alias("d2"),
    )
    assert one(values) == dict(
        u=2900, m=0.13, none=None, zero=0.0, tie=5.03, negative_tie=-5.03, t="Home Living IPHONE X", t0="",
        p1="n", p2="SKU 5", p3="Unknown product", d0="up", d1="down", d2=None,
    )
