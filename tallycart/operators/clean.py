"""Raw click events -> canonical events."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import day_text, month_text, money, to_units

# What missing fields are filled with.
MISSING_CATEGORY = "unknown.general"
MISSING_BRAND = "unknown"
MISSING_SESSION = "unknown_session"
PURCHASE = "purchase"


def clean_events(raw: DataFrame) -> DataFrame:
    """Drop events without time or user, fill gaps, derive columns.

    An order is a session; one event is one unit sold at its price unless the
    source already carries ``quantity`` and ``revenue_e4``. Everything is a
    projection, so Catalyst prunes whatever a metric does not read and pushes
    the NULL tests and any event_type filter into the scan.
    """
    types = dict(raw.dtypes)
    moment: Column = F.col("event_time")
    if types["event_time"] == "string":
        moment = F.try_to_timestamp("event_time")

    def given(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in types else default

    price: Column = F.lit(0).cast("bigint")
    if "price" in types:
        amount = F.when(~F.isnan("price"), F.col("price"))
        price = F.coalesce(to_units(amount), price)
    timed = raw.withColumn("event_time", moment).filter(
        F.col("event_time").isNotNull() & F.col("user_id").isNotNull()
    )
    code = given("category_code", F.lit(MISSING_CATEGORY))
    return timed.select(
        "event_time",
        "event_type",
        (F.col("product_id") if "product_id" in types else F.lit(None).cast("bigint")).alias("product_id"),
        "user_id",
        code.alias("category_code"),
        F.substring_index(code, ".", 1).alias("category"),
        given("brand", F.lit(MISSING_BRAND)).alias("brand"),
        given("quantity", F.lit(1)).cast("bigint").alias("quantity"),
        given("revenue_e4", price).alias("revenue_e4"),
        given("user_session", F.lit(MISSING_SESSION)).alias("order_id"),
        F.to_date("event_time").alias("event_date"),
        F.hour("event_time").alias("hour"),
    )


def purchases_of(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == PURCHASE)


def between_days(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Inclusive day range on the event time itself, so that it reaches the scan."""
    kind = dict(events.dtypes)["event_time"]
    if start:
        events = events.filter(F.col("event_time") >= F.lit(start).cast(kind))
    if end:
        after = (date.fromisoformat(end) + timedelta(days=1)).isoformat()
        events = events.filter(F.col("event_time") < F.lit(after).cast(kind))
    return events


def event_report(events: DataFrame) -> DataFrame:
    """Canonical events with text dates and money as DOUBLE."""
    return events.select(
        F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
        "event_type",
        "product_id",
        "user_id",
        "category_code",
        "category",
        "brand",
        "quantity",
        money("revenue_e4", 4).alias("revenue"),
        "order_id",
        day_text("event_date").alias("event_date"),
        month_text("event_date").alias("month"),
        "hour",
        F.dayofweek("event_date").alias("weekday"),
    )
