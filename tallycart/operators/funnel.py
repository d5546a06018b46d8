"""Event counts, funnel, capabilities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ratio

STEPS = ("view", "cart", "purchase")
READY = "Funnel computed from view, cart and purchase events."
NOT_READY = "View or cart events are missing; the funnel is not available."


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


def _step(name: str) -> Column:
    return F.coalesce(F.sum(F.when(F.col("event_type") == name, F.col("count"))), F.lit(0)).alias(name)


def step_totals(counts: DataFrame) -> DataFrame:
    """One row: view, cart, purchase."""
    return counts.agg(*[_step(s) for s in STEPS])


def funnel(counts: DataFrame) -> DataFrame:
    """One row from the event counts. Drop-offs may be negative and stay so.

    A rate whose denominator is 0 is 0, so a source with purchases only yields
    zeros beside ``available = false``.
    """
    ready = (F.col("view") > 0) & (F.col("cart") > 0)

    def rate(num: Column, den: str) -> Column:
        return ratio(num, den, 100, default=0)

    view, cart, purchase = (F.col(s) for s in STEPS)
    return step_totals(counts).select(
        ready.alias("available"),
        F.when(ready, READY).otherwise(F.lit(NOT_READY)).alias("message"),
        *STEPS,
        rate(cart, "view").alias("view_to_cart_pct"),
        rate(purchase, "cart").alias("cart_to_purchase_pct"),
        rate(view - cart, "view").alias("drop_off_view_to_cart_pct"),
        rate(cart - purchase, "cart").alias("drop_off_cart_to_purchase_pct"),
    )


def funnel_steps(funnel_row: DataFrame) -> DataFrame:
    """Three rows: step widths as whole percents of the views, purchase at least 1."""

    def width(num: str) -> Column:
        return ratio(num, "view", 100, digits=0, default=0).cast("int")

    rows = F.array(
        F.struct(
            F.lit(1).alias("step_no"),
            F.lit("view").alias("step"),
            F.col("view").alias("value"),
            F.lit(100).alias("width_pct"),
            F.lit(None).cast("double").alias("drop_off_pct"),
        ),
        F.struct(
            F.lit(2).alias("step_no"),
            F.lit("cart").alias("step"),
            F.col("cart").alias("value"),
            width("cart").alias("width_pct"),
            F.col("drop_off_view_to_cart_pct").alias("drop_off_pct"),
        ),
        F.struct(
            F.lit(3).alias("step_no"),
            F.lit("purchase").alias("step"),
            F.col("purchase").alias("value"),
            F.greatest(F.lit(1), width("purchase")).alias("width_pct"),
            F.col("drop_off_cart_to_purchase_pct").alias("drop_off_pct"),
        ),
    )
    return funnel_row.select(F.inline(rows)).orderBy("step_no")


def capabilities(events: DataFrame, promotions: DataFrame | None = None) -> DataFrame:
    """What the events and the promotion table can answer, and the number of sessions, in one pass."""

    def seen(name: str) -> Column:
        return F.coalesce(F.bool_or(F.col("event_type") == name), F.lit(False))

    return events.agg(
        F.count_distinct("order_id").alias("total_sessions"),
        (seen("view") & seen("cart")).alias("funnel_available"),
        seen("view").alias("traffic_events_available"),
        seen("purchase").alias("orders_available"),
    ).withColumn("promotions_available", _any_valid(promotions))


def capabilities_of(counts: DataFrame, sessions: Column, promotions: DataFrame | None = None) -> DataFrame:
    """The same from event counts and a number of sessions."""

    def seen(name: str) -> Column:
        return F.coalesce(F.bool_or((F.col("event_type") == name) & (F.col("count") > 0)), F.lit(False))

    return counts.agg(
        (seen("view") & seen("cart")).alias("funnel_available"),
        seen("view").alias("traffic_events_available"),
        seen("purchase").alias("orders_available"),
    ).select(sessions.alias("total_sessions"), "*", _any_valid(promotions).alias("promotions_available"))


def _any_valid(promotions: DataFrame | None) -> Column:
    """Scalar: whether a promotion covers a day of a category."""
    if promotions is None:
        return F.lit(False)
    valid = (F.col("start_date") <= F.col("end_date")) & (F.size("categories") > 0)
    return promotions.agg(F.coalesce(F.bool_or(valid), F.lit(False))).scalar()
