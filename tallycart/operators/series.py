"""Day and month series.

Windows over a whole day or month table are one task by design: such a table
has at most one row per calendar day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_ratio, day_text, direction, money, month_text, ratio, units_ratio, weekday_name
from ..functions.numbers import exact_ratio

ROLLING_ROWS = 7


def totals_by(purchases: DataFrame, *keys: Column | str) -> DataFrame:
    """Revenue, distinct orders and distinct buyers per key.

    The two distinct counts shuffle on (key, order) and (key, buyer) after a
    map-side reduction, so a hot key is spread over all tasks.
    """
    return purchases.groupBy(*keys).agg(
        F.sum("revenue_e4").alias("revenue_e4"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("user_id").alias("buyers"),
    )


def daily_cube(purchases: DataFrame) -> DataFrame:
    return totals_by(purchases, "event_date")


def monthly_cube(purchases: DataFrame) -> DataFrame:
    return totals_by(purchases, F.trunc("event_date", "MM").alias("month"))


def _trailing() -> Window:
    return Window.orderBy("event_date").rowsBetween(1 - ROLLING_ROWS, Window.currentRow)


def daily_series(daily: DataFrame) -> DataFrame:
    """Rolling mean over the last seven present days and the previous day's revenue."""
    last = _trailing()
    mean = units_ratio(F.sum("revenue_e4").over(last), F.count(F.lit(1)).over(last))
    prev = F.lag("revenue_e4").over(Window.orderBy("event_date"))
    return daily.select(
        day_text("event_date").alias("event_date"),
        money("revenue_e4").alias("revenue"),
        "orders",
        F.col("buyers").alias("dau"),
        mean.alias("rolling_7d"),
        money(prev).alias("prev_revenue"),
    ).orderBy("event_date")


def daily_chart(daily: DataFrame) -> DataFrame:
    """Whole-number moving average and each day's share of the best day."""
    last = _trailing()
    best = daily.agg(F.greatest(F.max("revenue_e4"), F.lit(10_000)).alias("best"))
    return daily.select(
        day_text("event_date").alias("event_date"),
        money("revenue_e4").alias("revenue"),
        units_ratio(F.sum("revenue_e4").over(last), F.count(F.lit(1)).over(last), 0).cast("bigint").alias("ma7"),
        ratio("revenue_e4", best.scalar(), 1, 4).alias("bar_ratio"),
    ).orderBy("event_date")


def _growth_rows(daily: DataFrame) -> DataFrame:
    w = Window.orderBy("event_date")
    return daily.withColumn("prev_e4", F.lag("revenue_e4").over(w)).filter(F.col("prev_e4") > 0)


def day_growth(daily: DataFrame) -> DataFrame:
    """Change against the previous present day, where that day had revenue."""
    return (
        _growth_rows(daily)
        .select(
            day_text("event_date").alias("event_date"),
            money("revenue_e4").alias("revenue"),
            money("prev_e4").alias("prev_revenue"),
            ratio(F.col("revenue_e4") - F.col("prev_e4"), "prev_e4", 100).alias("growth_pct"),
        )
        .orderBy("event_date")
    )


def revenue_growth(daily: DataFrame) -> DataFrame:
    """Mean of the last seven day-over-day changes; 0 when there are none."""
    last = _growth_rows(daily).orderBy(F.col("event_date").desc()).limit(ROLLING_ROWS)
    change = exact_ratio(F.col("revenue_e4") - F.col("prev_e4"), "prev_e4", 100)
    mean = F.round(F.avg(change), 2).cast("double")
    return last.agg(F.coalesce(mean, F.lit(0.0)).alias("revenue_growth_pct"))


def monthly_summary(monthly: DataFrame) -> DataFrame:
    """Average order value and change against the previous present month."""
    w = Window.orderBy("month")

    def change(name: str) -> Column:
        prev = F.lag(name).over(w)
        return ratio(F.col(name) - prev, prev, 100)

    return monthly.select(
        month_text("month").alias("month"),
        money("revenue_e4").alias("revenue"),
        "orders",
        "buyers",
        units_ratio("revenue_e4", "orders", default=0).alias("avg_order_value"),
        change("revenue_e4").alias("revenue_pct_vs_prev"),
        change("orders").alias("orders_pct_vs_prev"),
        change("buyers").alias("buyers_pct_vs_prev"),
    ).orderBy("month")


def _additive_months(daily: DataFrame) -> DataFrame:
    return daily.groupBy(F.trunc("event_date", "MM").alias("month")).agg(
        F.sum("revenue_e4").alias("revenue_e4"),
        F.sum("orders").alias("orders"),
        F.sum("buyers").alias("buyers"),
        F.count(F.lit(1)).alias("days"),
    )


def month_totals_additive(daily: DataFrame) -> DataFrame:
    """Month totals added up from days: buyers seen on several days count again."""
    return (
        _additive_months(daily)
        .select(month_text("month").alias("month"), money("revenue_e4").alias("revenue"), "orders", "buyers", "days")
        .orderBy("month")
    )


def month_delta(daily: DataFrame) -> DataFrame:
    """Last month against the one before, from days; no row below two months."""
    w = Window.orderBy(F.col("month").desc())
    last_two = _additive_months(daily).withColumn("n", F.row_number().over(w)).filter("n <= 2")
    names = ("month", "revenue_e4", "orders", "buyers")
    pair = last_two.agg(
        *[F.max(F.when(F.col("n") == i, F.col(c))).alias(f"{c}_{i}") for i in (1, 2) for c in names]
    ).filter("month_2 IS NOT NULL")

    def change(name: str) -> Column:
        return ratio(F.col(f"{name}_1") - F.col(f"{name}_2"), f"{name}_2", 100)

    # (r1/o1 - r2/o2) / (r2/o2) = (r1*o2 - r2*o1) / (r2*o1), one division
    wide = "decimal(38,0)"
    r1, r2, o1, o2 = (F.col(c).cast("decimal(19,0)") for c in ("revenue_e4_1", "revenue_e4_2", "orders_1", "orders_2"))
    aov = F.when(
        o1 > 0,
        F.try_divide(((r1 * o2).cast(wide) - (r2 * o1).cast(wide)).cast("double") * 100, (r2 * o1).cast("double")),
    ).when(F.col("revenue_e4_2") > 0, F.lit(-100.0))
    out = pair.select(
        month_text("month_1").alias("current_month"),
        month_text("month_2").alias("previous_month"),
        change("revenue_e4").alias("revenue_pct"),
        change("orders").alias("orders_pct"),
        change("buyers").alias("buyers_pct"),
        F.round(aov.cast("decimal(38,8)"), 2).cast("double").alias("aov_pct"),
    )
    return out.withColumn("revenue_direction", direction("revenue_pct"))


def seasonality(daily: DataFrame) -> DataFrame:
    """Mean daily revenue and orders per day of the week."""
    return (
        daily.groupBy(weekday_name("event_date").alias("day_of_week"))
        .agg(
            units_ratio(F.sum("revenue_e4"), F.count(F.lit(1))).alias("avg_revenue"),
            avg_ratio("orders").alias("avg_orders"),
        )
        .orderBy("day_of_week")
    )


def date_range(daily: DataFrame) -> DataFrame:
    return daily.agg(day_text(F.min("event_date")).alias("start"), day_text(F.max("event_date")).alias("end"))
