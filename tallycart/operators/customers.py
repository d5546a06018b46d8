"""Buyers: value, RFM segments, churn, new against returning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_ratio, day_text, money, ratio, time_text, units_ratio
from ..sources.scratch import materialize
from .ranking import quantile_buckets

# Thresholds of the segment rules.
CHURN_DAYS = 21
AT_RISK_DAYS = 30
VIP_SCORE = 8
LOYAL_SCORE = 6
QUANTILES = 5

TOP_CUSTOMERS = 50
CHURN_LIST = 25
RFM_LIST = 100


def user_cube(purchases: DataFrame) -> DataFrame:
    """Revenue, distinct orders, first and last purchase per buyer.

    A buyer's rows are reduced to (buyer, order) before they meet.
    """
    return purchases.groupBy("user_id").agg(
        F.sum("revenue_e4").alias("revenue_e4"),
        F.count_distinct("order_id").alias("orders"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )


def _lifetime() -> Column:
    gap = F.datediff(F.to_date("last_seen"), F.to_date("first_seen"))
    return (F.greatest(F.lit(0), gap) + 1).cast("int")


def _clv() -> Column:
    return units_ratio("revenue_e4", "orders", default=0)


def user_summary(users: DataFrame) -> DataFrame:
    return users.select(
        "user_id",
        money("revenue_e4").alias("customer_revenue"),
        F.col("orders").alias("purchase_count"),
        time_text("first_seen").alias("first_seen_at"),
        time_text("last_seen").alias("last_seen_at"),
        _lifetime().alias("lifetime_days"),
        _clv().alias("clv_estimate"),
    )


def top_customers(users: DataFrame, n: int = TOP_CUSTOMERS) -> DataFrame:
    return user_summary(users.orderBy(F.col("revenue_e4").desc(), "user_id").limit(n))


def score_users(users: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Recency, quintile scores and segment per buyer, in raw units.

    ``users`` is read several times; pass a materialized table.
    """
    latest = users.agg(F.to_date(F.max("last_seen"))).scalar()
    recent = users.withColumn("recency", F.datediff(latest, F.to_date("last_seen")))
    scored = quantile_buckets(
        recent,
        "user_id",
        {
            "r_score": -F.col("recency"),  # the longest absence ranks first
            "f_score": F.col("orders"),
            "m_score": F.col("revenue_e4"),
        },
        QUANTILES,
        rows_per_task,
    )
    score = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.withColumn("rfm_score", score).withColumn(
        "segment",
        F.when(F.col("rfm_score") >= VIP_SCORE, "VIP")
        .when(F.col("rfm_score") >= LOYAL_SCORE, "Loyal")
        .when(F.col("recency") >= AT_RISK_DAYS, "At Risk")
        .otherwise("Growth Opportunity"),
    )


def scored_from(purchases: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    return score_users(materialize(user_cube(purchases), "users"), rows_per_task)


def rfm_report(scored: DataFrame) -> DataFrame:
    return scored.select(
        "user_id",
        F.col("orders").alias("frequency"),
        money("revenue_e4").alias("monetary"),
        time_text("last_seen").alias("last_purchase"),
        time_text("first_seen").alias("first_seen_at"),
        _lifetime().alias("lifetime_days"),
        _clv().alias("clv_estimate"),
        "recency",
        "r_score",
        "f_score",
        "m_score",
        "rfm_score",
        "segment",
    )


def rfm_top(scored: DataFrame, n: int = RFM_LIST) -> DataFrame:
    return rfm_report(scored.orderBy(F.col("rfm_score").desc(), "user_id").limit(n))


def segment_summary(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            money(F.sum("revenue_e4")).alias("revenue"),
            avg_ratio("recency").alias("avg_recency"),
        )
        .orderBy(F.col("revenue").desc(), "segment")
    )


def churn_risk(scored: DataFrame, n: int = CHURN_LIST) -> DataFrame:
    """Buyers absent for three weeks or more, longest and most valuable first."""
    absent = scored.filter(F.col("recency") >= CHURN_DAYS)
    worst = absent.orderBy(F.col("recency").desc(), F.col("revenue_e4").desc(), "user_id").limit(n)
    return rfm_report(worst).withColumn(
        "severity", F.when(F.col("recency") >= AT_RISK_DAYS, "high").otherwise("medium")
    )


def customer_cards(scored: DataFrame, daily: DataFrame | None = None, churn_list: int = CHURN_LIST) -> DataFrame:
    """One row from one pass over the segments.

    ``churn_list`` is how many the list shows, ``churn_candidates`` how many there are.
    """
    sums = scored.groupBy("segment").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("revenue_e4").alias("revenue_e4"),
        F.count_if(F.col("recency") >= CHURN_DAYS).alias("absent"),
    )

    def of(*segments: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("segment").isin(*segments), F.col("n"))), F.lit(0))

    customers = F.coalesce(F.sum("n"), F.lit(0))
    not_new = F.coalesce(F.sum(F.when(F.col("segment") != "New", F.col("n"))), F.lit(0))
    one = sums.agg(
        of("VIP", "Loyal").alias("vip_loyal"),
        of("At Risk").alias("at_risk"),
        customers.alias("customers"),
        not_new.alias("not_new"),
        F.coalesce(F.sum("absent"), F.lit(0)).alias("churn_candidates"),
        F.max(F.struct("revenue_e4", "segment")).alias("top"),
    )
    unique = F.col("customers").cast("double")
    if daily is not None:
        unique = F.coalesce(F.nullif(unique, F.lit(0.0)), daily.agg(avg_ratio("buyers")).scalar())
    return one.select(
        "vip_loyal",
        "at_risk",
        "customers",
        ratio("vip_loyal", "customers", 100, default=0).alias("vip_loyal_pct"),
        ratio("not_new", "customers", 100, default=0).alias("returning_pct"),
        F.least("churn_candidates", F.lit(churn_list)).alias("churn_list"),
        "churn_candidates",
        ratio("at_risk", "customers", 100, default=0).alias("churn_pct"),
        F.col("top.segment").alias("top_segment"),
        unique.alias("unique_customers"),
    )


def segment_bars(scored: DataFrame) -> DataFrame:
    """Segment sizes as whole percents of the largest; at most four rows."""
    sizes = segment_summary(scored)
    largest = F.greatest(F.max("customers").over(Window.partitionBy()), F.lit(1))
    return sizes.select("segment", "customers", ratio("customers", largest, 100, 0).cast("int").alias("width_pct"))


def customer_mix(users: DataFrame) -> DataFrame:
    """Share of buyers with one order and with two or more."""
    again = F.count_if(F.col("orders") >= 2)
    everyone = F.count(F.lit(1))
    return users.agg(
        ratio(everyone - again, everyone, 100, default=0).alias("new_customers_pct"),
        ratio(again, everyone, 100, default=0).alias("returning_customers_pct"),
    )


def user_day_cube(events: DataFrame) -> DataFrame:
    """Active users and first-time users per day of all events given, or of the visits.

    Events are reduced to (user, day) and to a first day per user; both are counted per day in
    one sum. No window holds a user's days.
    """
    days = events.select("user_id", "event_date").distinct()
    first = events.groupBy("user_id").agg(F.min("event_date").alias("event_date"))
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = days.select("event_date", one.alias("active_users"), none.alias("new")).unionByName(
        first.select("event_date", none.alias("active_users"), one.alias("new"))
    )
    return rows.groupBy("event_date").agg(F.sum("active_users").alias("active_users"), F.sum("new").alias("new"))


def new_vs_returning_report(user_days: DataFrame) -> DataFrame:
    """Days of ``user_day_cube``; a range of them keeps what "new" means in the whole data."""
    return user_days.select(
        day_text("event_date").alias("event_date"),
        "active_users",
        "new",
        (F.col("active_users") - F.col("new")).alias("returning"),
    ).orderBy("event_date")


def new_vs_returning(events: DataFrame) -> DataFrame:
    """Active users per day, split by whether the day is the user's first."""
    return new_vs_returning_report(user_day_cube(events))


def active_users(events: DataFrame) -> DataFrame:
    """Distinct users per day over all event types."""
    return (
        events.groupBy("event_date")
        .agg(F.count_distinct("user_id").alias("active_users"))
        .select(day_text("event_date").alias("event_date"), "active_users")
        .orderBy("event_date")
    )
