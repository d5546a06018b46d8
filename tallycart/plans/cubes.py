"""The aggregate tables, built from two passes over the events.

One pass reduces all events to visits. The other writes the purchases as a narrow table
to the shared scratch folder, from which the order and the buyer grain are made. Every cube is a
roll-up of one of these stored tables (``operators.grain``). The purchases are rebalanced by order: they are few among events,
so writing them as they are scanned would leave one tiny file per input split, and rows of one
order lying together shrink before the next shuffle. Rebalancing splits a hot order over
several tasks.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import month_text
from ..operators import customers, funnel, grain, kpi, products, promotions, range_counts
from ..operators.clean import purchases_of
from ..schema import CUBES
from ..sources.files import read_or_empty
from ..sources.scratch import materialize

# Day tables are stored in day order, so file statistics prune a date range.
# Only tables per day and category can grow enough to be worth month folders.
DAY_TABLES = ("daily", "heatmap_daily")
MONTH_TABLES = ("category_daily", "range_bitmaps")


def stored_purchases(purchases: DataFrame) -> DataFrame:
    """The purchases written once, narrow and in well-sized files."""
    narrow = purchases.select(
        "event_time",
        "event_date",
        "hour",
        "user_id",
        "order_id",
        "product_id",
        "category_code",
        "category",
        "quantity",
        "revenue_e4",
    )
    return materialize(narrow.hint("rebalance", "order_id"), "purchases")


# What a promotion's share is given by: name of the table and the column over purchases.
PROMOTION_GRAINS = {
    "promotion_by_month": lambda: month_text("event_date"),
    "promotion_by_weekday": lambda: F.dayofweek("event_date"),
    "promotion_by_hour": lambda: F.col("hour"),
    "promotion_by_category": lambda: F.col("category"),
}


def promotion_cubes(purchases: DataFrame, promoted: DataFrame) -> dict[str, DataFrame]:
    """Performance, mean discount and shares per grain, by name."""
    shares = {
        name: promotions.promotion_share(purchases, promoted, grain().alias("grain"))
        for name, grain in PROMOTION_GRAINS.items()
    }
    return shares | {
        "promotion_performance": promotions.promotion_performance(purchases, promoted),
        "promotion_discount": promotions.promotion_discount(purchases, promoted),
    }


def build_cubes(
    events: DataFrame,
    promoted: DataFrame | None = None,
    product_names: DataFrame | None = None,
    exact_ranges: bool = False,
) -> dict[str, DataFrame]:
    """All cubes of canonical events, by name; with a promotion table also those of promotions.

    ``exact_ranges`` adds the bitmaps from which distinct buyers and orders of any range are counted.
    """
    with ThreadPoolExecutor(3) as pool:
        submit = inheritable_thread_target(events.sparkSession)
        seen = pool.submit(submit(grain.stored_visits), events)
        bought = stored_purchases(purchases_of(events))
        both = [pool.submit(submit(stored), bought) for stored in (grain.stored_orders, grain.stored_buyers)]
        visits, orders, buyers = seen.result(), *[b.result() for b in both]
    more = {} if promoted is None else promotion_cubes(bought, promoted)
    if product_names is not None:
        more["product_names"] = product_names
    if exact_ranges:
        more["range_bitmaps"] = range_counts.range_bitmaps(orders, buyers)
    day, hour, category = "event_date", "hour", "category"
    return more | {
        "user_days": customers.user_day_cube(visits),
        "event_counts": visits.groupBy("event_type").agg(F.sum("count").alias("count")),
        "capabilities": funnel.capabilities(visits, promoted),
        "totals": kpi.purchase_totals(orders),
        "daily": grain.figures(orders, buyers, day),
        "monthly": grain.figures(orders, buyers, F.trunc(day, "MM").alias("month")),
        "users": customers.user_cube(bought),
        "categories": grain.figures(orders, buyers, category),
        "category_daily": grain.figures(orders, buyers, day, category),
        "heatmap": grain.order_figures(orders, F.dayofweek(day).alias("weekday"), hour),
        "heatmap_daily": grain.order_figures(orders, day, hour).select(
            day, F.dayofweek(day).alias("weekday"), hour, "revenue_e4", "orders"
        ),
        "products": products.product_cube(bought),
    }


def _tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_cubes(cubes: dict[str, DataFrame], folder: str, at_once: int = 8) -> None:
    """One Parquet table per cube under ``folder``.

    Cubes are small, so a few are written at the same time.
    """

    def write(name: str) -> None:
        cube, path = cubes[name], f"{folder}/{name}"
        if name in MONTH_TABLES:
            # one file a month, which holds at most a row per day and category; months are written side by side
            by_month = cube.withColumn("month", month_text("event_date")).repartition(_tasks(cube.sparkSession), "month")
            by_month.sortWithinPartitions("month", "event_date").write.mode("overwrite").partitionBy("month").parquet(path)
        elif name in DAY_TABLES:
            # one row per calendar day, or per hour of one: a single sorted file
            cube.repartition(1).sortWithinPartitions("event_date").write.mode("overwrite").parquet(path)
        else:
            cube.write.mode("overwrite").parquet(path)

    spark = next(iter(cubes.values())).sparkSession
    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), cubes))


def read_cubes(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The staged cubes; a missing table reads as empty where its schema is declared."""
    tables = {name: read_or_empty(spark, f"{folder}/{name}", schema) for name, schema in CUBES.items()}
    for name in ("totals", "capabilities", "products", "users"):
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    for name in ("product_names", "range_bitmaps", "promotion_performance", "promotion_discount", *PROMOTION_GRAINS):
        try:
            tables[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as missing:  # staged only where they were given
            if "PATH_NOT_FOUND" not in str(missing):
                raise
    return tables
