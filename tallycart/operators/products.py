"""Products: leaderboards, Pareto, ABC classes, labels.

The product table has no size bound, so totals are scalars and the running
share uses the range-partitioned order of ``ranking``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import money, product_label, ratio, units_ratio
from ..sources.scratch import materialize
from .categories import abc_class, total_units
from .ranking import with_running

TOP_PRODUCTS = 10
FILTER_PRODUCTS = 50
PARETO_PCT = 80


def product_parts(purchases: DataFrame) -> DataFrame:
    """Sums and latest time per (product, category).

    A hash aggregate keeps these in fixed-size buffers without sorting. Parts of several
    tables add up with ``merged_parts``.
    """
    return purchases.groupBy("product_id", "category_code").agg(
        F.sum("revenue_e4").alias("revenue_e4"),
        F.sum("quantity").alias("quantity"),
        F.max("event_time").alias("latest"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("product_id", "category_code").agg(
        F.sum("revenue_e4").alias("revenue_e4"), F.sum("quantity").alias("quantity"), F.max("latest").alias("latest")
    )


def products_of(parts: DataFrame) -> DataFrame:
    """Revenue and units per product, with the category of its latest purchase.

    Only the few parts of a product are compared as (time, category).
    """
    rows = parts.groupBy("product_id").agg(
        F.sum("revenue_e4").alias("revenue_e4"),
        F.sum("quantity").alias("quantity"),
        F.array_max(F.collect_list(F.struct("latest", "category_code"))).alias("latest"),
    )
    return rows.select(
        "product_id",
        F.substring_index("latest.category_code", ".", 1).alias("category"),
        F.col("latest.category_code").alias("category_code"),
        "revenue_e4",
        "quantity",
    )


def product_cube(purchases: DataFrame) -> DataFrame:
    return products_of(product_parts(purchases))


def products_from(purchases: DataFrame) -> DataFrame:
    return materialize(product_cube(purchases), "products")


def _by_revenue():
    return [F.col("revenue_e4").desc(), F.col("product_id").asc_nulls_last()]


def _figures(products: DataFrame) -> list:
    return [
        F.col("product_id"),
        F.col("category"),
        F.col("category_code"),
        money("revenue_e4").alias("revenue"),
        F.col("quantity"),
        units_ratio("revenue_e4", "quantity", default=0).alias("avg_price"),
    ]


def top_by_revenue(products: DataFrame, n: int = TOP_PRODUCTS, whole: DataFrame | None = None) -> DataFrame:
    """Best sellers with share and cumulative share; the window spans ``n`` rows.

    Shares are of ``whole``, where ``products`` is a choice of it.
    """
    total = total_units(products if whole is None else whole)
    top = products.orderBy(*_by_revenue()).limit(n)
    w = Window.orderBy(*_by_revenue()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return top.withColumn("running", F.sum("revenue_e4").over(w)).select(
        *_figures(top),
        ratio("revenue_e4", total, 100).alias("revenue_share_pct"),
        ratio("running", total, 100).alias("cumulative_share_pct"),
    )


def top_by_quantity(products: DataFrame, n: int = TOP_PRODUCTS, whole: DataFrame | None = None) -> DataFrame:
    top = products.orderBy(F.col("quantity").desc(), F.col("product_id").asc_nulls_last()).limit(n)
    return top.select(*_figures(top))


def product_abc(products: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Every product with its shares and class."""
    total = total_units(products)
    ordered = with_running(products, _by_revenue(), "revenue_e4", rows_per_task)
    return ordered.select(
        *_figures(ordered),
        ratio("revenue_e4", total, 100).alias("revenue_share_pct"),
        ratio("running", total, 100).alias("cumulative_share_pct"),
    ).withColumn("abc_class", abc_class("cumulative_share_pct"))


def pareto_summary(products: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """How many products it takes to first reach 80 % of revenue."""
    wide = "decimal(28,0)"
    before = (F.col("running") - F.col("revenue_e4")).cast(wide) * 100
    needed = before < F.coalesce(total_units(products), F.lit(0)).cast(wide) * PARETO_PCT
    n = F.count(F.lit(1))
    return with_running(products, _by_revenue(), "revenue_e4", rows_per_task).agg(
        F.count_if(needed).alias("top_products_for_80pct"),
        n.alias("product_count"),
        F.expr("(count(1) + 4) div 5").alias("top_20pct_product_count"),
    )


def pareto_products(products: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """The products counted by ``pareto_summary``, with their shares of all revenue, best first."""
    wide, total = "decimal(28,0)", total_units(products)
    ordered = with_running(products, _by_revenue(), "revenue_e4", rows_per_task)
    before = (F.col("running") - F.col("revenue_e4")).cast(wide) * 100
    return ordered.filter(before < F.coalesce(total, F.lit(0)).cast(wide) * PARETO_PCT).select(
        *_figures(ordered),
        ratio("revenue_e4", total, 100).alias("revenue_share_pct"),
        ratio("running", total, 100).alias("cumulative_share_pct"),
    )


def product_filter_list(products: DataFrame, names: DataFrame | None = None, n: int = FILTER_PRODUCTS) -> DataFrame:
    """Products to choose from: the best sellers with a label."""
    top = products.orderBy(*_by_revenue()).limit(n).select("product_id", "category")
    if names is None:
        top = top.withColumn("product_name", F.lit(None).cast("string"))
    else:
        wanted = F.broadcast(top.select("product_id"))  # at most n rows
        found = names.join(wanted, "product_id").groupBy("product_id").agg(F.min("product_name").alias("product_name"))
        top = top.join(F.broadcast(found), "product_id", "left")  # again at most n rows
    return top.select("product_id", product_label("product_name", "product_id").alias("product_name"), "category")


def product_bars(products: DataFrame, n: int = 7) -> DataFrame:
    """Bar widths of the best sellers as whole percents of the first."""
    top = products.orderBy(*_by_revenue()).limit(n)
    best = F.greatest(F.max("revenue_e4").over(Window.partitionBy()), F.lit(10_000))  # n rows
    return top.select(
        product_label(F.lit(None).cast("string"), "product_id").alias("label"),
        money("revenue_e4").alias("revenue"),
        ratio("revenue_e4", best, 100, 0).cast("int").alias("width_pct"),
    )
