"""Adapters that present given tables as raw click events.

``clicks`` maps an event log, ``sales`` an order/line-item schema. They only
rename and project; cleaning is the same for every source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean_events, purchases_of


def clicks(spark: SparkSession, folder: str, types: Sequence[str] = ()) -> DataFrame:
    """Raw events from the ``events`` table; ``click`` is this shop's ``cart``.

    ``types`` restricts event types on the stored column, where the Parquet
    reader can use it; a filter on the renamed column could not be pushed.
    """
    log = spark.read.parquet(f"{folder}/events.parquet")
    if types:
        stored = ["click" if t == "cart" else t for t in types]
        log = log.filter(F.col("event_type").isin(stored))
    product = F.regexp_extract("props", "[0-9]+", 0).cast("bigint")
    return log.select(
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        product.alias("product_id"),
        F.when(
            product % 7 != 6,
            F.concat(F.lit("cat"), (product % 7).cast("string"), F.lit(".p"), product.cast("string")),
        ).alias("category_code"),
        F.col("value").alias("price"),
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("user_session"),
    )


def sales(spark: SparkSession, folder: str, with_part: bool = True) -> DataFrame:
    """Raw purchase events from line items and their orders.

    No join hints: the sizes decide, and a hot order or part is split by the
    adaptive skew join. The part table is a left join that a metric without
    category or brand leaves out, because part keys are unique.
    """
    money_cents = F.floor(F.col("l_extendedprice") * 100 + F.lit(0.5))
    keep_percent = F.floor((F.lit(1.0) - F.col("l_discount")) * 100 + F.lit(0.5))
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (money_cents * keep_percent).alias("revenue_e4"),
    )
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    code, brand = F.lit(None).cast("string"), F.lit(None).cast("string")
    if with_part:
        # the code is spelled out per part, before the join, not per line
        parts = spark.read.parquet(f"{folder}/part.parquet").select(
            "p_partkey", "p_brand", F.concat(F.lower("p_type"), F.lit("."), F.col("p_brand")).alias("code")
        )
        joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        code, brand = F.col("code"), F.col("p_brand")
    return joined.select(
        F.col("o_orderdate").alias("event_time"),
        F.lit("purchase").alias("event_type"),
        F.col("l_partkey").alias("product_id"),
        code.alias("category_code"),
        brand.alias("brand"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_orderkey").cast("string").alias("user_session"),
        "quantity",
        "revenue_e4",
    )


def click_events(spark: SparkSession, folder: str) -> DataFrame:
    return clean_events(clicks(spark, folder))


def click_purchases(spark: SparkSession, folder: str) -> DataFrame:
    return purchases_of(clean_events(clicks(spark, folder, ["purchase"])))


def sale_purchases(spark: SparkSession, folder: str, with_part: bool = True) -> DataFrame:
    return purchases_of(clean_events(sales(spark, folder, with_part)))


def product_names(spark: SparkSession, folder: str) -> DataFrame:
    """Product names by id."""
    return spark.read.parquet(f"{folder}/part.parquet").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
