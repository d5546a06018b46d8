"""Declared schemas. Declaring them saves the extra scan that inference costs."""

from __future__ import annotations

from pyspark.sql import types as T

# The click-event file. event_time stays text here: it carries a zone suffix
# and unparsable values must become NULL, not fail the read.
RAW_EVENT = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)

PROMOTION = T.StructType(
    [
        T.StructField("promotion_id", T.StringType()),
        T.StructField("discount_pct", T.DoubleType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("categories", T.ArrayType(T.StringType())),
    ]
)

_DAY = T.StructField("event_date", T.DateType())
_REVENUE = T.StructField("revenue_e4", T.LongType())
_ORDERS = T.StructField("orders", T.LongType())
_BUYERS = T.StructField("buyers", T.LongType())
_CATEGORY = T.StructField("category", T.StringType())
_WEEKDAY = T.StructField("weekday", T.IntegerType())
_HOUR = T.StructField("hour", T.IntegerType())

# Aggregate tables as staged on disk, by name. The user and product tables keep
# the source's own timestamp type and are read with their stored schema.
CUBES = {
    "daily": T.StructType([_DAY, _REVENUE, _ORDERS, _BUYERS]),
    "monthly": T.StructType([T.StructField("month", T.DateType()), _REVENUE, _ORDERS, _BUYERS]),
    "categories": T.StructType([_CATEGORY, _REVENUE, _ORDERS, _BUYERS]),
    "category_daily": T.StructType(
        [_DAY, _CATEGORY, _REVENUE, _ORDERS, _BUYERS, T.StructField("month", T.StringType())]
    ),
    "heatmap": T.StructType([_WEEKDAY, _HOUR, _REVENUE, _ORDERS]),
    "heatmap_daily": T.StructType([_DAY, _WEEKDAY, _HOUR, _REVENUE, _ORDERS]),
    "user_days": T.StructType([_DAY, T.StructField("active_users", T.LongType()), T.StructField("new", T.LongType())]),
    "event_counts": T.StructType(
        [T.StructField("event_type", T.StringType()), T.StructField("count", T.LongType())]
    ),
}
