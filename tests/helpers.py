"""Tiny event frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallycart.operators.clean import clean_events, purchases_of
from tallycart.schema import RAW_EVENT


def raw(spark: SparkSession, *rows: dict) -> DataFrame:
    """Raw events from partial dicts; unnamed fields are NULL."""
    names = RAW_EVENT.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW_EVENT)


def sale(day: str, user: int, session: str | None, price: float | None, **more) -> dict:
    time = day if " " in day else f"{day} 10:00:00 UTC"
    base = dict(event_time=time, event_type="purchase", user_id=user, user_session=session, price=price)
    return base | dict(category_code="a.x", product_id=1) | more


def purchases(spark: SparkSession, *rows: dict) -> DataFrame:
    return purchases_of(clean_events(raw(spark, *rows)))


def dicts(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def one(df: DataFrame) -> dict:
    rows = dicts(df)
    assert len(rows) == 1, rows
    return rows[0]
