"""Row filters of the section reads and of the dashboard views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_range(start: str | None, end: str | None) -> tuple[str | None, str | None]:
    """Swap the bounds when they are the wrong way round."""
    if start and end and start > end:
        return end, start
    return start, end


def _month_bounds(
    df: DataFrame, start: str | None, end: str | None, date_col: str, missing_passes_start: bool
) -> DataFrame:
    """Also bound the ``month`` partition of a staged day table, so that it is pruned.

    Rows without a day lie in the partition without a month; it is read where the
    day test lets them pass.
    """
    staged = date_col == "event_date" and "month" in df.columns and dict(df.dtypes)["month"] == "string"
    missing = F.col("month").isNull() if staged else None
    if staged and start:
        after = F.col("month") >= start[:7]
        df = df.filter(missing | after if missing_passes_start else after)
    if staged and end:
        df = df.filter(missing | (F.col("month") <= end[:7]))
    return df


def _text(df: DataFrame, date_col: str) -> Column:
    column = F.col(date_col)
    return column if dict(df.dtypes)[date_col] in ("string", "date") else column.cast("string")


def filter_rows(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    category: str | None = None,
    product_id: int | None = None,
    date_col: str = "event_date",
) -> DataFrame:
    """Section filter, bounds inclusive. A missing date sorts before every
    date: it fails a start bound and passes an end bound. A missing product id
    counts as -1."""
    if start or end:
        df = _month_bounds(df, start, end, date_col, missing_passes_start=False)
    if start:
        df = df.filter(_text(df, date_col) >= start)
    if end:
        df = df.filter(F.col(date_col).isNull() | (_text(df, date_col) <= end))
    if category:
        df = df.filter(F.col("category") == category if "category" in df.columns else F.lit(False))
    if product_id is not None:
        known = F.col("product_id") if "product_id" in df.columns else F.lit(None).cast("bigint")
        df = df.filter(F.coalesce(known, F.lit(-1)) == product_id)
    return df


def filter_view(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    category: str | None = None,
) -> DataFrame:
    """View filter: a row without a date passes the date test and a table
    without a category column passes the category test. The first of
    event_date, date, month that the table has is its date."""
    date_col = next((c for c in ("event_date", "date", "month") if c in df.columns), None)
    if date_col:
        if start or end:
            df = _month_bounds(df, start, end, date_col, missing_passes_start=True)
        missing = F.col(date_col).isNull()
        if start:
            df = df.filter(missing | (_text(df, date_col) >= start))
        if end:
            df = df.filter(missing | (_text(df, date_col) <= end))
    if category and "category" in df.columns:
        df = df.filter(F.col("category") == category)
    return df


def period(daily: DataFrame, days: int | None) -> DataFrame:
    """One row with the trailing period's bounds, clamped to the first day.

    Without ``days`` the whole range.
    """
    whole = daily.agg(F.min("event_date").alias("first"), F.max("event_date").alias("end"))
    start = F.greatest("first", F.date_sub("end", days - 1)) if days else F.col("first")
    return whole.select(start.alias("start"), "end")


def last_days(df: DataFrame, daily: DataFrame, days: int | None) -> DataFrame:
    """Rows of the trailing period that ends on the last day of ``daily``."""
    bounds = period(daily, days)
    return df.filter(
        (F.col("event_date") >= bounds.select("start").scalar())
        & (F.col("event_date") <= bounds.select("end").scalar())
    )
