"""Calendar labels. Plans keep DATE keys; text appears only in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark's dayofweek numbering, 1 = Sunday .. 7 = Saturday.
DAY_NAMES = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")


def day_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def time_text(moment: Column | str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def day_code(weekday: Column | str) -> Column:
    """1..7 -> Sun..Sat."""
    index = F.col(weekday) if isinstance(weekday, str) else weekday
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), index.cast("int"))


def weekday_name(day: Column | str) -> Column:
    """DATE -> Monday .. Sunday."""
    return F.date_format(day, "EEEE")
