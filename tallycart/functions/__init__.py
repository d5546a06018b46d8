"""Column helpers: money, ratios, calendar labels and text."""

from .calendar import day_code, day_text, month_text, time_text, weekday_name
from .numbers import avg_ratio, money, ratio, to_units, units_ratio
from .text import direction, product_label, title_case

__all__ = [
    "avg_ratio",
    "day_code",
    "day_text",
    "direction",
    "money",
    "month_text",
    "product_label",
    "ratio",
    "time_text",
    "title_case",
    "to_units",
    "units_ratio",
    "weekday_name",
]
