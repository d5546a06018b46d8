"""Money and ratio columns.

Money travels through the plans as BIGINT units of 1/10000 (column suffix
``_e4``). Sums of longs are exact, order independent, stay inside whole-stage
code generation and shuffle as eight bytes; sums of wide decimals do none of
the last two. Under ANSI mode (the default) one sum beyond 9.2e14 currency
raises instead of wrapping.

Ratios are decimal divisions of integers, so a value that lies exactly on a
rounding tie rounds the same way on every run and every partitioning.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 10_000
_WIDE = "decimal(20,0)"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_units(amount: Column | str) -> Column:
    """DOUBLE amount -> BIGINT units of 1/10000, half up."""
    return F.floor(_col(amount) * F.lit(float(UNITS)) + F.lit(0.5))


def money(units: Column | str, digits: int = 2) -> Column:
    """BIGINT units -> DOUBLE amount rounded to ``digits``."""
    exact = _col(units).cast(_WIDE) * F.lit(Decimal("0.0001"))
    return F.round(exact, digits).cast("double")


def exact_ratio(num: Column | str, den: Column | str, times: int = 1) -> Column:
    """num * times / den as a decimal; NULL when den is 0 or NULL."""
    top = _col(num).cast(_WIDE) * F.lit(Decimal(times))
    return F.try_divide(top, _col(den).cast(_WIDE))


def ratio(
    num: Column | str,
    den: Column | str,
    times: int = 1,
    digits: int = 2,
    default: float | None = None,
) -> Column:
    """Guarded, rounded ratio. ``times=100`` gives a percentage."""
    out = F.round(exact_ratio(num, den, times), digits).cast("double")
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def units_ratio(
    units: Column | str,
    den: Column | str,
    digits: int = 2,
    default: float | None = None,
) -> Column:
    """Money per something: units / 10000 / den, guarded and rounded."""
    return ratio(units, _col(den).cast(_WIDE) * F.lit(Decimal(UNITS)), 1, digits, default)


def avg_ratio(value: Column | str, digits: int = 2) -> Column:
    """Aggregate: mean of an integer column, rounded."""
    return ratio(F.sum(_col(value)), F.count(_col(value)), 1, digits)
