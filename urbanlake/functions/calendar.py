"""Calendar flags and indexes of the weekly demand model."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanlake.schemas import FESTIVAL_MONTHS, SEASON_AMPLITUDE, SEASON_PERIOD_WEEKS


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def festival_flag(d) -> Column:
    """1 when the date falls in a festival month (January, October-December)."""
    return F.month(_c(d)).isin(FESTIVAL_MONTHS).cast("int")


def holiday_flag(d) -> Column:
    """1 on Saturday and Sunday (ISO day of week 6 or 7)."""
    return (F.weekday(_c(d)) >= 5).cast("int")


def week_index(d, origin: str) -> Column:
    """Whole weeks since ``origin`` (a date string)."""
    return F.floor(F.datediff(F.to_date(_c(d)), F.lit(origin).cast("date")) / F.lit(7.0)).cast("int")


def seasonality_sql(t: str) -> str:
    """SQL text of the yearly cycle 1 + 0.1*sin(2*pi*t/52) of week index t (double literals)."""
    return (f"1.0D + {SEASON_AMPLITUDE!r}D * sin({2 * math.pi!r}D * {t} / "
            f"{float(SEASON_PERIOD_WEEKS)!r}D)")


def sunday_on_or_after(d) -> Column:
    """First Sunday on or after the date (a weekly spine starts there)."""
    return F.next_day(F.date_sub(F.to_date(_c(d)), 1), "Sun")
