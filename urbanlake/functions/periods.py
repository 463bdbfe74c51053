"""Period keys for event-time aggregation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hour_start(ts) -> Column:
    """Start of the hour of a TIMESTAMP_NTZ, computed on wall-clock fields.

    Unlike ``date_trunc`` (which returns a zoned TIMESTAMP), this stays
    TIMESTAMP_NTZ and does not depend on the session time zone.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0))


def day_of(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.to_date(c)


GRAINS = {"hour": ("event_hour", hour_start), "day": ("event_date", day_of)}
