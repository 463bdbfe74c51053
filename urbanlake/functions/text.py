"""Numbers as text, with a fixed number of decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "n/a"


def fixed_sql(x: str, decimals: int) -> str:
    """``x`` with ``decimals`` places; NULL, NaN and infinities read ``n/a`` (Spark SQL text)."""
    return (f"coalesce(CAST(try_cast(CASE WHEN isnan(CAST({x} AS DOUBLE)) THEN NULL ELSE {x} END "
            f"AS DECIMAL(38,{decimals})) AS STRING), '{MISSING}')")


def fixed(x: str, decimals: int) -> Column:
    return F.expr(fixed_sql(f"`{x}`", decimals))
