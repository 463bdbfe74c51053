"""Aggregate measures.

``plain`` measures are the ones a user writes (``sum``, ``avg``).  ``fixed``
measures add values as integers of a given decimal scale: the result does not
depend on summation order, so it is the same for any partitioning, any number
of executors and any engine.  Use them when inputs have a known number of
decimals (sensor metrics have two) and results must be reproducible.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: From this many decimals on, units are added in DECIMAL(38,0).
WIDE_SCALE = 6


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(c, scale: int) -> Column:
    """Value as an integer count of 10^-scale units (nearest, half away from zero).

    Plain arithmetic rather than ``round`` (which goes through a BigDecimal
    per value): this runs once per metric value on the hot path of gold.
    """
    x = _col(c) * F.lit(float(10 ** scale))
    return (F.signum(x) * F.floor(F.abs(x) + F.lit(0.5))).cast("bigint")


def fixed_sum(c: str, scale: int | None = None, wide: bool | None = None) -> Column:
    """sum(c); exact at ``scale`` decimals when a scale is given.

    ``wide`` sums in DECIMAL(38,0), where a bigint sum of scaled values could
    overflow; by default from ``WIDE_SCALE`` decimals on.  For a column name the
    measure is built from its SQL text (one call into the JVM instead of one
    per expression node).
    """
    return F.expr(sql_fixed_sum(f"`{c}`", scale, wide))


def fixed_avg(c: str, scale: int | None = None, wide: bool | None = None) -> Column:
    """avg(c) (NULLs skipped, NULL when no value); exact sum at ``scale`` decimals."""
    return F.expr(sql_fixed_avg(f"`{c}`", scale, wide))


def _sql_units(expr: str, scale: int, wide: bool | None) -> str:
    x = f"(({expr}) * CAST({10 ** scale} AS DOUBLE))"
    if wide is None:
        wide = scale >= WIDE_SCALE
    if wide:                                    # floor() gives a bigint, which a wide value may pass
        return f"CAST({x} AS DECIMAL(38,0))"
    return f"CAST(sign({x}) * floor(abs({x}) + CAST(0.5 AS DOUBLE)) AS BIGINT)"


def sql_fixed_sum(expr: str, scale: int | None, wide: bool | None = None) -> str:
    """The same measure as SQL text (runs unchanged in Spark SQL and DuckDB)."""
    if scale is None:
        return f"sum({expr})"
    units = _sql_units(expr, scale, wide)
    return f"(CAST(sum({units}) AS DOUBLE) / CAST({10 ** scale} AS DOUBLE))"


def sql_fixed_avg(expr: str, scale: int | None, wide: bool | None = None) -> str:
    if scale is None:
        return f"avg({expr})"
    units = _sql_units(expr, scale, wide)
    return (f"(CAST(sum({units}) AS DOUBLE) / "
            f"CAST(NULLIF(count({expr}) * {10 ** scale}, 0) AS DOUBLE))")


def rounded_sql(expr: str, decimals: int | None) -> str:
    """Round to ``decimals`` places, half away from zero on the scaled double, as Spark SQL text.

    Plain IEEE arithmetic (no per-value BigDecimal as in ``round``): cheap in
    generated code, and the same operations give the same bits in any engine.
    ``expr`` is returned unchanged when ``decimals`` is None.
    """
    if decimals is None:
        return f"({expr})"
    k = f"{float(10 ** decimals)!r}D"
    return f"(signum({expr}) * CAST(floor(abs({expr}) * {k} + 0.5D) AS DOUBLE) / {k})"
