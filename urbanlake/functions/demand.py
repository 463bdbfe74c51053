"""Closed-form demand curve of the city-service model, as column expressions.

demand = base_demand * (price / base_price) ^ elasticity
         [* seasonality(t)] [* (1 + noise)]
         * congestion effect (metro x(1+c), private transport x(1-c))
         * 1.2 in festival weeks
         * holiday effect (metro and bus x0.9, private transport x1.1)
floored at 1; revenue = demand * price.

Expressions are built as Spark SQL text over column names (one call into the
JVM per expression) and returned as Columns.
"""

from __future__ import annotations


from urbanlake.schemas import (
    FESTIVAL_DEMAND,
    HOLIDAY_PRIVATE_DEMAND,
    HOLIDAY_TRANSIT_DEMAND,
)


def d(x: float) -> str:
    """A DOUBLE literal in Spark SQL (a plain 1.2 would be DECIMAL)."""
    return repr(float(x)) + "D"


def clamp01_sql(x: str) -> str:
    return f"least({d(1)}, greatest({d(0)}, {x}))"


def elastic_demand_sql(service: str, price: str, base_price: str, base_demand: str, elasticity: str,
                       congestion: str, festival: str, holiday: str, season: str | None = None,
                       noise: str | None = None) -> str:
    """The curve as a product of factors, applied left to right, at least 1; NULL without a positive price or another input.

    Factors that do not apply are exactly 1.0, so the result equals applying
    only the matching steps one after another.
    """
    base = f"{base_demand} * pow({price} / {base_price}, {elasticity})"
    if season is not None:
        base = f"{base} * ({season})"
    if noise is not None:
        base = f"{base} * ({d(1)} + {noise})"
    congestion_factor = (f"CASE WHEN {service} = 'metro' THEN {d(1)} + {congestion} "
                         f"WHEN {service} = 'private_transport' THEN {d(1)} - {congestion} ELSE {d(1)} END")
    festival_factor = f"CASE WHEN {festival} = 1 THEN {d(FESTIVAL_DEMAND)} ELSE {d(1)} END"
    holiday_factor = (f"CASE WHEN {holiday} = 1 AND {service} IN ('metro', 'bus') THEN {d(HOLIDAY_TRANSIT_DEMAND)} "
                      f"WHEN {holiday} = 1 AND {service} = 'private_transport' THEN {d(HOLIDAY_PRIVATE_DEMAND)} "
                      f"ELSE {d(1)} END")
    inputs = [f"{price} > 0", *(f"({x}) IS NOT NULL" for x in (congestion, season, noise) if x is not None)]
    return (f"CASE WHEN {' AND '.join(inputs)} THEN "
            f"greatest({d(1)}, {base} * ({congestion_factor}) * ({festival_factor}) * ({holiday_factor})) END")
