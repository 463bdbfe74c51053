"""Views that map the given test tables onto the sensor and city-service model.

Each view is a list of (SQL expression, name) pairs over one table.  Spark
applies it with ``selectExpr`` (parsed once on the JVM, a single call from
Python) and the oracle runs the same text in DuckDB: the views are specified
to run unchanged on both engines, so both start from identical rows.  The two
date expressions that differ between the engines are given per engine.  They
are narrow projections: no shuffle; filters and column pruning reach the
parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# ---------------------------------------------------------------- sensor view
SENSOR_READINGS: list[tuple[str, str]] = [
    ("event_id", "event_id"),
    ("concat('C', CAST(user_id % 5 AS STRING))", "city_id"),
    ("CASE WHEN event_id % 101 = 0 THEN NULL ELSE concat('S', CAST(user_id AS STRING)) END", "sensor_id"),
    ("CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST(36 + event_id % 61 AS DOUBLE) END", "latitude"),
    ("CAST(26 + (event_id % 20) * 10 AS DOUBLE)", "longitude"),
    ("ts", "event_timestamp"),
    ("CASE event_type WHEN 'click' THEN 'Trafik Sayacı' WHEN 'purchase' THEN 'Enerji Metre' "
     "WHEN 'view' THEN 'Atık Sensörü' WHEN 'error' THEN 'Çevre Sensörü' ELSE event_type END", "sensor_type"),
    ("CASE event_id % 3 WHEN 0 THEN 'Cadde' WHEN 1 THEN 'Sokak' ELSE 'Bulvar' END", "street_type"),
    ("CASE event_id % 2 WHEN 0 THEN 'Okul, Park' ELSE 'Hastane' END", "nearby_services"),
    ("CASE WHEN event_type = 'click' THEN CAST(floor(value) AS INT) END", "vehicle_count"),
    ("CASE WHEN event_type = 'purchase' THEN value END", "energy_kwh"),
    ("CASE WHEN event_type = 'view' THEN least(value, CAST(100 AS DOUBLE)) END", "occupancy_rate"),
    ("CASE WHEN event_type = 'error' THEN value END", "noise_level"),
]

# ----------------------------------------------------- weekly observation view
OBSERVATION_ORIGIN = "1995-01-01"   # a Sunday; week index t counts from here

_SPARK_DATES = {"DAYS": "datediff(CAST(l_shipdate AS DATE), DATE '1995-01-01')",
                "ISODOW": "extract(DAYOFWEEK_ISO FROM CAST(l_shipdate AS DATE))"}
_DUCKDB_DATES = {"DAYS": "date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))",
                 "ISODOW": "extract(isodow FROM l_shipdate)"}

WEEKLY_OBSERVATIONS: list[tuple[str, str]] = [
    ("l_orderkey", "l_orderkey"),
    ("l_linenumber", "l_linenumber"),
    ("CAST(l_shipdate AS DATE)", "obs_date"),
    ("CAST(floor({DAYS} / CAST(7 AS DOUBLE)) AS INT)", "t"),
    ("CASE l_suppkey % 4 WHEN 0 THEN 'metro' WHEN 1 THEN 'bus' WHEN 2 THEN 'private_transport' ELSE 'water' END",
     "service"),
    ("(l_discount - CAST(0.05 AS DOUBLE)) * 2", "price_u"),
    ("(l_tax - CAST(0.04 AS DOUBLE)) * CAST(2.5 AS DOUBLE)", "congestion_u"),
    ("CAST(-0.05 AS DOUBLE) + (l_quantity - 1) / 49 * CAST(0.15 AS DOUBLE)", "pop_u"),
    ("CAST(l_linenumber - 4 AS DOUBLE) / 100", "noise_e"),
    ("CASE WHEN month(l_shipdate) IN (1, 10, 11, 12) THEN 1 ELSE 0 END", "festival"),
    ("CASE WHEN {ISODOW} >= 6 THEN 1 ELSE 0 END", "holiday"),
]

# ---------------------------------------------------------------- policy view
# One pricing policy per order, every field inside its slider range: metro
# 10-100, bus 5-50, private transport 50-150, water 1-20, fuel tax 0-0.30;
# festival/holiday flags from the order date.
POLICY_OBSERVATIONS: list[tuple[str, str]] = [
    ("o_orderkey", "policy_id"),
    ("CAST(10 + o_orderkey % 91 AS DOUBLE)", "metro_price"),
    ("CAST(5 + o_custkey % 46 AS DOUBLE)", "bus_price"),
    ("CAST(50 + CAST(floor(o_totalprice) AS BIGINT) % 101 AS DOUBLE)", "private_transport_price"),
    ("CAST(1 + (o_orderkey + o_custkey) % 20 AS DOUBLE)", "water_price"),
    ("CAST(o_orderkey % 31 AS DOUBLE) / 100", "fuel_tax"),
    ("CASE WHEN month(o_orderdate) IN (1, 10, 11, 12) THEN 1 ELSE 0 END", "festival"),
    ("CASE WHEN {ISODOW} >= 6 THEN 1 ELSE 0 END", "holiday"),
]
_POLICY_SPARK = {"ISODOW": "extract(DAYOFWEEK_ISO FROM CAST(o_orderdate AS DATE))"}
_POLICY_DUCKDB = {"ISODOW": "extract(isodow FROM o_orderdate)"}


def _exprs(view: list[tuple[str, str]], subst: dict[str, str] | None = None) -> list[str]:
    return [f"{e.format(**subst) if subst else e} AS {a}" for e, a in view]


def _sql(view: list[tuple[str, str]], table: str, subst: dict[str, str] | None = None) -> str:
    return "SELECT " + ",\n  ".join(_exprs(view, subst)) + f"\nFROM {table}"


def sensor_readings(events: DataFrame) -> DataFrame:
    """Typed sensor rows (the shape of silver before quality rules) from ``events``."""
    return events.selectExpr(*_exprs(SENSOR_READINGS))


def weekly_observations(lineitem: DataFrame) -> DataFrame:
    """One observation of the weekly demand model per line item.

    The uniform draws of a week (price, congestion, population) become columns
    taken from line-item fields with the same ranges.
    """
    return lineitem.selectExpr(*_exprs(WEEKLY_OBSERVATIONS, _SPARK_DATES))


def policy_observations(orders: DataFrame) -> DataFrame:
    """One pricing policy per order (see POLICY_OBSERVATIONS)."""
    return orders.selectExpr(*_exprs(POLICY_OBSERVATIONS, _POLICY_SPARK))


SENSOR_READINGS_SQL = _sql(SENSOR_READINGS, "events")
WEEKLY_OBSERVATIONS_SQL = _sql(WEEKLY_OBSERVATIONS, "lineitem", _DUCKDB_DATES)
POLICY_OBSERVATIONS_SQL = _sql(POLICY_OBSERVATIONS, "orders", _POLICY_DUCKDB)
