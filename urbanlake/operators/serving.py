"""Dashboard queries over the gold tables.

Every panel is one DataFrame query: filter first (pushed to the parquet
scan), then a window or an aggregate.  "Latest n rows of a city" is
``row_number() <= n`` over (city) ordered by period desc, sensor_type asc;
Catalyst turns it into a WindowGroupLimit that keeps only n rows per city in
each task *before* the shuffle, so a city with a huge history costs at most
n rows per task on the wire.

Semantics kept from the dashboards:

* rows with a NULL city are not served (they form no city selection);
* "latest" and "previous" are rows, not periods: with several sensor types
  in the latest period, the previous row can be the same period;
* previous falls back to latest when a city has one row (change 0);
* a change is shown only when the previous value is > 0, otherwise NULL;
  vehicles and energy as % change, occupancy and noise as differences;
* means of already averaged columns are unweighted (mean of means);
* a sum over only-NULL values is 0 (``total_energy_kwh``), a mean is NULL;
* ``unique_sensors`` summed over periods counts sensor-periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.functions.measures import fixed_avg, fixed_sum
from urbanlake.functions.periods import GRAINS

KPI_VALUES = ["avg_vehicles", "total_energy_kwh", "avg_occupancy_rate", "avg_noise_level"]
KPI_DELTAS = [("vehicles_pct", "avg_vehicles", "pct"), ("energy_pct", "total_energy_kwh", "pct"),
              ("occupancy_diff", "avg_occupancy_rate", "diff"), ("noise_diff", "avg_noise_level", "diff")]


def period_column(gold: DataFrame) -> str:
    for c in ("event_hour", "event_date"):
        if c in gold.columns:
            return c
    raise ValueError("gold table needs an event_hour or event_date column")


def served(gold: DataFrame) -> DataFrame:
    return gold.filter("city_id IS NOT NULL")


def latest_rows(gold: DataFrame, n: int, rank_col: str = "rn") -> DataFrame:
    """The latest ``n`` rows of every city, with their rank (1 = latest)."""
    period = period_column(gold)
    rank = (f"row_number() OVER (PARTITION BY city_id ORDER BY {period} DESC NULLS LAST, "
            f"sensor_type ASC NULLS LAST) AS {rank_col}")
    return served(gold).selectExpr("*", rank).filter(f"{rank_col} <= {int(n)}")


def change_sql(cur: str, prev: str, kind: str, otherwise: float | None = None) -> str:
    """% change (``pct``) or difference, shown only when the previous value is > 0.

    ``otherwise``: the value shown when it is not (NULL by default; 0 in the
    variant of the dashboard that shows a zero change instead of N/A).
    """
    other = "" if otherwise is None else f" ELSE {float(otherwise)!r}D"
    if kind == "pct":
        return f"CASE WHEN {prev} > 0 THEN ({cur} - {prev}) / {prev} * 100.0D{other} END"
    return f"CASE WHEN {prev} > 0 THEN {cur} - {prev}{other} END"


def kpi_latest(gold: DataFrame, no_change_value: float | None = None) -> DataFrame:
    """Latest row of each city with its change against the previous row.

    ``no_change_value``: shown instead of NULL when the previous value is not
    positive (e.g. 0.0).
    """
    period = period_column(gold)
    top2 = latest_rows(gold, 2)
    aggs = ([f"max(CASE WHEN rn = 1 THEN {c} END) AS {c}" for c in ["sensor_type", period, *KPI_VALUES]]
            + [f"max(CASE WHEN rn = 2 THEN {c} END) AS _prev_{c}" for c in KPI_VALUES] + ["max(rn) AS _rows"])
    picked = top2.groupBy("city_id").agg(*[F.expr(a) for a in aggs])
    prev = {c: f"(CASE WHEN _rows = 1 THEN {c} ELSE _prev_{c} END)" for c in KPI_VALUES}
    return picked.selectExpr("city_id", "sensor_type", period, *KPI_VALUES,
                             *[f"{change_sql(v, prev[v], k, no_change_value)} AS {name}"
                               for name, v, k in KPI_DELTAS])


def kpi_change_by_type(gold: DataFrame) -> DataFrame:
    """Period-over-period change of each (city, sensor type) series (NULL for its first period)."""
    period = period_column(gold)
    w = f"OVER (PARTITION BY city_id, sensor_type ORDER BY {period} ASC NULLS LAST)"
    return served(gold).selectExpr(
        "city_id", "sensor_type", period, *KPI_VALUES,
        *[f"{change_sql(v, f'lag({v}) {w}', k)} AS {name}" for name, v, k in KPI_DELTAS])


def trend(gold: DataFrame, n: int) -> DataFrame:
    """The four series over the latest ``n`` rows of each city."""
    period = period_column(gold)
    return latest_rows(gold, n).select("city_id", period, "sensor_type", *KPI_VALUES)


def recent_summary(gold: DataFrame, n: int = 24, mean_scale: int | None = None,
                   sum_scale: int | None = None) -> DataFrame:
    """Per-city summary of the latest ``n`` rows (peak vehicles only for hourly data)."""
    top = latest_rows(gold, n)
    aggs = [fixed_avg("avg_vehicles", mean_scale).alias("avg_vehicles")]
    if "max_vehicles" in gold.columns:
        aggs.append(F.max("max_vehicles").alias("peak_vehicles"))
    aggs += [
        F.coalesce(fixed_sum("total_energy_kwh", sum_scale), F.lit(0.0)).alias("total_energy_kwh"),
        fixed_avg("avg_energy_kwh", mean_scale).alias("avg_energy_kwh"),
        fixed_avg("avg_occupancy_rate", mean_scale).alias("avg_occupancy_rate"),
        fixed_avg("avg_noise_level", mean_scale).alias("avg_noise_level"),
    ]
    return top.groupBy("city_id").agg(*aggs)


def breakdown_by_sensor_type(gold: DataFrame, mean_scale: int | None = None,
                             sum_scale: int | None = None) -> DataFrame:
    """Per city and sensor type: mean vehicles, energy total, mean occupancy/noise, sensor-periods."""
    return (served(gold).filter(F.col("sensor_type").isNotNull())
            .groupBy("city_id", "sensor_type").agg(
                fixed_avg("avg_vehicles", mean_scale).alias("avg_vehicles"),
                F.coalesce(fixed_sum("total_energy_kwh", sum_scale), F.lit(0.0)).alias("total_energy_kwh"),
                fixed_avg("avg_occupancy_rate", mean_scale).alias("avg_occupancy_rate"),
                fixed_avg("avg_noise_level", mean_scale).alias("avg_noise_level"),
                F.sum("unique_sensors").alias("unique_sensors")))


def _require_cities(cities: list[str]) -> list[str]:
    if not cities:
        raise ValueError("select at least one city")
    return list(cities)


def select_cities(gold: DataFrame, cities: list[str]) -> DataFrame:
    """IN-list filter (pushed into the scan).  Long lists: use a semi join instead."""
    return gold.filter(F.col("city_id").isin(_require_cities(cities)))


def comparison_by_city_type(gold: DataFrame, cities: list[str], mean_scale: int | None = None) -> DataFrame:
    """Means of the four metrics per (city, sensor type) for the selected cities."""
    return (select_cities(gold, cities).filter(F.col("sensor_type").isNotNull())
            .groupBy("city_id", "sensor_type")
            .agg(*[fixed_avg(c, mean_scale).alias(c) for c in KPI_VALUES]))


def city_profile(gold: DataFrame, mean_scale: int | None = None) -> DataFrame:
    """Mean of the four metrics per city."""
    return served(gold).groupBy("city_id").agg(*[fixed_avg(c, mean_scale).alias(c) for c in KPI_VALUES])


PROFILE_JSON_KEYS = [("avg_vehicles", "avg_vehicles"), ("total_energy", "total_energy_kwh"),
                     ("occupancy", "avg_occupancy_rate"), ("noise", "avg_noise_level")]
PROFILE_JSON_SCHEMA = "avg_vehicles double, total_energy double, occupancy double, noise double"


def city_profile_json(gold: DataFrame, mean_scale: int | None = None) -> DataFrame:
    """city_id, metrics_json: the per-city metrics object as JSON text."""
    prof = city_profile(gold, mean_scale)
    obj = F.struct(*[F.col(src).alias(key) for key, src in PROFILE_JSON_KEYS])
    return prof.select("city_id", F.to_json(obj).alias("metrics_json"))


def context_kpis(gold: DataFrame, cities: list[str], mean_scale: int | None = None) -> DataFrame:
    """Headline numbers of a city selection (cities_analyzed is the size of the selection)."""
    cities = _require_cities(cities)
    return select_cities(gold, cities).agg(
        F.lit(len(cities)).cast("bigint").alias("cities_analyzed"),
        F.count(F.lit(1)).alias("data_points"),
        *[fixed_avg(c, mean_scale).alias(c) for c in KPI_VALUES])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, row_count for each named table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sensor_table_counts(silver: DataFrame) -> DataFrame:
    """table_name, row_count of silver and both gold views, from one scan of silver."""
    keys = ["city_id", "sensor_type"]
    hours = silver.groupBy(*keys, GRAINS["hour"][1]("event_timestamp").alias("event_hour")).agg(F.count(F.lit(1)).alias("n"))
    days = (hours.groupBy(*keys, F.to_date("event_hour").alias("event_date"))
            .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("hours")))
    total = days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("hours"), F.lit(0)).alias("hours"),
                     F.count(F.lit(1)).alias("days"))
    return total.selectExpr("stack(3, 'silver_sensor_data', n, 'gold_sensor_metrics_by_city_hour', hours, "
                            "'gold_sensor_metrics_by_city_day', days) AS (table_name, row_count)")


def date_range(gold_day: DataFrame) -> DataFrame:
    return gold_day.agg(F.min("event_date").alias("start_date"), F.max("event_date").alias("end_date"))


def distinct_cities(gold: DataFrame) -> DataFrame:
    return gold.select("city_id").distinct()


def city_list_string(gold: DataFrame) -> DataFrame:
    """All cities as one sorted, comma-joined string.

    The distinct step shuffles city ids once; only the distinct set (the size
    of the city dimension, not of the data) reaches the final one-row group.
    """
    return (served(gold).select("city_id").distinct()
            .agg(F.array_join(F.sort_array(F.collect_list("city_id")), ", ").alias("cities")))


def preview(gold: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """First n rows under a total order (top-k per task, then merged)."""
    period = period_column(gold)
    return gold.orderBy(*(order or [period, "city_id", "sensor_type"])).limit(n)


def default_city(gold: DataFrame) -> DataFrame:
    """The first city (sorted), used when no city is chosen."""
    return served(gold).select("city_id").distinct().orderBy("city_id").limit(1)


def city_rows(gold: DataFrame, city: str) -> DataFrame:
    return gold.filter(F.col("city_id") == city)
