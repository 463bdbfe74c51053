"""Gold: metrics per city, sensor type and hour or day.

One parameterised aggregate.  Plan shape: scan silver (only the columns the
measures use) -> partial aggregate on (city, type, period, sensor_id) ->
shuffle -> merge -> partial count-distinct -> shuffle on (city, type, period)
-> final.  A hot group is cut down by the map-side partial aggregate before
any shuffle, so no task ever holds a group's raw rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlake.functions.measures import sql_fixed_avg, sql_fixed_sum
from urbanlake.functions.periods import GRAINS
from urbanlake.schemas import DAILY_COLUMNS, HOURLY_COLUMNS
from urbanlake.sources.tables import replace_table

__all__ = ["DAILY_COLUMNS", "HOURLY_COLUMNS", "GOLD_KEYS", "METRICS", "gold_metrics", "gold_hour", "gold_day", "gold_measures",
           "gold_measure_sql", "write_clustered", "sensor_hours", "gold_from_sensor_hours"]

GOLD_KEYS = ["city_id", "sensor_type"]


def gold_measure_sql(grain: str, scale: int | None = None) -> list[str]:
    """Measures of the hourly (14) or daily (8) table as SQL text.

    ``scale``: add metric values as exact integers of that many decimals
    (order-independent results); ``None`` uses plain sum/avg.
    """
    total_vehicles = "sum(vehicle_count) AS total_vehicles"
    avg_vehicles = f"{sql_fixed_avg('vehicle_count', scale)} AS avg_vehicles"
    total_energy = f"{sql_fixed_sum('energy_kwh', scale)} AS total_energy_kwh"
    avg_energy = f"{sql_fixed_avg('energy_kwh', scale)} AS avg_energy_kwh"
    avg_occ = f"{sql_fixed_avg('occupancy_rate', scale)} AS avg_occupancy_rate"
    avg_noise = f"{sql_fixed_avg('noise_level', scale)} AS avg_noise_level"
    count, sensors = "count(1) AS record_count", "count(DISTINCT sensor_id) AS unique_sensors"
    if grain == "hour":
        return [total_vehicles, avg_vehicles, "max(vehicle_count) AS max_vehicles",
                total_energy, avg_energy, "max(energy_kwh) AS max_energy_kwh",
                avg_occ, "max(occupancy_rate) AS max_occupancy_rate",
                avg_noise, "max(noise_level) AS max_noise_level", count, sensors,
                "min(event_timestamp) AS period_start", "max(event_timestamp) AS period_end"]
    if grain == "day":
        return [total_vehicles, avg_vehicles, total_energy, avg_energy, avg_occ, avg_noise, count, sensors]
    raise ValueError(f"unknown grain {grain!r}; expected 'hour' or 'day'")


def gold_measures(grain: str, scale: int | None = None) -> list[Column]:
    return [F.expr(m) for m in gold_measure_sql(grain, scale)]


def gold_metrics(silver: DataFrame, grain: str = "hour", scale: int | None = None) -> DataFrame:
    """Hourly (``grain='hour'``) or daily gold table from silver rows.

    NULL timestamps form their own NULL-period group; NULL sensor ids are
    counted in record_count but not in unique_sensors.
    """
    if grain not in GRAINS:
        raise ValueError(f"unknown grain {grain!r}; expected 'hour' or 'day'")
    period_name, period = GRAINS[grain]
    # withColumn replaces an existing period column (a date-partitioned silver already has event_date)
    return (silver.withColumn(period_name, period("event_timestamp"))
            .groupBy(*GOLD_KEYS, period_name)
            .agg(*gold_measures(grain, scale)))


def gold_hour(silver: DataFrame, scale: int | None = None) -> DataFrame:
    return gold_metrics(silver, "hour", scale)


def gold_day(silver: DataFrame, scale: int | None = None) -> DataFrame:
    return gold_metrics(silver, "day", scale)


def write_clustered(df: DataFrame, path: str, cluster_by: list[str], files: int | None = None,
                    max_records_per_file: int = 5_000_000, split_hot_keys: bool = True) -> None:
    """Replace a table, once completely written, by one laid out by its clustering keys.

    Range partitioning on the keys + sort within files gives each file a
    narrow min/max on the keys, so parquet row-group statistics skip files
    for key filters (the role of clustered tables).  Without ``files`` the
    number of ranges follows the shuffle settings and AQE merges small ones;
    ``max_records_per_file`` splits large ranges into bounded files.
    ``split_hot_keys`` adds a hash of the row as the last range key: a key
    value holding a large share of the rows then spans several tasks
    instead of one (deterministic, so a retried task gets the same rows).
    """
    keys = [F.col(c) for c in cluster_by]
    hashable = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]   # maps cannot be hashed
    if split_hot_keys and hashable:
        keys.append(F.xxhash64(*[F.col(f"`{c}`") for c in hashable]))
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    written = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    ranged.sortWithinPartitions(*cluster_by).write.option("maxRecordsPerFile", max_records_per_file).parquet(written)
    replace_table(df.sparkSession, written, path)


# ------------------------------------------------- shared pass for both views
METRICS = ["vehicle_count", "energy_kwh", "occupancy_rate", "noise_level"]


def sensor_hours(silver: DataFrame, scale: int | None = None) -> DataFrame:
    """One row per (city, type, hour, sensor): the mergeable parts of every gold measure.

    Both gold views can be derived from this table, so silver is scanned once
    per refresh.  Sums are exact integers of 10^-scale when a scale is given.
    """
    from urbanlake.functions.measures import scaled

    parts = [F.count(F.lit(1)).alias("n_rows"), F.sum("vehicle_count").alias("vehicle_count_total"),
             F.min("event_timestamp").alias("first_ts"), F.max("event_timestamp").alias("last_ts")]
    for m in METRICS:
        value = scaled(m, scale) if scale is not None else F.col(m)
        parts += [F.sum(value).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"), F.max(m).alias(f"{m}_max")]
    return (silver.withColumn("event_hour", GRAINS["hour"][1]("event_timestamp"))
            .groupBy(*GOLD_KEYS, "event_hour", "sensor_id").agg(*parts))


def gold_from_sensor_hours(sh: DataFrame, grain: str, scale: int | None = None) -> DataFrame:
    """Hourly or daily gold from ``sensor_hours`` (equal to ``gold_metrics`` on the same silver)."""
    unit = float(10 ** scale) if scale is not None else 1.0

    def avg(m):
        return F.sum(f"{m}_sum").cast("double") / (F.nullif(F.sum(f"{m}_n"), F.lit(0)).cast("double") * F.lit(unit))

    def total(m):
        return F.sum(f"{m}_sum").cast("double") / F.lit(unit)

    if grain == "hour":
        keys, sensors = [*GOLD_KEYS, "event_hour"], F.count("sensor_id")      # one row per sensor already
        aggs = [F.sum("vehicle_count_total").alias("total_vehicles"), avg("vehicle_count").alias("avg_vehicles"),
                F.max("vehicle_count_max").alias("max_vehicles"),
                total("energy_kwh").alias("total_energy_kwh"), avg("energy_kwh").alias("avg_energy_kwh"),
                F.max("energy_kwh_max").alias("max_energy_kwh"),
                avg("occupancy_rate").alias("avg_occupancy_rate"), F.max("occupancy_rate_max").alias("max_occupancy_rate"),
                avg("noise_level").alias("avg_noise_level"), F.max("noise_level_max").alias("max_noise_level"),
                F.sum("n_rows").alias("record_count"), sensors.alias("unique_sensors"),
                F.min("first_ts").alias("period_start"), F.max("last_ts").alias("period_end")]
        return sh.groupBy(*keys).agg(*aggs)
    if grain == "day":
        return (sh.withColumn("event_date", F.to_date("event_hour"))
                .groupBy(*GOLD_KEYS, "event_date").agg(
                    F.sum("vehicle_count_total").alias("total_vehicles"), avg("vehicle_count").alias("avg_vehicles"),
                    total("energy_kwh").alias("total_energy_kwh"), avg("energy_kwh").alias("avg_energy_kwh"),
                    avg("occupancy_rate").alias("avg_occupancy_rate"), avg("noise_level").alias("avg_noise_level"),
                    F.sum("n_rows").alias("record_count"), F.count_distinct("sensor_id").alias("unique_sensors")))
    raise ValueError(f"unknown grain {grain!r}; expected 'hour' or 'day'")
