"""Distinct sensors that roll up exactly: bitmaps over dictionary-coded sensors.

Distinct counts of hours do not add up to those of a day.  Bitmaps do: the bitmap
of a day is the bitwise or of its hours' bitmaps, and its ones are the day's distinct
sensors.  Sensors get numbers from a dictionary, dense within each of its tasks, and a
bitmap covers a block of 32,768 numbers, so a group holds only the blocks that its
sensors are in.  Every level is made from the one below, never from raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.functions.periods import GRAINS
from urbanlake.operators.gold import GOLD_KEYS
from urbanlake.session import work_path


def sensor_codes(silver: DataFrame, sensor: str = "sensor_id") -> DataFrame:
    """``sensor, code``: every sensor's number, written once so that all readers see the same."""
    path = work_path(silver.sparkSession, "sensor-codes")
    names = silver.select(sensor).filter(F.col(sensor).isNotNull()).distinct()
    names.withColumn("code", F.monotonically_increasing_id()).write.parquet(path)
    return silver.sparkSession.read.parquet(path)


def sensor_bitmaps(silver: DataFrame, codes: DataFrame, grain: str = "hour", sensor: str = "sensor_id") -> DataFrame:
    """Keys, period, ``bucket`` and ``bitmap`` of the sensors seen: one row for each block of numbers that a group has."""
    name, period = GRAINS[grain]
    # rows are reduced to the sensors of a group before the join, so a busy sensor is one row for each hour
    seen = silver.select(*GOLD_KEYS, period("event_timestamp").alias(name), sensor).filter(F.col(sensor).isNotNull()).distinct()
    return (seen.join(codes, sensor)
            .groupBy(*GOLD_KEYS, name, F.expr("bitmap_bucket_number(code)").alias("bucket"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(code))").alias("bitmap")))


def rolled_up(bitmaps: DataFrame, keys: list) -> DataFrame:
    """The bitmaps of coarser groups from those of finer ones."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.expr("bitmap_or_agg(bitmap)").alias("bitmap"))


def distinct_sensors(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and ``unique_sensors``."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.expr("bitmap_count(bitmap)")).alias("unique_sensors"))


def unique_sensor_levels(hours: DataFrame) -> DataFrame:
    """``level, city_id, sensor_type, period, unique_sensors`` of hours, days, city and type, type, and everything.

    Each level is the roll-up of the level before it, which is written, so none
    is worked out twice.
    """
    spark = hours.sparkSession

    def written(bitmaps: DataFrame, level: str) -> DataFrame:
        path = work_path(spark, f"bitmaps-{level}")
        bitmaps.write.parquet(path)
        return spark.read.schema(bitmaps.schema).parquet(path)

    day = F.to_date("event_hour").alias("event_date")
    hours = written(hours, "hour")
    days = written(rolled_up(hours, [*GOLD_KEYS, day]), "day")
    pairs = written(rolled_up(days, GOLD_KEYS), "city-type")
    types = written(rolled_up(pairs, ["sensor_type"]), "type")
    every = types.groupBy("bucket").agg(F.expr("bitmap_or_agg(bitmap)").alias("bitmap"))
    levels = [("hour", hours, [*GOLD_KEYS, "event_hour"]), ("day", days, [*GOLD_KEYS, "event_date"]), ("city_type", pairs, GOLD_KEYS),
              ("type", types, ["sensor_type"]), ("all", every, [])]
    out = None
    for level, bitmaps, keys in levels:
        counted = distinct_sensors(bitmaps, keys)
        text = next((F.col(k).cast("string") for k in keys if k.startswith("event")), F.lit(None).cast("string"))
        has = lambda k: F.col(k) if k in keys else F.lit(None).cast("string")  # noqa: B023, E731
        rows = counted.select(F.lit(level).alias("level"), has("city_id").alias("city_id"), has("sensor_type").alias("sensor_type"),
                              text.alias("period"), F.coalesce("unique_sensors", F.lit(0)).cast("long").alias("unique_sensors"))
        out = rows if out is None else out.unionAll(rows)
    return out
