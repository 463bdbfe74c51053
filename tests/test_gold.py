"""Gold aggregation edge cases and roll-up properties."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanlake.operators.expectations import SILVER_EXPECTATIONS, apply_expectations
from urbanlake.operators.gold import DAILY_COLUMNS, HOURLY_COLUMNS, gold_day, gold_hour
from urbanlake.plans.catalog import sil
from urbanlake.schemas import SILVER_SCHEMA

SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER_SCHEMA.fields if f.name != "processed_at")


def edge(spark):
    T = dt.datetime
    rows = [
        # city, sensor, lat, lon, ts, type, street, services, vehicles, kwh, occ, noise
        ("C0", None, 10.0, 10.0, None, "Trafik Sayacı", "Cadde", "Park", 5, None, None, None),      # NULL ts kept
        ("C0", None, 90.0, 180.0, T(2024, 1, 1, 10, 59, 59, 999999), "Trafik Sayacı", "Cadde", "Park", 3, None, None, None),
        ("C0", "S1", -90.0, -180.0, T(2024, 1, 1, 11, 0, 0), "Trafik Sayacı", "Cadde", "Park", 7, None, None, None),
        ("C0", "S1", 90.0001, 0.0, T(2024, 1, 1, 11, 0, 1), "Trafik Sayacı", "Cadde", "Park", 9, None, None, None),
        ("C0", "S2", None, 0.0, T(2024, 1, 1, 11, 0, 2), "Trafik Sayacı", "Cadde", "Park", 9, None, None, None),
        ("C0", "S3", 0.0, 0.0, T(2024, 1, 1, 11, 0, 3), "Unknown", "Cadde", "Park", 1, None, None, None),
        ("C0", "S3", 0.0, 0.0, T(2024, 1, 1, 11, 0, 3), None, "Cadde", "Park", 1, None, None, None),
        ("C0", "S3", 0.0, 0.0, T(2024, 1, 1, 11, 0, 3), "Trafik Sayaci", "Cadde", "Park", 1, None, None, None),
        ("C0", "S4", 0.0, 0.0, T(2024, 1, 1, 11, 30), "Enerji Metre", "Cadde", "Park", None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_edge_rows(spark):
    silver = apply_expectations(edge(spark), SILVER_EXPECTATIONS)
    assert silver.count() == 4          # 90.0001, NULL latitude, unknown/NULL/dotless-i types dropped
    h = {(r.sensor_type, r.event_hour): r for r in gold_hour(silver).collect()}
    traffic_null = h[("Trafik Sayacı", None)]
    assert traffic_null.record_count == 1 and traffic_null.unique_sensors == 0
    h10 = h[("Trafik Sayacı", dt.datetime(2024, 1, 1, 10))]
    h11 = h[("Trafik Sayacı", dt.datetime(2024, 1, 1, 11))]
    assert (h10.total_vehicles, h11.total_vehicles) == (3, 7)
    assert h10.unique_sensors == 0 and h11.unique_sensors == 1
    energy = h[("Enerji Metre", dt.datetime(2024, 1, 1, 11))]
    assert energy.total_energy_kwh is None and energy.avg_energy_kwh is None and energy.record_count == 1
    assert gold_hour(silver).columns == HOURLY_COLUMNS
    assert gold_day(silver).columns == DAILY_COLUMNS


def test_hour_rolls_up_to_day(spark):
    s = sil(spark, SF_SMALL)
    gh, gd = gold_hour(s, scale=2), gold_day(s, scale=2)
    assert gh.agg(F.sum("record_count")).first()[0] == s.count()
    assert gd.agg(F.sum("record_count")).first()[0] == s.count()
    rolled = (gh.groupBy("city_id", "sensor_type", F.to_date("event_hour").alias("event_date"))
              .agg(F.sum("total_vehicles").alias("tv"), F.sum("record_count").alias("rc"),
                   F.round(F.sum("total_energy_kwh"), 2).alias("te")))
    joined = rolled.join(gd, ["city_id", "sensor_type", "event_date"])
    assert joined.count() == gd.count()
    bad = joined.filter(~(F.col("tv").eqNullSafe(F.col("total_vehicles")))
                        | (F.col("rc") != F.col("record_count"))
                        | ~(F.col("te").eqNullSafe(F.round("total_energy_kwh", 2))))
    assert bad.count() == 0


def test_result_does_not_depend_on_partitioning(spark):
    s = sil(spark, SF_SMALL)
    a = sorted(gold_day(s, scale=2).collect())
    b = sorted(gold_day(s.repartition(3, "sensor_id"), scale=2).collect())
    assert a == b


def test_views_from_sensor_hours_equal_direct(spark):
    from urbanlake.operators.gold import gold_from_sensor_hours, gold_metrics, sensor_hours

    s = sil(spark, SF_SMALL)
    sh = sensor_hours(s, scale=2)
    for grain in ("hour", "day"):
        direct = gold_metrics(s, grain, scale=2)
        shared = gold_from_sensor_hours(sh, grain, scale=2).select(*direct.columns)
        assert direct.exceptAll(shared).count() == 0 and shared.exceptAll(direct).count() == 0
    # plain double sums: same groups and counts, values equal up to summation order
    a = {(r.city_id, r.sensor_type, r.event_date): r for r in gold_metrics(s, "day").collect()}
    b = {(r.city_id, r.sensor_type, r.event_date): r for r in gold_from_sensor_hours(sensor_hours(s), "day").collect()}
    assert a.keys() == b.keys()
    for key, r in a.items():
        assert r.record_count == b[key].record_count and r.unique_sensors == b[key].unique_sensors
        if r.total_energy_kwh is not None:
            assert abs(r.total_energy_kwh - b[key].total_energy_kwh) < 1e-6
