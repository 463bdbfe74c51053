"""Dashboard queries against a brute-force pandas version of the same rules."""

import datetime as dt
import math

import pandas as pd
import pytest

from conftest import SF_SMALL
from urbanlake.operators import serving as sv
from urbanlake.plans.catalog import gd, gh

KPI = sv.KPI_VALUES


def brute_latest(pdf: pd.DataFrame, period: str) -> dict:
    out = {}
    for city, g in pdf[pdf.city_id.notna()].groupby("city_id"):
        g = g.assign(_null=g[period].isna()).sort_values(["_null", period, "sensor_type"],
                                                          ascending=[True, False, True])
        latest = g.iloc[0]
        prev = g.iloc[1] if len(g) > 1 else latest
        d = {}
        for name, v, kind in sv.KPI_DELTAS:
            c, p = latest[v], prev[v]
            if p is None or (isinstance(p, float) and math.isnan(p)) or not p > 0:
                d[name] = None
            else:
                d[name] = (c - p) / p * 100.0 if kind == "pct" else c - p
        out[city] = (latest["sensor_type"], d)
    return out


def _eq(a, b):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    return b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a))


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_kpi_latest_matches_brute_force(spark, grain):
    gold = gh(spark, SF_SMALL) if grain == "hour" else gd(spark, SF_SMALL)
    period = sv.period_column(gold)
    expected = brute_latest(gold.toPandas(), period)
    got = {r.city_id: r for r in sv.kpi_latest(gold).collect()}
    assert set(got) == set(expected)
    for city, (stype, deltas) in expected.items():
        assert got[city].sensor_type == stype
        for name, value in deltas.items():
            assert _eq(value, got[city][name]), (city, name, value, got[city][name])


GOLD_EDGE = "city_id string, sensor_type string, event_date date, avg_vehicles double, total_energy_kwh double, " \
            "avg_occupancy_rate double, avg_noise_level double, unique_sensors bigint"


def test_gold_edge_cases(spark):
    d = dt.date
    rows = [
        ("ONE", "Trafik Sayacı", d(2024, 1, 1), 10.0, None, None, None, 1),            # single row: delta 0
        ("ZERO", "Trafik Sayacı", d(2024, 1, 2), 10.0, None, None, None, 1),
        ("ZERO", "Trafik Sayacı", d(2024, 1, 1), 0.0, None, None, None, 1),             # previous 0: NULL
        ("NUL", "Trafik Sayacı", d(2024, 1, 2), 10.0, None, None, None, 1),
        ("NUL", "Trafik Sayacı", d(2024, 1, 1), None, None, None, None, 1),             # previous NULL: NULL
        ("TIE", "Çevre Sensörü", d(2024, 1, 2), None, None, None, 50.0, 2),
        ("TIE", "Atık Sensörü", d(2024, 1, 2), None, None, 40.0, None, 3),             # same day: sensor type order
        (None, "Trafik Sayacı", d(2024, 1, 2), 99.0, None, None, None, 1),              # NULL city: not served
    ]
    gold = spark.createDataFrame(rows, GOLD_EDGE)
    got = {r.city_id: r for r in sv.kpi_latest(gold).collect()}
    assert set(got) == {"ONE", "ZERO", "NUL", "TIE"}
    assert got["ONE"].vehicles_pct == 0.0
    assert got["ZERO"].vehicles_pct is None
    assert got["NUL"].vehicles_pct is None
    assert got["TIE"].sensor_type == "Atık Sensörü"        # 'A' before 'Ç'
    assert got["TIE"].occupancy_diff is None               # previous row (noise sensor) has no occupancy
    b = {(r.city_id, r.sensor_type): r for r in sv.breakdown_by_sensor_type(gold).collect()}
    assert b[("TIE", "Atık Sensörü")].total_energy_kwh == 0.0   # sum of only NULLs is 0
    assert b[("TIE", "Atık Sensörü")].unique_sensors == 3
    ch = {(r.city_id, r.event_date): r for r in sv.kpi_change_by_type(gold).collect()}
    assert ch[("ZERO", d(2024, 1, 1))].vehicles_pct is None
    assert ch[("ZERO", d(2024, 1, 2))].vehicles_pct is None
    with pytest.raises(ValueError):
        sv.context_kpis(gold, [])


def test_trend_caps_rows_per_city(spark):
    rows = [("BIG", "Trafik Sayacı", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i), None, None, None, 1)
            for i in range(200)]
    gold = spark.createDataFrame(rows, GOLD_EDGE)
    t = sv.trend(gold, 168).collect()
    assert len(t) == 168
    assert min(r.event_date for r in t) == dt.date(2020, 1, 1) + dt.timedelta(days=32)


def test_recent_summary_matches_brute_force(spark):
    gold = gh(spark, SF_SMALL)
    pdf = gold.toPandas()
    got = {r.city_id: r for r in sv.recent_summary(gold, 24).collect()}
    for city, g in pdf.groupby("city_id"):
        g = g.sort_values(["event_hour", "sensor_type"], ascending=[False, True]).head(24)
        r = got[city]
        assert _eq(g.avg_vehicles.mean(), r.avg_vehicles)
        assert _eq(float(g.max_vehicles.max()), float(r.peak_vehicles))
        assert _eq(g.total_energy_kwh.sum(), r.total_energy_kwh)
        assert _eq(g.avg_noise_level.mean(), r.avg_noise_level)


def test_city_list_and_preview(spark):
    gold = gd(spark, SF_SMALL)
    assert sv.city_list_string(gold).first().cities == "C0, C1, C2, C3, C4"
    p = sv.preview(gold, 10).collect()
    assert len(p) == 10 and p == sorted(p, key=lambda r: (r.event_date, r.city_id, r.sensor_type))


def test_window_group_limit_before_shuffle(spark):
    df = sv.trend(gh(spark, SF_SMALL), 168)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in optimized
    physical = df._jdf.queryExecution().toString()
    # the partial limit runs in the map tasks, below the exchange on city_id
    assert physical.count("WindowGroupLimit") >= 2
