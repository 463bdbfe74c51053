"""Property tests on random sensor rows (hypothesis)."""

import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urbanlake.operators.expectations import SILVER_EXPECTATIONS, apply_expectations, dq_metrics, quarantine
from urbanlake.operators.gold import gold_day, gold_hour
from urbanlake.schemas import SENSOR_TYPES, SILVER_SCHEMA

SCHEMA = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SILVER_SCHEMA.fields if f.name != "processed_at")
BASE = dt.datetime(2024, 1, 1)

money = st.one_of(st.none(), st.integers(0, 100000).map(lambda c: c / 100))
row = st.tuples(
    st.sampled_from(["C0", "C1", None]),
    st.sampled_from(["S1", "S2", "S3", None]),
    st.sampled_from([None, -91.0, -90.0, 0.0, 45.5, 90.0, 90.0001]),
    st.sampled_from([None, -180.0, 0.0, 180.0, 180.5]),
    st.one_of(st.none(), st.integers(0, 72 * 3600).map(lambda s: BASE + dt.timedelta(seconds=s))),
    st.sampled_from(SENSOR_TYPES + ["signup", None]),
    st.just("Cadde"), st.just("Okul, Park"),
    st.one_of(st.none(), st.integers(0, 500)),
    money, money, money,
)
SETTINGS = settings(max_examples=int(os.environ.get("URBANLAKE_HYPOTHESIS_EXAMPLES", "8")), deadline=None,
                    suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_conservation_and_rollup(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    n = len(rows)
    kept = apply_expectations(df, SILVER_EXPECTATIONS)
    k = kept.count()
    assert k + quarantine(df, SILVER_EXPECTATIONS).count() == n
    assert all(r.passed + r.failed == n for r in dq_metrics(df, SILVER_EXPECTATIONS).collect())
    gh, gd = gold_hour(kept, scale=2), gold_day(kept, scale=2)
    assert (gh.agg(F.sum("record_count")).first()[0] or 0) == k
    assert (gd.agg(F.sum("record_count")).first()[0] or 0) == k
    hv = gh.agg(F.sum("total_vehicles")).first()[0]
    dv = gd.agg(F.sum("total_vehicles")).first()[0]
    assert hv == dv


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_row_order_does_not_matter(spark, rows):
    a = spark.createDataFrame(rows, SCHEMA)
    b = spark.createDataFrame(list(reversed(rows)), SCHEMA).repartition(3)
    ga = gold_hour(apply_expectations(a, SILVER_EXPECTATIONS), scale=2)
    gb = gold_hour(apply_expectations(b, SILVER_EXPECTATIONS), scale=2)
    assert ga.exceptAll(gb).count() == 0 and gb.exceptAll(ga).count() == 0


GOLD_SCHEMA = ("city_id string, sensor_type string, event_date date, avg_vehicles double, total_energy_kwh double, "
               "avg_occupancy_rate double, avg_noise_level double")
metric = st.one_of(st.none(), st.just(0.0), st.integers(-500, 5000).map(lambda c: c / 10))
gold_row = st.tuples(st.sampled_from(["C0", "C1", None]), st.sampled_from(SENSOR_TYPES),
                     st.one_of(st.none(), st.integers(0, 5).map(lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i))),
                     metric, metric, metric, metric)


def _expected_change(cur, prev, kind):
    if prev is None or not prev > 0 or cur is None:
        return None
    return (cur - prev) / prev * 100.0 if kind == "pct" else cur - prev


@SETTINGS
@given(rows=st.lists(gold_row, min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1], r[2])))
def test_kpi_latest_and_change_match_brute_force(spark, rows):
    from urbanlake.operators import serving as sv

    gold = spark.createDataFrame(rows, GOLD_SCHEMA)
    got = {r.city_id: r for r in sv.kpi_latest(gold).collect()}
    cities = {r[0] for r in rows if r[0] is not None}
    assert set(got) == cities
    idx = {n: i for i, n in enumerate(["city_id", "sensor_type", "event_date", *sv.KPI_VALUES])}
    for city in cities:
        mine = [r for r in rows if r[0] == city]
        # latest first: period descending with NULL last, then sensor type ascending
        mine.sort(key=lambda r: (r[2] is None, -(r[2].toordinal() if r[2] else 0), r[1]))
        latest, prev = mine[0], (mine[1] if len(mine) > 1 else mine[0])
        assert got[city].sensor_type == latest[1] and got[city].event_date == latest[2]
        for name, v, kind in sv.KPI_DELTAS:
            want = _expected_change(latest[idx[v]], prev[idx[v]], kind)
            have = got[city][name]
            assert (want is None and have is None) or abs(want - have) <= 1e-9 * max(1.0, abs(want)), (name, want, have)
    changes = {(r.city_id, r.sensor_type, r.event_date): r for r in sv.kpi_change_by_type(gold).collect()}
    for (city, stype), series in _series(rows).items():
        for i, r in enumerate(series):
            p = series[i - 1] if i else None
            for name, v, kind in sv.KPI_DELTAS:
                want = _expected_change(r[idx[v]], p[idx[v]] if p else None, kind)
                have = changes[(city, stype, r[2])][name]
                assert (want is None and have is None) or abs(want - have) <= 1e-9 * max(1.0, abs(want))


def _series(rows):
    out = {}
    for r in rows:
        if r[0] is not None:
            out.setdefault((r[0], r[1]), []).append(r)
    for v in out.values():
        v.sort(key=lambda r: (r[2] is None, r[2].toordinal() if r[2] else 0))
    return out


def _close(a, b):
    if a is None or (isinstance(a, float) and a != a):
        return b is None or (isinstance(b, float) and b != b)
    return b is not None and abs(a - b) <= 1e-9 * max(1.0, abs(a))


@SETTINGS
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_gold_day_matches_pandas(spark, rows):
    import pandas as pd

    df = apply_expectations(spark.createDataFrame(rows, SCHEMA), SILVER_EXPECTATIONS)
    kept = df.toPandas()
    got = {(r.city_id, r.sensor_type, r.event_date): r for r in gold_day(df, scale=2).collect()}
    assert len(got) == len(kept.groupby(["city_id", "sensor_type", kept.event_timestamp.dt.date],
                                        dropna=False)) if len(kept) else len(got) == 0
    for (city, stype, day), g in kept.assign(d=kept.event_timestamp.dt.date).groupby(
            ["city_id", "sensor_type", "d"], dropna=False):
        day = None if pd.isna(day) else day
        city = None if pd.isna(city) else city
        r = got[(city, stype, day)]
        assert r.record_count == len(g)
        assert r.unique_sensors == g.sensor_id.dropna().nunique()
        assert _close(g.vehicle_count.dropna().sum() if g.vehicle_count.notna().any() else None,
                      None if r.total_vehicles is None else float(r.total_vehicles))
        for col, out in [("energy_kwh", "avg_energy_kwh"), ("occupancy_rate", "avg_occupancy_rate"),
                         ("noise_level", "avg_noise_level"), ("vehicle_count", "avg_vehicles")]:
            vals = g[col].dropna()
            assert _close(float(vals.mean()) if len(vals) else None, r[out]), (col, list(vals), r[out])


gold_rows = st.lists(gold_row, min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1], r[2]))


@SETTINGS
@given(rows=gold_rows)
def test_breakdown_profile_comparison_match_pandas(spark, rows):
    import pandas as pd

    from urbanlake.operators import serving as sv

    cols = ["city_id", "sensor_type", "event_date", "avg_vehicles", "total_energy_kwh", "avg_occupancy_rate",
            "avg_noise_level"]
    gold = spark.createDataFrame(rows, GOLD_SCHEMA).withColumn("unique_sensors", F.lit(2).cast("bigint"))
    pdf = pd.DataFrame(rows, columns=cols).astype({c: "float64" for c in cols[3:]})
    served = pdf[pdf.city_id.notna()]
    b = {(r.city_id, r.sensor_type): r for r in sv.breakdown_by_sensor_type(gold).collect()}
    for (city, stype), g in served.groupby(["city_id", "sensor_type"]):
        r = b[(city, stype)]
        assert _close(g.avg_vehicles.mean() if g.avg_vehicles.notna().any() else None, r.avg_vehicles)
        assert _close(float(g.total_energy_kwh.sum()), r.total_energy_kwh)          # all-NULL sum is 0
        assert r.unique_sensors == 2 * len(g)
    prof = {r.city_id: r for r in sv.city_profile(gold).collect()}
    assert set(prof) == set(served.city_id)
    for city, g in served.groupby("city_id"):
        for c in sv.KPI_VALUES:
            assert _close(g[c].mean() if g[c].notna().any() else None, prof[city][c])
    comp = {(r.city_id, r.sensor_type) for r in sv.comparison_by_city_type(gold, ["C0"]).collect()}
    assert comp == {(c, s) for c, s in zip(served.city_id, served.sensor_type) if c == "C0"}


policy = st.tuples(st.integers(1, 10**9), st.floats(10, 100), st.floats(5, 50), st.floats(50, 150), st.floats(1, 20),
                   st.floats(0, 0.3), st.sampled_from([0, 1]), st.sampled_from([0, 1]))


@SETTINGS
@given(rows=st.lists(policy, min_size=1, max_size=20, unique_by=lambda r: r[0]))
def test_policy_scoring_in_logarithms(spark, rows):
    """A price's share of the base acts with the elasticity, the flags and congestion as rates on top."""
    import math

    from urbanlake.operators import policy as pol
    from urbanlake.schemas import POLICY_SCHEMA, SERVICES

    df = spark.createDataFrame(rows, POLICY_SCHEMA)
    got = {(r.policy_id, r.service): r for r in pol.score_elastic(pol.policy_features(df), None, None).collect()}
    assert len(got) == 4 * len(rows)
    on_holidays = {"metro": 0.9, "bus": 0.9, "private_transport": 1.1, "water": 1.0}
    with_congestion = {"metro": 1, "private_transport": -1}
    for pid, *prices, tax, fest, hol in rows:
        for (service, base_price, base_demand, elasticity), price in zip(SERVICES, prices, strict=True):
            log = math.log(base_demand) + elasticity * (math.log(price) - math.log(base_price))
            log += math.log1p(with_congestion.get(service, 0) * (0.65 + 0.3 * tax))
            log += fest * math.log(1.2) + hol * math.log(on_holidays[service])
            r = got[(pid, service)]
            assert math.isclose(r.demand, max(1.0, math.exp(log)), rel_tol=1e-9)
            assert math.isclose(r.revenue, r.demand * price, rel_tol=1e-12)
