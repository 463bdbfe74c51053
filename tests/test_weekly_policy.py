"""Weekly table, calendar and policy scoring."""

import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanlake.operators import policy as pol
from urbanlake.operators import weekly as wk
from urbanlake.plans.catalog import WO_KEYS, policies, wo
from urbanlake.schemas import DEFAULT_POLICY, SERVICES


def test_default_spine(spark):
    spine = wk.weekly_spine(spark)
    rows = spine.collect()
    assert len(rows) == 416
    weeks = sorted({r.week for r in rows})
    assert weeks[0] == dt.date(2023, 1, 1) and weeks[-1] == dt.date(2024, 12, 22)
    assert all(w.weekday() == 6 for w in weeks)
    flags = wk.calendar_flags(spine, "week", "2023-01-01").collect()
    assert sum(r.festival for r in flags) == 35 and all(r.holiday == 1 for r in flags)
    assert {r.t for r in flags} == set(range(104))


def test_service_dim(spark):
    assert sorted(tuple(r) for r in wk.service_dim(spark).collect()) == sorted(SERVICES)


#: (service, price, congestion, festival, holiday, season, noise) and the demand worked out by hand.
DEMAND_CASES = [
    ("metro", 30.0, 0.0, 0, 0, "1.0D", 0.0, 500000.0),                  # nothing but the base
    ("metro", 30.0, 0.5, 0, 0, "1.0D", 0.0, 750000.0),                  # congestion drives riders in
    ("metro", 30.0, 0.0, 1, 0, "1.0D", 0.0, 600000.0),                  # a fifth more in festival weeks
    ("metro", 30.0, 0.0, 0, 1, "1.0D", 0.0, 450000.0),                  # a tenth less on holidays
    ("metro", 30.0, 0.5, 1, 1, "1.0D", 0.0, 810000.0),
    ("metro", 30.0, 0.0, 0, 0, "1.1D", 0.0, 550000.0),                  # season
    ("metro", 30.0, 0.0, 0, 0, "1.0D", -0.02, 490000.0),                # noise
    ("bus", 10.0, 0.9, 0, 0, "1.0D", 0.0, 800000.0),                    # congestion leaves buses alone
    ("bus", 10.0, 0.0, 1, 1, "1.0D", 0.0, 864000.0),
    ("private_transport", 80.0, 0.25, 0, 0, "1.0D", 0.0, 450000.0),     # congestion drives cars out
    ("private_transport", 80.0, 0.0, 0, 1, "1.0D", 0.0, 660000.0),      # a tenth more on holidays
    ("private_transport", 80.0, 1.0, 0, 0, "1.0D", 0.0, 1.0),           # never below one
    ("water", 5.0, 0.9, 0, 1, "1.0D", 0.0, 1000000.0),                  # neither congestion nor holidays
    ("water", 160.0, 0.0, 0, 0, "1.0D", 0.0, 250000.0),                 # 32 ** -0.4 is a quarter
    ("metro", None, 0.0, 0, 0, "1.0D", 0.0, None),                      # no price, no demand
    ("metro", -5.0, 0.0, 0, 0, "1.0D", 0.0, None),                      # nor with a negative one
    ("metro", 30.0, None, 0, 0, "1.0D", 0.0, None),
]


@pytest.mark.parametrize("service, price, congestion, festival, holiday, season, noise, want", DEMAND_CASES)
def test_demand_cases(spark, service, price, congestion, festival, holiday, season, noise, want):
    from urbanlake.functions.demand import elastic_demand_sql

    row = spark.createDataFrame([(service, price, congestion, festival, holiday, noise)],
                                "service string, price double, congestion double, festival int, holiday int, noise double")
    sql = elastic_demand_sql("service", "price", "base_price", "base_demand", "elasticity", "congestion", "festival", "holiday",
                             season=season, noise="noise")
    got = wk.with_service_attributes(row).selectExpr(f"{sql} AS demand").first().demand
    assert got is None if want is None else math.isclose(got, want, rel_tol=1e-12)


def test_revenue_is_price_times_demand(spark):
    table = wk.elastic_demand_table(wo(spark, SF_SMALL), WO_KEYS, None, None)
    assert table.filter("abs(revenue - price * demand) > 1e-6 * revenue OR demand < 1").count() == 0


def test_service_table_must_fit(spark):
    rows = spark.createDataFrame([("metro",), ("tram",)], "service string")
    dim = spark.createDataFrame([("metro", 1.0, 2.0, -1.0), ("tram", 3.0, 4.0, -1.0)],
                                "service string, base_price double, base_demand double, elasticity double")
    assert sorted(r.base_price for r in wk.with_service_attributes(rows, dim).collect()) == [1.0, 3.0]
    with pytest.raises(Exception, match="unknown service: tram"):
        wk.with_service_attributes(rows, dim.filter("service = 'metro'")).collect()
    with pytest.raises(Exception, match="service listed twice: metro"):
        wk.with_service_attributes(rows, dim.unionAll(dim.filter("service = 'metro'"))).collect()


def test_null_and_bad_policies_stop_the_job(spark):
    good = policies(spark, SF_SMALL).limit(3)
    for column in ("metro_price", "fuel_tax", "festival"):
        bad = good.withColumn(column, F.lit(None).cast(dict(good.dtypes)[column]))
        with pytest.raises(Exception, match="outside the allowed ranges"):
            pol.validate_policies(bad).collect()
    with pytest.raises(Exception, match="outside the allowed ranges"):
        pol.validate_policies(good.withColumn("bus_price", F.lit(float("nan")))).collect()


def test_policy_grid_is_the_full_product(spark):
    grid = pol.policy_grid(spark)
    rows = grid.orderBy("policy_id").collect()
    names = [n for n, _ in pol.DEFAULT_SWEEPS]
    expected = list(itertools.product(*[v for _, v in pol.DEFAULT_SWEEPS]))
    assert len(rows) == len(expected) == 32000
    assert [tuple(r[n] for n in names) for r in rows] == expected
    assert [r.policy_id for r in rows] == list(range(32000))


def test_policy_scoring_default_policy(spark):
    one = spark.createDataFrame([dict(policy_id=1, **DEFAULT_POLICY)]).select(
        "policy_id", *[F.col(c).cast("double") for c in
                       ["metro_price", "bus_price", "private_transport_price", "water_price", "fuel_tax"]],
        F.col("festival").cast("int"), F.col("holiday").cast("int"))
    feats = pol.policy_features(one)
    scored = {r.service: r for r in pol.score_elastic(feats, None, None).collect()}
    congestion = 0.65 + 0.3 * 0.1
    want = {"metro": 500000.0 * (1 + congestion), "bus": 800000.0, "private_transport": 600000.0 * (1 - congestion),
            "water": 1000000.0}
    for s, price in [("metro", 30.0), ("bus", 10.0), ("private_transport", 80.0), ("water", 5.0)]:
        exp = want[s]
        assert math.isclose(scored[s].demand, exp, rel_tol=1e-12)
        assert math.isclose(scored[s].revenue, exp * price, rel_tol=1e-12)
    f = {r.service: r for r in feats.collect()}
    assert f["metro"].population == 1.1e7 and f["metro"].signal_load == 0.6


def test_policy_validation(spark):
    ok = pol.validate_policies(policies(spark, SF_SMALL))
    assert ok.count() == policies(spark, SF_SMALL).count()
    bad = policies(spark, SF_SMALL).withColumn("metro_price", F.lit(500.0))
    with pytest.raises(Exception, match="outside the allowed ranges"):
        pol.validate_policies(bad).collect()


def test_policy_unpivot_is_narrow(spark):
    df = pol.policy_unpivot(policies(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert df.count() == 4 * policies(spark, SF_SMALL).count()


def test_city_data_types(spark):
    t = wk.city_data(wk.elastic_demand_table(wo(spark, SF_SMALL), WO_KEYS), "1995-01-01")
    types = dict(t.dtypes)
    assert types["week"] == "string" and types["festival"] == "bigint" and types["price"] == "double"
    assert t.first().week.endswith(" 00:00:00")
