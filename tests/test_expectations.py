"""Expectation semantics: TRUE passes, FALSE and NULL fail (unless null_passes)."""

import pytest
from pyspark.sql import Row

from urbanlake.operators.expectations import (
    SILVER_EXPECTATIONS,
    apply_expectations,
    dq_metrics,
    expect,
    expect_or_drop,
    expect_or_fail,
    quarantine,
)


def frame(spark, values):
    return spark.createDataFrame([Row(id=i, x=v) for i, v in enumerate(values)], "id int, x int")


@pytest.mark.parametrize("null_passes", [False, True])
def test_truth_table(spark, null_passes):
    df = frame(spark, [5, -5, None])          # TRUE, FALSE, NULL for x > 0
    warn = [expect("positive", "x > 0", null_passes)]
    drop = [expect_or_drop("positive", "x > 0", null_passes)]
    assert apply_expectations(df, warn).count() == 3
    kept = sorted(r.id for r in apply_expectations(df, drop).collect())
    assert kept == ([0, 2] if null_passes else [0])
    m = {r.expectation: (r.action, r.passed, r.failed) for r in dq_metrics(df, drop).collect()}
    assert m["positive"] == ("drop", 2 if null_passes else 1, 1 if null_passes else 2)
    q = quarantine(df, drop).collect()
    assert sorted(r.id for r in q) == ([1] if null_passes else [1, 2])
    assert all(r.failed_expectations == "positive" for r in q)


def test_fail_action_raises(spark):
    df = frame(spark, [1, -1])
    with pytest.raises(Exception, match="expectation positive failed"):
        apply_expectations(df, [expect_or_fail("positive", "x > 0")]).collect()
    assert apply_expectations(frame(spark, [1, 2]), [expect_or_fail("positive", "x > 0")]).count() == 2


def test_unknown_action():
    from urbanlake.operators.expectations import Expectation

    with pytest.raises(ValueError):
        Expectation("a", "x > 0", "explode")


def test_quarantine_joins_names_in_rule_order(spark):
    rows = [Row(latitude=95.0, longitude=200.0, sensor_type="x", sensor_id=None, event_timestamp=None)]
    df = spark.createDataFrame(rows, "latitude double, longitude double, sensor_type string, sensor_id string, "
                                     "event_timestamp timestamp_ntz")
    q = quarantine(df, SILVER_EXPECTATIONS).collect()
    assert q[0].failed_expectations == "valid_latitude,valid_longitude,valid_sensor_type"
    m = {r.expectation: (r.passed, r.failed) for r in dq_metrics(df, SILVER_EXPECTATIONS).collect()}
    assert m["valid_sensor_id"] == (0, 1) and m["valid_coordinates"] == (1, 0)


def test_kept_plus_quarantined_is_input(spark):
    from conftest import SF_SMALL
    from urbanlake.plans.catalog import sr

    df = sr(spark, SF_SMALL)
    n = df.count()
    assert apply_expectations(df, SILVER_EXPECTATIONS).count() + quarantine(df, SILVER_EXPECTATIONS).count() == n
    warn_counts = {r.expectation: r.passed + r.failed for r in dq_metrics(df, SILVER_EXPECTATIONS).collect()}
    assert set(warn_counts.values()) == {n}
