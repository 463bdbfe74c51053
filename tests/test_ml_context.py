"""Demand model invariants and text/JSON context blocks."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanlake.operators import context as ctx
from urbanlake.operators import ml
from urbanlake.operators import policy as pol
from urbanlake.operators import serving as sv
from urbanlake.plans.catalog import QUERIES, WO_KEYS, gd, gh, policies

SMALL = {"numTrees": 10, "maxDepth": 6}


def test_model_beats_constant_and_stays_in_label_range(spark):
    feats = QUERIES["demand_features"](spark, SF_SMALL)
    train = feats.filter(~ml.holdout_flag(WO_KEYS))
    model = ml.fit_or_load(spark, train, SMALL)
    m = {r.metric: r.value for r in ml.evaluation(model, feats, WO_KEYS).collect()}
    assert m["rmse"] < m["baseline_rmse"] and m["r2"] > 0.5
    assert m["train_rows"] + m["test_rows"] == feats.count()
    lo, hi = feats.filter(~ml.holdout_flag(WO_KEYS)).agg(F.min("demand"), F.max("demand")).first()
    scored = ml.score_policies(model, pol.policy_features(policies(spark, SF_SMALL)))
    plo, phi = scored.agg(F.min("demand"), F.max("demand")).first()
    assert lo - 1e-6 <= plo and phi <= hi + 1e-6
    # saved model reloads with the same predictions
    again = ml.fit_or_load(spark, train, SMALL)
    a = ml.score_policies(again, pol.policy_features(policies(spark, SF_SMALL)))
    assert scored.exceptAll(a).count() == 0


def test_same_seed_same_model(spark):
    feats = QUERIES["demand_features"](spark, SF_SMALL)
    train = feats.filter(~ml.holdout_flag(WO_KEYS))
    p1 = ml.fit_demand_model(train, SMALL).transform(feats).select("prediction")
    p2 = ml.fit_demand_model(train, SMALL).transform(feats).select("prediction")
    assert p1.exceptAll(p2).count() == 0


def test_model_card(spark):
    feats = QUERIES["demand_features"](spark, SF_SMALL)
    model = ml.fit_or_load(spark, feats, SMALL)
    card = {r.name: r.value for r in ml.model_card(spark, model).collect()}
    assert card["features"] == "price,population,congestion,signal_load,festival,holiday"
    assert card["param.numTrees"] == "10"
    assert abs(sum(float(v) for k, v in card.items() if k.startswith("importance.")) - 1.0) < 1e-9


def test_recent_summary_text(spark):
    summary = sv.recent_summary(gh(spark, SF_SMALL), 24)
    texts = {r.city_id: r.text for r in ctx.recent_summary_text(summary, "hourly").collect()}
    row = {r.city_id: r for r in summary.collect()}["C0"]
    t = texts["C0"]
    lines = t.split("\n")
    assert lines[0] == "C0, latest 24 hourly rows" and lines[1].endswith(f", peak {row.peak_vehicles}")
    assert abs(float(lines[2].split("total ")[1].split(",")[0]) - row.total_energy_kwh) < 0.0051
    empty = spark.createDataFrame([("X", None, None, 0.0, None, None, None)],
                                  "city_id string, avg_vehicles double, peak_vehicles int, total_energy_kwh double, "
                                  "avg_energy_kwh double, avg_occupancy_rate double, avg_noise_level double")
    assert "noise (dB): mean n/a" in ctx.recent_summary_text(empty).first().text


def test_metrics_json_document(spark):
    prof = sv.city_profile(gd(spark, SF_SMALL))
    doc = json.loads(ctx.metrics_document(prof).first().document)
    assert sorted(doc) == ["C0", "C1", "C2", "C3", "C4"]
    assert set(doc["C0"]) <= {"avg_vehicles", "total_energy", "occupancy", "noise"}
    per_city = {r.city_id: json.loads(r.metrics_json) for r in sv.city_profile_json(gd(spark, SF_SMALL)).collect()}
    assert per_city["C1"] == doc["C1"]
    lines = {r.city_id: r.text for r in ctx.city_context_text(prof).collect()}
    assert lines["C2"].startswith("C2: avg_vehicles=")


def test_fixed_text(spark):
    from urbanlake.functions.text import fixed

    rows = [(1.25,), (0.0,), (-2.5,), (1e6,), (None,), (float("nan"),), (float("inf"),)]
    df = spark.createDataFrame(rows, "x double")
    assert [r[0] for r in df.select(fixed("x", 2)).collect()] == ["1.25", "0.00", "-2.50", "1000000.00", "n/a", "n/a", "n/a"]
    assert df.select(fixed("x", 0)).first()[0] == "1"


def test_proposal_context_block(spark):
    selected = sv.select_cities(gd(spark, SF_SMALL), ["C1", "C0"])
    prof = sv.city_profile(selected)
    text = ctx.proposal_context_text(prof).first().text
    means = {r.city_id: r for r in prof.collect()}
    assert text.split("\n")[0] == "cities: C0, C1"
    numbers = [float(x.split(" ")[1]) for x in text.split("\n")[1].removeprefix("vehicles per day: ").split(", ")]
    assert numbers == pytest.approx([means["C0"].avg_vehicles, means["C1"].avg_vehicles], abs=0.0051)
    zero = sv.kpi_latest(gh(spark, SF_SMALL), no_change_value=0.0).collect()
    assert all(r.vehicles_pct is not None or r.avg_vehicles is None for r in zero)


def test_models_are_kept_by_data_and_checked(spark):
    feats = QUERIES["demand_features"](spark, SF_SMALL)
    part = feats.filter("price > 20")
    assert ml.data_version(feats) == ml.data_version(feats.repartition(3)) != ml.data_version(part)
    assert ml.data_version(feats) != ml.data_version(feats, SMALL)
    with pytest.raises(ValueError, match="not the model's features"):
        ml.fit_or_load(spark, feats.withColumn("price", F.lit("x")), SMALL)
    with pytest.raises(Exception):
        ml.load_model(spark, "/nowhere/model")
