"""Choosing among policies, distinct sensors that roll up, clustering on two keys, models by distinct inputs."""

import itertools
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanlake.operators import ml
from urbanlake.operators import policy as pol
from urbanlake.operators.rollup import distinct_sensors, rolled_up, sensor_bitmaps, sensor_codes, unique_sensor_levels
from urbanlake.operators.zorder import key_cuts, matching_files, read_zordered, write_zordered, z_value
from urbanlake.plans.catalog import QUERIES, policies, sil


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ policies

def test_outcomes_are_the_scored_totals(spark):
    given = policies(spark, SF_SMALL)
    totals = {}
    for r in pol.score_elastic(pol.policy_features(given)).collect():
        d, v = totals.get(r.policy_id, (0.0, 0.0))
        totals[r.policy_id] = d + r.demand, v + r.revenue
    for r in pol.policy_outcomes(given).collect():
        assert r.demand == pytest.approx(totals[r.policy_id][0]) and r.revenue == pytest.approx(totals[r.policy_id][1])


def test_sensitivity_is_narrow_and_centred(spark):
    given = policies(spark, SF_SMALL)
    out = pol.policy_sensitivity(given, steps=(0.1, 0.0, -0.5))
    assert "Exchange" not in plan_of(out) and "Window" not in plan_of(out)
    rows = out.collect()
    assert len(rows) == given.count() * 5 * 3
    base = {r.policy_id: r for r in pol.policy_outcomes(given).collect()}
    for key, points in itertools.groupby(sorted(rows, key=lambda r: (r.policy_id, r.variable, r.step)), lambda r: (r.policy_id, r.variable)):
        points = list(points)
        assert [p.step for p in points] == [-0.5, 0.0, 0.1] and points[0].change is None
        assert [p.change for p in points[1:]] == [b.revenue - a.revenue for a, b in zip(points, points[1:])]
        assert (points[1].demand, points[1].revenue) == (base[key[0]].demand, base[key[0]].revenue)


def test_best_policies_keep_ties(spark):
    rows = [(1, "bus", 5.0), (2, "bus", 7.0), (3, "bus", 7.0), (4, "metro", 1.0), (5, "metro", None)]
    scored = spark.createDataFrame(rows, "policy_id long, service string, revenue double").withColumn(
        "congestion", F.when(F.col("policy_id") == 1, 0.71).otherwise(0.655))
    best = {(r.service, r.band): (r.revenue, r.ties, r.first_policy, r.last_policy) for r in pol.policy_best(scored).collect()}
    assert best == {("bus", 71): (5.0, 1, 1, 1), ("bus", 65): (7.0, 2, 2, 3), ("metro", 65): (1.0, 1, 4, 4)}
    ties = sorted((r.service, r.band, r.policy_id) for r in pol.policy_best_rows(scored).collect())
    assert ties == [("bus", 65, 2), ("bus", 65, 3), ("bus", 71, 1), ("metro", 65, 4)]


@pytest.mark.parametrize("parts", [1, 5])
def test_frontier_equals_brute_force(spark, parts):
    import random
    rng = random.Random(parts)
    points = [(i, float(rng.randint(0, 12)), float(rng.randint(0, 12))) for i in range(60)]
    points += [(100, 12.0, None), (101, None, 3.0), (102, *points[0][1:])]
    rows = spark.createDataFrame(points, "policy_id long, revenue double, demand double").repartition(parts)
    whole = [p for p in points if None not in p]
    want = sorted(p[0] for p in whole if not any(
        q[1] >= p[1] and q[2] >= p[2] and q[1:] != p[1:] for q in whole))
    out = pol.pareto_frontier(rows)
    assert sorted(r.policy_id for r in out.collect()) == want
    assert "CartesianProduct" not in plan_of(out) and "NestedLoop" not in plan_of(out)
    assert pol.pareto_frontier(rows.limit(0)).count() == 0


def test_frontier_works_no_outcome_out_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def worked_out(a):
        seen.add(1)
        return float(a)

    one = F.udf(worked_out, "double")
    given = spark.range(500).select("id", F.pmod("id", F.lit(37)).alias("a"), (F.lit(100) - F.pmod("id", F.lit(37))).alias("b"))
    out = pol.pareto_frontier(given.select("id", one("a").alias("revenue"), F.col("b").cast("double").alias("demand")))
    assert out.count() == 500 and seen.value == 500
    assert "pow" not in plan_of(QUERIES["policy_pareto"](spark, SF_SMALL)).lower()


# ---------------------------------------------------------- distinct sensors

def test_bitmaps_over_many_blocks(spark):
    """More sensors than a block holds, null sensors and times; every level equals a count of raw rows."""
    rows = spark.range(90_000).select(
        F.concat(F.lit("C"), F.col("id") % 2).alias("city_id"), F.lit("T").alias("sensor_type"),
        F.when(F.col("id") % 10 != 3, F.concat(F.lit("S"), F.col("id") % 80_001)).alias("sensor_id"),
        F.when(F.col("id") % 7 != 0, F.timestamp_add("HOUR", (F.col("id") % 50).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))).alias("event_timestamp"))
    hours = sensor_bitmaps(rows, sensor_codes(rows))
    assert hours.select("bucket").distinct().count() > 2
    got = {(r.level, r.city_id, r.sensor_type, r.period): r.unique_sensors for r in unique_sensor_levels(hours).collect()}
    count = F.count_distinct("sensor_id").alias("n")
    assert got["all", None, None, None] == rows.agg(count).first().n
    for r in rows.groupBy("city_id", F.to_date("event_timestamp").cast("string").alias("d")).agg(count).collect():
        assert got["day", r.city_id, "T", r.d] == r.n
    both = distinct_sensors(rolled_up(hours, ["city_id"]), ["city_id"]).collect()
    assert {r.city_id: r.unique_sensors for r in both} == {r.city_id: r.n for r in rows.groupBy("city_id").agg(count).collect()}
    none = sil(spark, SF_SMALL).limit(0)
    assert [tuple(r) for r in unique_sensor_levels(sensor_bitmaps(none, sensor_codes(none))).collect()] == [("all", None, None, None, 0)]


# ------------------------------------------------------- layout on two keys

def test_interleaved_bits(spark):
    pairs = [(x, y) for x in range(8) for y in range(8)]
    rows = spark.createDataFrame(pairs, "x int, y int").withColumn("z", z_value([F.col("x"), F.col("y")], bits=3))
    for r in rows.collect():
        assert r.z == sum(((r.x >> b & 1) << (2 * b + 1)) | ((r.y >> b & 1) << (2 * b)) for b in range(3))


def test_files_are_skipped_for_either_key(spark, tmp_dir):
    rows = spark.range(40_000).select("id", F.format_string("c%03d", F.xxhash64("id") % 100 + 100).alias("city"),
                                      (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000))).alias("at"))
    rows = rows.unionByName(spark.createDataFrame([(-1, None, 5), (-2, "c150", None)], "id long, city string, at long"))
    path = f"{tmp_dir}/z"
    table = write_zordered(rows, path, ["city", "at"], files=32)
    files = len(set(r.f for r in table.read().select(F.input_file_name().alias("f")).distinct().collect()))
    assert table.read().count() == 40_002 and files >= 24
    for wanted in ({"city": ("c100", "c105")}, {"at": (9_000, None)}, {"city": ("c150", "c150"), "at": (None, 700)}):
        got = read_zordered(spark, path, wanted)
        where = F.lit(True)
        for k, (low, high) in wanted.items():
            where &= (F.col(k) >= F.lit(low)) if low is not None else F.lit(True)
            where &= (F.col(k) <= F.lit(high)) if high is not None else F.lit(True)
        assert sorted(r.id for r in got.collect()) == sorted(r.id for r in rows.filter(where).collect())
        assert len(matching_files(spark, path, wanted)) <= files // 2
    assert read_zordered(spark, path, {"at": (20_000, None)}).count() == 0
    assert key_cuts(rows.limit(0), ["city"]) == {"city": []}


# -------------------------------------------------------------------- models

def test_distinct_inputs_score_like_every_row(spark):
    feats = pol.policy_features(policies(spark, SF_SMALL))
    model = ml.fit_demand_model(QUERIES["demand_features"](spark, SF_SMALL), {"numTrees": 4, "maxDepth": 4})
    doubled = feats.unionAll(feats)
    plain = sorted((r.policy_id, r.service, r.prediction) for r in model.transform(doubled).collect())
    assert sorted((r.policy_id, r.service, r.demand) for r in ml.score_policies(model, doubled).collect()) == plain
    holed = feats.withColumn("price", F.when(F.col("policy_id") != 1, F.col("price")))
    with pytest.raises(Exception, match="lacks a feature"):
        ml.score_policies(model, holed).collect()


def test_types_of_the_signature_are_compared(spark, tmp_dir):
    train = QUERIES["demand_features"](spark, SF_SMALL)
    model = ml.fit_demand_model(train, {"numTrees": 2, "maxDepth": 2})
    ml.save_model(model, f"{tmp_dir}/m", ml.signature(train))
    ml.save_model(model, f"{tmp_dir}/m", {"price": "double"}, overwrite=False)          # another job was first
    types = ml.load_signature(spark, f"{tmp_dir}/m")
    assert types == ml.signature(train) and ml.load_model(spark, f"{tmp_dir}/m").stages
    feats = pol.policy_features(policies(spark, SF_SMALL))
    assert ml.score_policies(model, feats, types).count() == feats.count()
    assert ml.score_policies(model, feats.withColumn("price", F.col("price").cast("float")), types).columns
    for column, kind in (("price", "string"), ("festival", "double"), ("holiday", "boolean")):
        with pytest.raises(ValueError, match=column):
            ml.score_policies(model, feats.withColumn(column, F.col(column).cast(kind)), types)
    with pytest.raises(ValueError, match="missing"):
        ml.score_policies(model, feats.drop("price"), types)


def test_forest_over_cells_is_the_forest_over_rows(spark):
    """Without draws the cells give the tree that Spark ML grows on the rows; with draws each tree's rows are whole."""
    import numpy as np
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import RandomForestRegressor

    rng = np.random.default_rng(3)
    data = [(int(i), *[float(x) for x in rng.integers(0, 12, 4)], int(rng.integers(2)), int(rng.integers(2)), float(rng.normal()))
            for i in range(3000)]
    train = (spark.createDataFrame(data, ["id", *ml.DEMAND_FEATURES, "noise"])
             .withColumn("demand", F.col("price") * F.col("price") + F.col("population") * F.col("holiday") + F.col("noise")))
    p = {**ml.DEFAULT_PARAMS, "numTrees": 30, "maxDepth": 4}
    rows = ml.training_rows(train, "demand")
    bins = ml.feature_bins(rows, p["maxBins"], p["seed"])
    cells = ml.drawn_cells(rows, bins, p)
    sums = cells.agg(*[F.sum(f"w_{t}") for t in range(30)]).first()
    assert len(set(sums)) > 20 and all(2700 < x < 3300 for x in sums)
    # one weight of 1 for each row: the same tree
    whole = bins.transform(rows).groupBy(*ml.BINS).agg(F.count("y").cast("double").alias("w"), F.avg("y").alias("y"))
    ours = ml.demand_pipeline({**p, "numTrees": 1}, "y", "w").fit(whole)
    plain = RandomForestRegressor(labelCol="demand", numTrees=1, maxDepth=4, bootstrap=False, featureSubsetStrategy="all", seed=42)
    assembled = VectorAssembler(inputCols=ml.DEMAND_FEATURES, outputCol="features").transform(train)
    theirs = {r.id: r.prediction for r in plain.fit(assembled).transform(assembled).collect()}
    for r in ours.transform(bins.transform(train)).collect():
        assert r.prediction == pytest.approx(theirs[r.id], rel=1e-9)
    # a forest predicts the mean of its trees
    model = ml.fit_demand_model(train, {"numTrees": 5, "maxDepth": 3})
    got = model.transform(train).select("features", "prediction").first()
    assert got.prediction == pytest.approx(sum(t.predict(got.features) for t in model.stages[-1].trees) / 5, rel=1e-12)
    # each of the forest's inputs is judged once, as its rows would be
    t = ml.holdout_flag(["id"])
    y = model.transform(train.filter(t)).collect()
    judged = {r.metric: r.value for r in ml.evaluation(model, train, ["id"]).collect()}
    assert judged["test_rows"] == len(y)
    assert judged["rmse"] == pytest.approx((sum((r.prediction - r.demand) ** 2 for r in y) / len(y)) ** 0.5, rel=1e-9)


def test_fitting_reads_the_rows_no_oftener_for_more_trees(spark, tmp_path):
    """Trees are grown on cells: the rows' formula is worked out once, whatever the number of trees and levels."""
    seen = str(tmp_path / "asked")

    def asked(p):
        with open(seen, "ab") as f:
            f.write(b".")
        return float(p)

    train = QUERIES["demand_features"](spark, SF_SMALL).limit(400).withColumn("demand", F.udf(asked, "double")("demand"))
    ml.fit_demand_model(train, {"numTrees": 6, "maxDepth": 5})
    assert os.path.getsize(seen) == 400
    with pytest.raises(Exception, match="lacks a feature or its label"):
        ml.fit_demand_model(train.withColumn("price", F.when(F.col("price") > 20, F.col("price"))), {"numTrees": 1, "maxDepth": 1})


def test_edges_of_bins():
    assert ml.edges([2.0, 1.0, 1.0, 4.0], 4) == [1.5, 3.0] and ml.edges([7.0], 4) == [] == ml.edges([], 4)
    cut = ml.edges([float(i % 100) for i in range(1000)], 10)
    assert len(cut) == 9 and cut[0] == 9.5
