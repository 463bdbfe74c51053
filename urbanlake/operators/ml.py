"""Demand model: a Spark ML random forest on the six weekly features.

Training is distributed and passes the rows only a few times, whatever the number
of trees and levels: a tree sees no more of a row than the bin of each feature,
so every row draws how often each tree takes it (a Poisson number, as in
``RandomForestRegressor``), and the rows of a cell (a combination of bins) come
down to a weight and a mean label for each tree.  Spark ML grows each tree over
the cells, whose number is bounded by the bins; the splits and leaves are those
of the rows, as what labels differ by within a cell is the same on either side of any
split.  Scoring predicts each distinct feature vector of
a policies table once and joins the predictions back.  The fitted
pipeline is saved under the shared checkpoint folder (never on a machine-local
disk) and loaded back by path, so a lost executor or a new process only
re-reads it.
"""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections import Counter
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.functions.measures import fixed_sum
from urbanlake.schemas import DEMAND_FEATURES
from urbanlake.session import ensure_checkpoint_dir, work_path

#: ``maxMemoryInMB`` is what each task holds for its statistics: trees that need more are grown in further passes.
DEFAULT_PARAMS = {"numTrees": 100, "maxDepth": 10, "maxBins": 32, "featureSubsetStrategy": "all",
                  "subsamplingRate": 1.0, "maxMemoryInMB": 256, "seed": 42}


#: Rows from whose values the bins' edges are taken, and groups of equal rows that one task draws for.
EDGE_ROWS, GROUPS = 100_000, 1_000_000
#: Rows of cells in a partition that trees are grown on.
CELL_ROWS = 50_000

BINS = [f"bin_{f}" for f in DEMAND_FEATURES]


def demand_pipeline(params: dict | None = None, label: str = "demand", weight: str | None = None) -> Pipeline:
    """The forest's estimator on binned features; ``weight`` names a column with a row's drawn weight (no further draws)."""
    p = {**DEFAULT_PARAMS, **(params or {})}
    drawn = {} if weight is None else {"weightCol": weight, "bootstrap": False, "subsamplingRate": 1.0}
    assembler = VectorAssembler(inputCols=BINS, outputCol="features", handleInvalid="error")
    rf = RandomForestRegressor(featuresCol="features", labelCol=label, predictionCol="prediction", **{**p, **drawn})
    return Pipeline(stages=[assembler, rf])


def edges(values: list[float], max_bins: int) -> list[float]:
    """Edges of at most ``max_bins`` bins: between all values where they are few, else at even shares of the rows.

    These are the edges that Spark ML's trees choose.
    """
    counted = sorted(Counter(values).items())
    middles = [(a + b) / 2 for (a, _), (b, _) in zip(counted, counted[1:])]
    if len(middles) < max_bins:
        return sorted(set(middles))
    stride = len(values) / max_bins
    out, seen, target = [], counted[0][1], stride
    for middle, (_, n) in zip(middles, counted[1:]):
        if abs(seen - target) < abs(seen + n - target):
            out.append(middle)
            target += stride
        seen += n
    return sorted(set(out))


def training_rows(train: DataFrame, label: str) -> DataFrame:
    """The features and the label ``y`` as numbers, written once; a row that lacks one of them raises.

    The check reads the written rows: pushed below their projections it would
    work out the label's formula again and again.
    """
    path = work_path(train.sparkSession, "model-rows")
    train.select(*[F.col(f).cast("double") for f in DEMAND_FEATURES], F.col(label).cast("double").alias("y")).write.parquet(path)
    rows = train.sparkSession.read.parquet(path)
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in rows.columns]) & (F.abs("y") < F.lit(math.inf))
    return rows.filter(F.when(whole, True).otherwise(F.raise_error(F.lit("a row lacks a feature or its label"))))


def feature_bins(rows: DataFrame, max_bins: int, seed: int) -> Bucketizer:
    """Bins of each feature, with edges from a sample of ``EDGE_ROWS`` rows (all rows where there are fewer)."""
    share = max(EDGE_ROWS, max_bins * max_bins) / max(rows.count(), 1)
    values = rows.select(*DEMAND_FEATURES)
    values = (values if share >= 1 else values.sample(False, share, seed)).collect()
    ends = [edges([r[i] for r in values], max_bins) for i in range(len(DEMAND_FEATURES))]
    splits = [[-math.inf, *(e or [0.0]), math.inf] for e in ends]
    return Bucketizer(splitsArray=splits, inputCols=DEMAND_FEATURES, outputCols=BINS, handleInvalid="error")


def drawn_cells(rows: DataFrame, bins: Bucketizer, params: dict) -> DataFrame:
    """The bins of a cell and, for each tree ``t``, ``w_t, y_t``: how many draws of its rows the tree takes, and their mean label.

    Equal rows of a cell draw together (the sum of n Poisson numbers is one of n
    times the mean).  A cell may have several rows: a tree adds them up.  Draws
    go by task and place in it, and rows are dealt by their values and sorted.
    """
    spark, trees, rate, seed = rows.sparkSession, params["numTrees"], params["subsamplingRate"], params["seed"]
    path = work_path(spark, "model-cells")
    bins.transform(rows).groupBy(*BINS, "y").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/groups")
    groups = spark.read.parquet(f"{path}/groups")
    # groups of labels in a cell; one with more than a task's share is dealt to many
    large = groups.groupBy(*BINS).agg(F.count(F.lit(1)).alias("_labels")).filter(F.col("_labels") > GROUPS).collect()
    hot = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c) == F.lit(r[c]) for c in BINS]) for r in large], F.lit(False))
    parts = max(spark.sparkContext.defaultParallelism, -(-groups.count() // GROUPS))
    dealt = (groups.withColumn("_share", F.when(hot, F.pmod(F.xxhash64("y"), F.lit(parts))).otherwise(F.lit(0)))
             .repartition(parts, *BINS, "_share").drop("_share").sortWithinPartitions(*BINS, "y"))
    names = [f"w_{t}" for t in range(trees)] + [f"y_{t}" for t in range(trees)]

    def draw(batches):
        import numpy as np
        import pyarrow as pa

        rng = np.random.default_rng([seed % 2**63, TaskContext.get().partitionId()])
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells = np.column_stack([batch.column(c).to_numpy() for c in BINS])
            first = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]).any(axis=1)])
            taken = rng.poisson(rate * batch.column("n").to_numpy()[:, None], (batch.num_rows, trees)).astype(float)
            weight = np.add.reduceat(taken, first)
            total = np.add.reduceat(taken * batch.column("y").to_numpy()[:, None], first)
            mean = np.divide(total, weight, out=np.zeros_like(total), where=weight > 0)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*cells[first].T, *weight.T, *mean.T)], names=[*BINS, *names])

    dealt.mapInArrow(draw, ", ".join(f"{c} double" for c in [*BINS, *names])).write.parquet(f"{path}/cells")
    return spark.read.parquet(f"{path}/cells")


def forest_of(spark: SparkSession, trees: list[RandomForestRegressionModel], params: dict, label: str) -> RandomForestRegressionModel:
    """One forest of the given forests' trees, with ``params``."""
    jvm, gateway = trees[0]._java_obj, spark.sparkContext._gateway
    package = gateway.jvm.org.apache.spark.ml.regression
    all_trees = [t._java_obj for m in trees for t in m.trees]
    grown = gateway.new_array(package.DecisionTreeRegressionModel, len(all_trees))
    for i, t in enumerate(all_trees):
        grown[i] = t
    forest = RandomForestRegressionModel(package.RandomForestRegressionModel(jvm.uid(), grown, jvm.numFeatures()))
    given = {p.name: v for p, v in trees[0].extractParamMap().items() if p.name not in ("weightCol", "bootstrap", "leafCol")}
    return forest._set(**{**given, **params, "numTrees": len(all_trees), "labelCol": label})


def holdout_flag(keys: list[str], buckets: int = 5) -> Column:
    """Deterministic 1-in-``buckets`` test flag from the keys' checksum (independent of partitioning and engine)."""
    text = F.concat_ws("-", *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % buckets == 0


def split_metrics(features: DataFrame, keys: list[str], label: str = "demand") -> DataFrame:
    """part, n_rows, sum_label: the two parts that a model is fitted and judged on."""
    part = F.when(holdout_flag(keys), "test").otherwise("train")
    return (features.groupBy(part.alias("part"))
            .agg(F.count(F.lit(1)).alias("n_rows"), fixed_sum(label, 4, wide=True).alias("sum_label")))


def fit_demand_model(train: DataFrame, params: dict | None = None, label: str = "demand") -> PipelineModel:
    """A forest on all rows: bins, draws of the rows by cell, then trees that Spark ML grows side by side over the cells."""
    ensure_checkpoint_dir(train.sparkSession)
    p = {**DEFAULT_PARAMS, **(params or {})}
    rows = training_rows(train, label)
    bins = feature_bins(rows, p["maxBins"], p["seed"])
    cells = drawn_cells(rows, bins, p)
    parts = -(-cells.count() // CELL_ROWS)
    # a single tree would take "auto" for all features
    subset = "onethird" if p["featureSubsetStrategy"] == "auto" and p["numTrees"] > 1 else p["featureSubsetStrategy"]

    def grow(t: int) -> PipelineModel:
        one = {**p, "numTrees": 1, "seed": p["seed"] + t, "featureSubsetStrategy": subset}
        taken = cells.select(*BINS, f"w_{t}", f"y_{t}").filter(F.col(f"w_{t}") > 0).coalesce(max(parts, 1))
        return demand_pipeline(one, f"y_{t}", f"w_{t}").fit(taken)

    with ThreadPool(min(p["numTrees"], train.sparkSession.sparkContext.defaultParallelism)) as pool:
        grown = pool.map(inheritable_thread_target(train.sparkSession)(grow), range(p["numTrees"]), chunksize=1)
    return PipelineModel([bins, grown[0].stages[0], forest_of(train.sparkSession, [m.stages[-1] for m in grown], p, label)])


def signature(features: DataFrame) -> dict[str, str]:
    """Type of each model feature in a table."""
    types = dict(features.dtypes)
    return {f: types.get(f, "missing") for f in DEMAND_FEATURES}


#: Numbers that hold every value of the type on the left.
WIDER = {"tinyint": ("smallint", "int", "bigint", "float", "double"), "smallint": ("int", "bigint", "float", "double"),
         "int": ("bigint", "double"), "float": ("double",)}


def save_model(model: PipelineModel, path: str, types: dict[str, str] | None = None, overwrite: bool = True) -> None:
    """Save a model with the types of its features beside it.

    Both are written aside and put in place by one rename, so a folder of that
    name always holds a whole model.  Without ``overwrite`` a model that
    another job has put there meanwhile stays.
    """
    spark = SparkSession.getActiveSession()
    aside = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    model.write().save(f"{aside}/pipeline")
    rows = list((types or {f: "double" for f in DEMAND_FEATURES}).items())
    spark.createDataFrame(rows, "feature string, type string").coalesce(1).write.parquet(f"{aside}/signature")
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = there(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if store.exists(there(path)):
        if not overwrite:
            store.delete(there(aside), True)
            return
        store.delete(there(path), True)
    if not store.rename(there(aside), there(path)):
        raise OSError(f"can't put the model in place at {path}")


def load_signature(spark: SparkSession, path: str) -> dict[str, str]:
    """Type of each feature that a saved model was fitted on."""
    return {r.feature: r.type for r in spark.read.parquet(f"{path}/signature").collect()}


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    """A saved model; a folder without one, or without its signature, raises."""
    listed = load_signature(spark, path)
    if sorted(listed) != sorted(DEMAND_FEATURES):
        raise ValueError(f"the model at {path} takes {sorted(listed)}, not {DEMAND_FEATURES}")
    return PipelineModel.load(f"{path}/pipeline")


def check_signature(features: DataFrame, expected: dict[str, str] | None = None) -> None:
    """Every model feature must be there as a number, of the type it was fitted on or one that this type holds."""
    found = signature(features)
    if expected is None:
        bad = {f: t for f, t in found.items() if t not in ("double", "float", "int", "bigint", "smallint", "tinyint")}
    else:
        bad = {f: f"{t}, not {expected[f]}" for f, t in found.items() if t != expected[f] and expected[f] not in WIDER.get(t, ())}
    if bad:
        raise ValueError(f"not the model's features: {bad}")


def data_version(features: DataFrame, params: dict | None = None) -> str:
    """Key of a table's rows (their number and the sum of their hashes) and the parameters."""
    seen = features.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*features.columns).cast("decimal(38,0)"))).first()
    blob = json.dumps([seen[0], str(seen[1]), {**DEFAULT_PARAMS, **(params or {})}], sort_keys=True)
    return hashlib.sha1(blob.encode()).hexdigest()[:16]


def _there(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def fit_or_load(spark: SparkSession, features: DataFrame, params: dict | None = None) -> PipelineModel:
    """The model of exactly these rows and parameters: loaded when one is saved, else fitted on all rows and saved.

    The folder is named after the data, so changed rows get a model of their
    own, and another process finds this one.
    """
    check_signature(features)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/urbanlake/models/demand-{data_version(features, params)}"
    if not _there(spark, f"{path}/signature/_SUCCESS"):
        save_model(fit_demand_model(features, params), path, signature(features), overwrite=False)
    return load_model(spark, path)


def _split(model: PipelineModel) -> tuple[PipelineModel, PipelineModel, list[str]]:
    """What comes before the forest's input columns, the forest with their assembly, and these columns."""
    return PipelineModel(model.stages[:-2]), PipelineModel(model.stages[-2:]), model.stages[-2].getInputCols()


def _parts(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def evaluation(model: PipelineModel, features: DataFrame, keys: list[str], label: str = "demand") -> DataFrame:
    """metric, value: rmse, r2 and the constant-mean baseline rmse on the holdout rows, plus row counts.

    Only holdout rows are scored (the forest is not run on the training rows),
    and each input of the forest once: rows with the same input come down to
    their number, mean and variance first.  Training rows contribute their label
    sum and count.  Both are global
    aggregates; their one-row results are stacked and merged with a second
    aggregate, so there is no join and nothing is collected.
    """
    t = holdout_flag(keys)
    y = F.col(label)
    before, forest, given = _split(model)
    # rows that leave the formula of their label behind: binning would otherwise be compiled into one method with it
    path = work_path(features.sparkSession, "model-holdout")
    features.filter(t).select(*DEMAND_FEATURES, y.cast("double").alias("_y")).write.parquet(path)
    known, mean, spread = F.col("_known"), F.col("_mean"), F.col("_spread")
    groups = (before.transform(features.sparkSession.read.parquet(path)).groupBy(*given)
              .agg(F.count(F.lit(1)).alias("_n"), F.count("_y").alias("_known"), F.avg("_y").alias("_mean"), F.var_pop("_y").alias("_spread")))
    far = F.col("prediction") - mean
    test = (forest.transform(groups.repartition(_parts(features.sparkSession), *given))
            .agg(F.sum("_n").alias("n_test"), F.sum(known * mean).alias("sum_y"), F.sum(known * (mean * mean + spread)).alias("sum_y2"),
                 F.sum(known * (far * far + spread)).alias("sse")))
    train = features.filter(~t).agg(F.count(F.lit(1)).alias("n_train"), F.sum(y).alias("sum_train"))
    cols = ["n_test", "sum_y", "sum_y2", "sse", "n_train", "sum_train"]
    s = test.unionByName(train, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in cols])
    n = F.col("n_test").cast("double")
    mean_test = F.col("sum_y") / n
    sst = F.col("sum_y2") - n * mean_test * mean_test
    m_train = F.col("sum_train") / F.col("n_train").cast("double")
    # sum over test rows of (y - m_train)^2
    sse_base = F.col("sum_y2") - F.lit(2.0) * m_train * F.col("sum_y") + n * m_train * m_train
    rows = F.array(
        F.struct(F.lit("rmse").alias("metric"), F.sqrt(F.col("sse") / n).alias("value")),
        F.struct(F.lit("r2").alias("metric"), (F.lit(1.0) - F.col("sse") / sst).alias("value")),
        F.struct(F.lit("baseline_rmse").alias("metric"), F.sqrt(sse_base / n).alias("value")),
        F.struct(F.lit("train_rows").alias("metric"), F.col("n_train").cast("double").alias("value")),
        F.struct(F.lit("test_rows").alias("metric"), n.alias("value")),
    )
    return s.select(F.inline(rows))


def model_card(spark: SparkSession, model: PipelineModel, label: str = "demand") -> DataFrame:
    """name, value: model type, parameters, feature signature and feature importances."""
    rf = model.stages[-1]
    entries = [("model_type", "RandomForest"), ("label", label), ("features", ",".join(DEMAND_FEATURES))]
    entries += [(f"param.{k}", str(rf.getOrDefault(k))) for k in
                ["numTrees", "maxDepth", "maxBins", "featureSubsetStrategy", "subsamplingRate", "seed"]]
    entries += [(f"importance.{f}", repr(float(v))) for f, v in zip(DEMAND_FEATURES, rf.featureImportances.toArray())]
    entries.append(("total_nodes", str(rf.totalNumNodes)))
    return spark.createDataFrame(entries, "name string, value string")


def predict_distinct(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``features`` with ``prediction``: every distinct input of the forest is predicted once, over all cores, and joined back.

    The inputs are a row's bins, so their number is bounded.  They are a written
    table, so they are dealt out evenly and neither the trees nor a lost
    executor cost one twice.
    """
    spark = features.sparkSession
    before, forest, given = _split(model)
    binned = before.transform(features)
    path = work_path(spark, "model-inputs")
    binned.select(*given).distinct().write.parquet(path)
    inputs = spark.read.parquet(path).repartition(_parts(spark), *given)
    done = work_path(spark, "model-outputs")
    forest.transform(inputs).select(*given, "prediction").write.parquet(done)
    return binned.join(spark.read.parquet(done), given).select(*features.columns, "prediction")


def score_policies(model: PipelineModel, features: DataFrame, expected: dict[str, str] | None = None) -> DataFrame:
    """policy_id, service, demand, revenue predicted by the model for every (policy, service) row.

    ``expected``: the types that the model was fitted on (``load_signature``).
    A policy without a feature raises.
    """
    check_signature(features, expected)
    missing = reduce(lambda a, b: a | b, [F.col(f).isNull() for f in DEMAND_FEATURES])
    whole = features.filter(F.when(missing, F.raise_error(F.lit("a policy lacks a feature"))).otherwise(F.lit(True)))
    return (predict_distinct(model, whole)
            .select("policy_id", "service", F.col("prediction").alias("demand"),
                    (F.col("prediction") * F.col("price")).alias("revenue")))
