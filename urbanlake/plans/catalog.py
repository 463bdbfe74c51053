"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given test tables (through the fixture views) and runs an
operator of the library over the whole table.  Metric measures use exact
fixed-point sums (``M2``/``M6``), so results are independent of partitioning
and can be compared value-for-value with the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.operators import context as ctx
from urbanlake.operators import expectations as dq
from urbanlake.operators import ml
from urbanlake.operators import policy as pol
from urbanlake.operators import serving as sv
from urbanlake.operators import weekly as wk
from urbanlake.operators.gold import (
    DAILY_COLUMNS,
    gold_day,
    gold_from_sensor_hours,
    gold_hour,
    sensor_hours,
    write_clustered,
)
from urbanlake.operators.rollup import sensor_bitmaps, sensor_codes, unique_sensor_levels
from urbanlake.operators.silver import castable_expectations, project_bronze
from urbanlake.operators.zorder import read_zordered, write_zordered
from urbanlake.schemas import BRONZE_COLUMNS
from urbanlake.session import read_table, work_path
from urbanlake.sources.csv import to_bronze_text, write_bronze_csv
from urbanlake.sources.fixtures import (
    OBSERVATION_ORIGIN,
    policy_observations,
    sensor_readings,
    weekly_observations,
)
from urbanlake.sources.headers import start_bronze_mixed
from urbanlake.sources.inference import inferred_types, merged_counts, read_types, type_counts, typed_by
from urbanlake.sources.versions import TableStore, VersionedTable
from urbanlake.streaming import ingest as st
from urbanlake.streaming import merged
from urbanlake.streaming.refresh import start_incremental_gold

M2 = 2
M6 = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str | None = None):
    def deco(fn):
        QUERIES[name or fn.__name__] = fn
        return fn
    return deco


# ----------------------------------------------------------------- inputs

def sr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensor_readings(read_table(spark, sf_dir, "events"))


def sil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.apply_expectations(sr(spark, sf_dir), dq.SILVER_EXPECTATIONS)


def gh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_hour(sil(spark, sf_dir), scale=M2)


def gd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_day(sil(spark, sf_dir), scale=M2)


def wo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_observations(read_table(spark, sf_dir, "lineitem"))


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return policy_observations(read_table(spark, sf_dir, "orders"))


# ------------------------------------------------------- silver and quality

@query()
def silver_projection(spark, sf_dir):
    """Typed rows -> raw text -> silver typing (no rule applied)."""
    text = to_bronze_text(sr(spark, sf_dir), keep=["event_id"])
    return project_bronze(text, processed_at=False, keep=["event_id"])


@query()
def silver(spark, sf_dir):
    return sil(spark, sf_dir)


@query()
def dq_metrics(spark, sf_dir):
    return dq.dq_metrics(sr(spark, sf_dir), dq.SILVER_EXPECTATIONS)


@query()
def quarantine(spark, sf_dir):
    return dq.quarantine(sr(spark, sf_dir), dq.SILVER_EXPECTATIONS)


# -------------------------------------------------------------------- gold

@query("gold_hour")
def gold_hour_q(spark, sf_dir):
    return gh(spark, sf_dir)


@query()
def gold_hour_plain(spark, sf_dir):
    """Hourly gold with plain sums and means, the default of a refresh; rounded, as sums depend on their order."""
    gold = gold_hour(sil(spark, sf_dir))
    rounded = ("avg_vehicles", "total_energy_kwh", "avg_energy_kwh", "avg_occupancy_rate", "avg_noise_level")
    return gold.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in gold.columns])


@query("gold_day")
def gold_day_q(spark, sf_dir):
    return gd(spark, sf_dir)


@query()
def table_counts(spark, sf_dir):
    return sv.sensor_table_counts(sil(spark, sf_dir))


@query()
def gold_date_range(spark, sf_dir):
    return sv.date_range(gd(spark, sf_dir))


@query()
def distinct_cities(spark, sf_dir):
    return sv.distinct_cities(gd(spark, sf_dir))


@query()
def city_list_string(spark, sf_dir):
    return sv.city_list_string(gd(spark, sf_dir))


@query()
def preview_limit(spark, sf_dir):
    return sv.preview(gd(spark, sf_dir), 10)


# ----------------------------------------------------------------- serving

@query()
def city_recent_hourly(spark, sf_dir):
    return sv.city_rows(gh(spark, sf_dir), "C0")


@query()
def kpi_latest_hourly(spark, sf_dir):
    return sv.kpi_latest(gh(spark, sf_dir))


@query()
def kpi_latest_daily(spark, sf_dir):
    return sv.kpi_latest(gd(spark, sf_dir))


@query()
def kpi_latest_hourly_zero(spark, sf_dir):
    """The dashboard variant that shows a change of 0 when there is no positive previous value."""
    return sv.kpi_latest(gh(spark, sf_dir), no_change_value=0.0)


@query()
def kpi_change_by_type(spark, sf_dir):
    return sv.kpi_change_by_type(gd(spark, sf_dir))


@query()
def trend_hourly(spark, sf_dir):
    return sv.trend(gh(spark, sf_dir), 168)


@query()
def trend_daily_7(spark, sf_dir):
    return sv.trend(gd(spark, sf_dir), 7)


@query()
def trend_daily_30(spark, sf_dir):
    return sv.trend(gd(spark, sf_dir), 30)


@query()
def recent_summary_hourly(spark, sf_dir):
    return sv.recent_summary(gh(spark, sf_dir), 24, mean_scale=M6, sum_scale=M2)


@query()
def recent_summary_daily(spark, sf_dir):
    return sv.recent_summary(gd(spark, sf_dir), 24, mean_scale=M6, sum_scale=M2)


@query()
def breakdown_sensor_type(spark, sf_dir):
    return sv.breakdown_by_sensor_type(gh(spark, sf_dir), mean_scale=M6, sum_scale=M2)


@query()
def breakdown_sensor_type_daily(spark, sf_dir):
    return sv.breakdown_by_sensor_type(gd(spark, sf_dir), mean_scale=M6, sum_scale=M2)


@query()
def comparison_city_type(spark, sf_dir):
    return sv.comparison_by_city_type(gd(spark, sf_dir), ["C0", "C1", "C2"], mean_scale=M6)


@query()
def city_profile(spark, sf_dir):
    return sv.city_profile(gd(spark, sf_dir), mean_scale=M6)


@query()
def city_profile_json(spark, sf_dir):
    """The JSON text per city, parsed back into its four fields (lossless round trip)."""
    js = sv.city_profile_json(gd(spark, sf_dir), mean_scale=M6)
    parsed = F.from_json("metrics_json", sv.PROFILE_JSON_SCHEMA)
    return js.select("city_id", *[parsed[k].alias(k) for k, _ in sv.PROFILE_JSON_KEYS])


@query()
def context_kpis(spark, sf_dir):
    return sv.context_kpis(gd(spark, sf_dir), ["C0", "C1"], mean_scale=M6)


@query()
def recent_summary_text(spark, sf_dir):
    return ctx.recent_summary_text(sv.recent_summary(gh(spark, sf_dir), 24, mean_scale=M6, sum_scale=M2), "hourly")


@query()
def recent_summary_text_daily(spark, sf_dir):
    """The daily summary block (no peak line: the daily table has no max_vehicles)."""
    return ctx.recent_summary_text(sv.recent_summary(gd(spark, sf_dir), 24, mean_scale=M6, sum_scale=M2), "daily")


@query()
def proposal_context_text(spark, sf_dir):
    """Metric block of the proposal view for the selected cities (C0, C1)."""
    selected = sv.select_cities(gd(spark, sf_dir), ["C0", "C1"])
    return ctx.proposal_context_text(sv.city_profile(selected, mean_scale=M6))


@query()
def city_context_text(spark, sf_dir):
    return ctx.city_context_text(sv.city_profile(gd(spark, sf_dir), mean_scale=M6))


# ------------------------------------------------------- weekly demand table
WO_KEYS = ["l_orderkey", "l_linenumber"]


@query("weekly_spine")
def weekly_spine_q(spark, sf_dir):
    """Sundays x services over the weeks the line items cover."""
    return wk.weekly_spine_over(read_table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("calendar_flags")
def calendar_flags_q(spark, sf_dir):
    return wk.calendar_flags(wo(spark, sf_dir), "obs_date", OBSERVATION_ORIGIN)


@query("city_state_features")
def city_state_features_q(spark, sf_dir):
    return wk.city_state_features(wo(spark, sf_dir), WO_KEYS).select(*WO_KEYS, "population", "congestion", "signal_load")


def weekly_table(spark, sf_dir):
    return wk.elastic_demand_table(wo(spark, sf_dir), WO_KEYS)


@query("elastic_demand")
def elastic_demand_q(spark, sf_dir):
    return weekly_table(spark, sf_dir).select(*WO_KEYS, "service", "price", "demand", "revenue")


@query("demand_features")
def demand_features_q(spark, sf_dir):
    return wk.demand_features(weekly_table(spark, sf_dir), WO_KEYS)


@query()
def city_data_roundtrip(spark, sf_dir):
    """The weekly table written as a stored table (overwrite) and read back."""
    table = wk.city_data(weekly_table(spark, sf_dir), OBSERVATION_ORIGIN, keys=WO_KEYS)
    return wk.save_table(table, work_path(spark, "city_data"))


# ---------------------------------------------------------- policy scoring

@query("policy_unpivot")
def policy_unpivot_q(spark, sf_dir):
    return pol.policy_unpivot(policies(spark, sf_dir))


@query("policy_features")
def policy_features_q(spark, sf_dir):
    return pol.policy_features(pol.validate_policies(policies(spark, sf_dir)))


def scored_elastic(spark, sf_dir):
    return pol.score_elastic(pol.policy_features(pol.validate_policies(policies(spark, sf_dir))))


@query()
def policy_score_elastic(spark, sf_dir):
    return scored_elastic(spark, sf_dir)


@query("policy_totals")
def policy_totals_q(spark, sf_dir):
    return pol.policy_totals(scored_elastic(spark, sf_dir), demand_scale=4, revenue_scale=2)


@query("policy_sensitivity")
def policy_sensitivity_q(spark, sf_dir):
    """One input of every policy changed at a time."""
    return pol.policy_sensitivity(pol.validate_policies(policies(spark, sf_dir)))


@query("policy_best")
def policy_best_q(spark, sf_dir):
    feats = pol.policy_features(pol.validate_policies(policies(spark, sf_dir)))
    return pol.policy_best(pol.score_elastic(feats, keep=["congestion"]))


@query()
def policy_best_ties(spark, sf_dir):
    """All policies that reach the best revenue of a service and congestion band."""
    feats = pol.policy_features(pol.validate_policies(policies(spark, sf_dir)))
    return pol.policy_best_rows(pol.score_elastic(feats, keep=["congestion"]))


@query()
def policy_pareto(spark, sf_dir):
    """Policies whose total revenue and total demand no other policy beats."""
    return pol.pareto_frontier(pol.policy_outcomes(pol.validate_policies(policies(spark, sf_dir))))


# ------------------------------------------------------------- demand model

def demand_model(spark, sf_dir):
    """The model that scores: fitted on all rows."""
    return ml.fit_or_load(spark, demand_features_q(spark, sf_dir))


@query()
def demand_split_metrics(spark, sf_dir):
    return ml.split_metrics(demand_features_q(spark, sf_dir), WO_KEYS)


@query()
def demand_model_metrics(spark, sf_dir):
    """A model fitted on the training part, judged on the other."""
    feats = demand_features_q(spark, sf_dir)
    return ml.evaluation(ml.fit_or_load(spark, feats.filter(~ml.holdout_flag(WO_KEYS))), feats, WO_KEYS)


@query("model_card")
def model_card_q(spark, sf_dir):
    return ml.model_card(spark, demand_model(spark, sf_dir))


@query()
def policy_score_rf(spark, sf_dir):
    feats = pol.policy_features(pol.validate_policies(policies(spark, sf_dir)))
    return ml.score_policies(demand_model(spark, sf_dir), feats)


@query()
def policy_score_rf_summary(spark, sf_dir):
    """Per service: scored policies, and how many of them break what every prediction keeps to.

    A forest's demand lies within the labels it was fitted on, and the revenue
    is the demand times the price that the policy asks for the service, taken
    from the policies themselves.
    """
    feats = pol.policy_features(pol.validate_policies(policies(spark, sf_dir)))
    labels = demand_features_q(spark, sf_dir).agg(F.min("demand").alias("low"), F.max("demand").alias("high")).first()
    scored = ml.score_policies(demand_model(spark, sf_dir), feats)
    asked = pol.policy_unpivot(policies(spark, sf_dir))
    rows = scored.join(asked, ["policy_id", "service"])
    outside = ~F.col("demand").between(labels.low * (1 - 1e-9), labels.high * (1 + 1e-9))
    uneven = F.abs(F.col("revenue") - F.col("demand") * F.col("price")) > 1e-6 * F.abs(F.col("revenue"))
    return rows.groupBy("service").agg(F.count(F.lit(1)).alias("policies"), F.count_if(outside).alias("outside"),
                                       F.count_if(uneven).alias("uneven"))


# ------------------------------------------------ streaming and table layout

def _bronze_run(spark, sf_dir):
    """Sensor rows written as raw CSV files, then ingested by the bronze stream."""
    base = work_path(spark, "sensor")
    source = f"{base}/source"
    write_bronze_csv(sr(spark, sf_dir).drop("event_id"), source)
    st.wait(st.start_bronze(spark, source, f"{base}/bronze", f"{base}/bronze_ckpt"))
    return base


@query()
def bronze_stream_ingest(spark, sf_dir):
    base = _bronze_run(spark, sf_dir)
    bronze = spark.read.parquet(f"{base}/bronze")
    return bronze.select(*[F.col(f"`{h}`").alias(n) for h, n, _ in BRONZE_COLUMNS])


RAW_TEXT_HEADER = ["extra", *[h for h, _, _ in reversed(BRONZE_COLUMNS)]]


def _raw_text_run(spark, sf_dir):
    """Sensor rows as a careless exporter writes them, ingested by the bronze stream.

    Columns stand in another order behind one more; counts read ``12.0`` or
    ``12.5``, times carry an offset, numbers are NaN or junk, and some rows have
    a field too few or too many.
    """
    base = work_path(spark, "raw-text")
    kind = F.col("event_id") % 7
    count = (F.when(kind == 1, F.concat(F.col("vehicle_count").cast("string"), F.lit(".0")))
             .when(kind == 2, F.concat(F.col("vehicle_count").cast("string"), F.lit(".5")))
             .when(kind == 3, F.lit("many")).otherwise(F.col("vehicle_count").cast("string")))
    time = F.when(kind == 4, F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss'+03:00'")).otherwise(
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss"))
    text = {"vehicle_count": count, "event_timestamp": time,
            "energy_kwh": F.when(kind == 5, F.lit("NaN")).otherwise(F.col("energy_kwh").cast("string"))}
    fields = [F.col("event_id").cast("string"), *[text.get(n, F.col(n).cast("string")) for _, n, _ in reversed(BRONZE_COLUMNS)]]
    row = F.array(*[F.coalesce(F.concat(F.lit('"'), x, F.lit('"')), F.lit("")) for x in fields])
    row = F.when(F.col("event_id") % 11 == 3, F.slice(row, 1, len(fields) - 2)).when(
        F.col("event_id") % 11 == 5, F.array_append(row, F.lit("surplus"))).otherwise(row)
    line = F.concat_ws(",", row)
    (sr(spark, sf_dir).select(line.alias(",".join(RAW_TEXT_HEADER)))
     .write.option("header", "true").option("quote", "").option("sep", "\u0001").csv(f"{base}/source"))
    st.wait(st.start_bronze(spark, f"{base}/source", f"{base}/bronze", f"{base}/bronze_ckpt"))
    return base


@query()
def silver_raw_text(spark, sf_dir):
    """Careless text typed like well-written one; malformed rows keep what stands in their place."""
    bronze = spark.read.parquet(f"{_raw_text_run(spark, sf_dir)}/bronze")
    rows = bronze.withColumn("event_id", F.get_json_object("_extra", "$.extra").cast("bigint"))
    typed = project_bronze(rows.withColumn("malformed", F.col("_corrupt_record").isNotNull()), processed_at=False,
                           keep=["event_id", "malformed"])
    return typed.select("event_id", "malformed", "vehicle_count", "event_timestamp", "energy_kwh", "noise_level", "sensor_type")


@query()
def castable_metrics(spark, sf_dir):
    """What the silver stream counts as present but not readable, over the same text."""
    base = _raw_text_run(spark, sf_dir)
    counters = st.quality_counters(spark)
    sq = st.wait(st.start_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/silver_ckpt"))
    return spark.createDataFrame(st.stream_dq_metrics(sq, castable_expectations(), counters),
                                 "expectation string, action string, passed bigint, failed bigint")


@query("silver_stream")
def silver_stream_q(spark, sf_dir):
    base = _bronze_run(spark, sf_dir)
    st.wait(st.start_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/silver_ckpt"))
    return spark.read.parquet(f"{base}/silver").drop("processed_at")


@query()
def dq_metrics_stream(spark, sf_dir):
    """Quality counters observed on the silver stream's micro-batches (summed), as a table."""
    base = _bronze_run(spark, sf_dir)
    counters = st.quality_counters(spark)
    sq = st.wait(st.start_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/silver_ckpt"))
    return spark.createDataFrame(st.stream_dq_metrics(sq, counters=counters),
                                 "expectation string, action string, passed bigint, failed bigint")


@query()
def gold_day_incremental(spark, sf_dir):
    """Daily gold kept current by a foreachBatch stream over silver (touched days recomputed)."""
    base = _bronze_run(spark, sf_dir)
    st.wait(st.start_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/silver_ckpt",
                            partition_by_date=True))
    st.wait(start_incremental_gold(spark, f"{base}/silver", f"{base}/gold_day", f"{base}/gold_day_ckpt",
                                   "day", scale=M2))
    return spark.read.parquet(f"{base}/gold_day").select(*DAILY_COLUMNS)


def _sensor_hour_table(spark, sf_dir):
    """Silver reduced once to (city, type, hour, sensor) rows, written to the shared folder."""
    path = work_path(spark, "sensor_hour")
    sensor_hours(sil(spark, sf_dir), scale=M2).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@query()
def gold_hour_shared_pass(spark, sf_dir):
    return gold_from_sensor_hours(_sensor_hour_table(spark, sf_dir), "hour", scale=M2)


@query()
def gold_day_shared_pass(spark, sf_dir):
    return gold_from_sensor_hours(_sensor_hour_table(spark, sf_dir), "day", scale=M2)


@query()
def silver_clustered(spark, sf_dir):
    path = work_path(spark, "silver_clustered")
    write_clustered(sil(spark, sf_dir), path, ["sensor_type", "city_id"])
    return spark.read.parquet(path)


@query()
def mv_refresh_hour(spark, sf_dir):
    """The hourly view materialized twice (second refresh overwrites the first), read back."""
    path = work_path(spark, "gold_hour")
    for _ in range(2):
        write_clustered(gh(spark, sf_dir), path, ["city_id", "sensor_type"])
    return spark.read.parquet(path)


# --------------------------------- views by merging, versions, mixed sources

@query()
def gold_hour_merged(spark, sf_dir):
    """Hourly gold by merging three deliveries of silver into one state; the second one is delivered once more."""
    base = work_path(spark, "merged")
    rows = sil(spark, sf_dir)
    run = "deliveries"
    for i in range(3):
        delivery = rows.filter(F.col("event_id") % 3 == i).drop("event_id")
        delivery.withColumn("event_date", F.to_date("event_timestamp")).write.mode("append").partitionBy("event_date").parquet(f"{base}/silver")
        st.wait(merged.start_merged_gold(spark, f"{base}/silver", base, run, scale=M2))
        merged.publish(spark, base, scale=M2)
    replayed = rows.filter(F.col("event_id") % 3 == 1).drop("event_id")
    merged.merge_batch(spark, base, replayed, 1, run, scale=M2)
    merged.publish(spark, base, scale=M2)
    return VersionedTable(spark, f"{base}/gold_hour").read()


@query()
def city_data_versions(spark, sf_dir):
    """The weekly table in two versions: a reader opened before the second one, and the table after it."""
    store = TableStore(spark, work_path(spark, "store"))
    store.drop("city_data", if_exists=True)
    table = wk.city_data(weekly_table(spark, sf_dir), OBSERVATION_ORIGIN, keys=WO_KEYS)
    store.save("city_data", table.filter("service <> 'water'"))
    before = store.read("city_data")
    store.save("city_data", table)
    columns = [*WO_KEYS, "week", "service", "price", "demand", "revenue"]
    return (before.select(F.lit(1).alias("version"), *columns)
            .unionAll(store.read("city_data").select(F.lit(2).alias("version"), *columns)))


#: Headers of the files that each third of the rows is written with: other orders, one column more, one less.
MIXED_HEADERS = [
    [h for h, _, _ in BRONZE_COLUMNS],
    ["Cihaz", *[h for h, _, _ in reversed(BRONZE_COLUMNS)]],
    [h for h, _, _ in sorted(BRONZE_COLUMNS, key=lambda c: c[1]) if h != "kWh"],
]


@query()
def bronze_mixed_headers(spark, sf_dir):
    """Files of one folder in three header orders; the third kind arrives when the stream has run."""
    base = work_path(spark, "mixed")
    text = to_bronze_text(sr(spark, sf_dir), keep=["event_id"]).withColumn("Cihaz", F.col("event_id").cast("string"))
    for i, header in enumerate(MIXED_HEADERS):
        rows = text.filter(F.col("event_id") % 3 == i).select(*[F.col(f"`{h}`") for h in header])
        rows.write.mode("append").option("header", "true").csv(f"{base}/source")
        if i:
            st.wait(start_bronze_mixed(spark, f"{base}/source", f"{base}/bronze", f"{base}/ckpt"))
    bronze = spark.read.parquet(f"{base}/bronze")
    device = F.get_json_object("_extra", "$.Cihaz").cast("bigint").alias("device")
    return bronze.select(*[F.col(f"`{h}`").alias(n) for h, n, _ in BRONZE_COLUMNS], device,
                         F.col("_corrupt_record").isNotNull().alias("malformed"))


@query()
def bronze_inferred_types(spark, sf_dir):
    """Counts of what the raw columns read as, added over three batches, and the types that follow."""
    text = to_bronze_text(sr(spark, sf_dir), keep=["event_id"])
    columns = [h for h, _, _ in BRONZE_COLUMNS]
    batches = [type_counts(text.filter(F.col("event_id") % 3 == i), columns) for i in range(3)]
    return inferred_types(merged_counts(batches))


@query()
def bronze_typed_rescue(spark, sf_dir):
    """Raw text read by the types that the first third of the rows shows; what later ones break is rescued."""
    text = to_bronze_text(sr(spark, sf_dir), keep=["event_id"])
    count, speed = "Araç Sayısı", "kWh"
    text = (text.withColumn(count, F.when(F.col("event_id") % 6 == 4, F.concat(F.col(f"`{count}`"), F.lit(" adet"))).otherwise(F.col(f"`{count}`")))
            .withColumn(speed, F.when(F.col("event_id") % 6 == 5, F.lit("yok")).otherwise(F.col(f"`{speed}`"))))
    types = read_types(type_counts(text.filter(F.col("event_id") % 3 == 0), [count, speed, "Tarih/Zaman", "Sensör Tipi"]))
    typed = typed_by(text, types, keep=["event_id"])
    rescued = F.from_json("_rescued", "map<string,string>")
    return typed.select("event_id", F.col(f"`{count}`").alias("vehicle_count"), F.col(speed).alias("energy_kwh"),
                        F.col("`Tarih/Zaman`").alias("event_timestamp"), F.col("`Sensör Tipi`").alias("sensor_type"),
                        rescued[count].alias("rescued_count"), rescued[speed].alias("rescued_kwh"))


@query()
def dq_metrics_by_batch(spark, sf_dir):
    """Quality counters kept with each micro-batch, summed: two runs of one stream over two deliveries."""
    base = work_path(spark, "counted")
    rows = sr(spark, sf_dir)
    for i in range(2):
        write_bronze_csv(rows.filter(F.col("event_id") % 2 == i).drop("event_id"), f"{base}/source", files=2)
        st.wait(st.start_bronze(spark, f"{base}/source", f"{base}/bronze", f"{base}/bronze_ckpt"))
        st.wait(st.start_counted_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/counts", f"{base}/silver_ckpt"))
    by_batch = st.batch_metrics(spark, f"{base}/counts")
    return by_batch.groupBy("expectation", "action").agg(
        F.sum("passed").alias("passed"), F.sum("failed").alias("failed"), F.sum("rows").alias("rows"),
        F.count_distinct("run", "batch").alias("batches"))


@query()
def unique_sensors_rollup(spark, sf_dir):
    """Distinct sensors of hours, days, cities and types, each level from the bitmaps of the one below."""
    rows = sil(spark, sf_dir)
    return unique_sensor_levels(sensor_bitmaps(rows, sensor_codes(rows)))


@query()
def silver_zorder(spark, sf_dir):
    """Silver along a curve of city and time, read back by a range of each key alone and of both."""
    path = work_path(spark, "silver_zorder")
    write_zordered(sil(spark, sf_dir), path, ["city_id", "event_timestamp"], files=16)
    days = (F.lit("2024-01-08").cast("timestamp_ntz"), F.lit("2024-01-14").cast("timestamp_ntz"))
    asked = {"city": {"city_id": ("C1", "C2")}, "time": {"event_timestamp": days}, "both": {"city_id": ("C1", "C2"), "event_timestamp": days}}
    out = None
    for name, wanted in asked.items():
        rows = read_zordered(spark, path, wanted).select(F.lit(name).alias("asked"), "event_id", "city_id", "event_timestamp")
        out = rows if out is None else out.unionAll(rows)
    return out
