"""Stored-table layout: pushdown into the scan, clustered files, comments, cache, rerun."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanlake.operators import serving as sv
from urbanlake.operators.gold import write_clustered
from urbanlake.plans.catalog import QUERIES, gh, sil
from urbanlake.sources.tables import TableCache, table_comment
from urbanlake.sources.versions import read_stored
from urbanlake.streaming.refresh import TablePaths, refresh


def test_city_filter_reaches_parquet_scan(spark, tmp_dir):
    path = f"{tmp_dir}/gold_hour"
    write_clustered(gh(spark, SF_SMALL), path, ["city_id", "sensor_type"])
    df = sv.city_rows(spark.read.parquet(path), "C0").select("event_hour", "avg_vehicles")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(city_id), EqualTo(city_id,C0)]" in plan
    assert "ReadSchema: struct<city_id:string,event_hour:timestamp_ntz,avg_vehicles:double>" in plan


def test_clustered_files_hold_narrow_key_ranges(spark, tmp_dir):
    path = f"{tmp_dir}/silver"
    write_clustered(sil(spark, SF_SMALL), path, ["sensor_type", "city_id"], files=8)
    per_file = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
                .agg(F.countDistinct("sensor_type").alias("types")).collect())
    assert len(per_file) >= 4
    assert max(r.types for r in per_file) <= 2


def test_refresh_writes_comments_and_processing_time(spark, tmp_dir):
    from urbanlake.plans.catalog import sr
    from urbanlake.sources.csv import write_bronze_csv

    p = TablePaths(tmp_dir)
    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), p.source)
    refresh(spark, p.source, tmp_dir)
    assert table_comment(read_stored(spark, p.gold_day)) == "Daily metrics per city and sensor type"
    assert spark.read.parquet(p.silver).filter(F.col("processed_at").isNull()).count() == 0
    cache = TableCache(spark, ttl_s=300)
    a = cache.get(p.gold_day)
    assert cache.get(p.gold_day) is a and a.is_cached
    cache.clear()


def test_overwrite_rerun_is_idempotent(spark):
    a = QUERIES["city_data_roundtrip"](spark, SF_SMALL).count()
    b = QUERIES["city_data_roundtrip"](spark, SF_SMALL).count()
    assert a == b == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_default_city(spark):
    assert sv.default_city(gh(spark, SF_SMALL)).first().city_id == "C0"


def test_cli_refresh_and_score(spark, tmp_dir):
    import subprocess
    import sys

    from conftest import ROOT
    from urbanlake.cli import main
    from urbanlake.plans.catalog import policies, sr
    from urbanlake.sources.csv import write_bronze_csv

    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), f"{tmp_dir}/src")
    assert main(["refresh", "--source", f"{tmp_dir}/src", "--base", f"{tmp_dir}/lake", "--scale", "2"]) == 0
    assert read_stored(spark, f"{tmp_dir}/lake/gold_day").count() > 0
    policies(spark, SF_SMALL).write.parquet(f"{tmp_dir}/policies")
    assert main(["score", "--policies", f"{tmp_dir}/policies", "--out", f"{tmp_dir}/scored"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/scored").count() == 4 * policies(spark, SF_SMALL).count()
    help_text = subprocess.run([sys.executable, "-m", "urbanlake", "--help"], cwd=ROOT, capture_output=True,
                               text=True, timeout=120).stdout
    assert "refresh" in help_text and "score" in help_text


def test_cli_train_then_score_with_model(spark, tmp_dir):
    from urbanlake.cli import main
    from urbanlake.plans.catalog import QUERIES, policies

    QUERIES["demand_features"](spark, SF_SMALL).write.parquet(f"{tmp_dir}/features")
    assert main(["train", "--features", f"{tmp_dir}/features", "--model", f"{tmp_dir}/model",
                 "--trees", "5", "--depth", "4"]) == 0
    policies(spark, SF_SMALL).write.parquet(f"{tmp_dir}/policies")
    assert main(["score", "--policies", f"{tmp_dir}/policies", "--out", f"{tmp_dir}/scored",
                 "--model", f"{tmp_dir}/model"]) == 0
    scored = spark.read.parquet(f"{tmp_dir}/scored")
    assert scored.count() == 4 * policies(spark, SF_SMALL).count()
    assert scored.filter("demand IS NULL OR revenue IS NULL").count() == 0


def test_refresh_shared_and_separate_passes_agree(spark, tmp_dir):
    from urbanlake.plans.catalog import sr
    from urbanlake.sources.csv import write_bronze_csv

    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), f"{tmp_dir}/src")
    refresh(spark, f"{tmp_dir}/src", f"{tmp_dir}/a", scale=2, shared_pass=True)
    refresh(spark, f"{tmp_dir}/src", f"{tmp_dir}/b", scale=2, shared_pass=False)
    for view in ("gold_hour", "gold_day"):
        a = read_stored(spark, f"{tmp_dir}/a/{view}")
        b = read_stored(spark, f"{tmp_dir}/b/{view}").select(*a.columns)
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dashboard_panels(spark, tmp_dir):
    from urbanlake.operators import serving as sv
    from urbanlake.operators.dashboard import CityDashboard
    from urbanlake.plans.catalog import sr
    from urbanlake.sources.csv import write_bronze_csv

    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), f"{tmp_dir}/src")
    out = refresh(spark, f"{tmp_dir}/src", f"{tmp_dir}/lake", scale=2)
    p = out["paths"]
    dash = CityDashboard(spark, p.gold_hour, p.gold_day, ttl_s=300.0)
    try:
        assert [r.city_id for r in dash.cities().collect()] == ["C0", "C1", "C2", "C3", "C4"]
        latest = dash.latest_metrics("C1").collect()
        assert len(latest) == 1 and latest[0].city_id == "C1"
        full = {r.city_id: r for r in sv.kpi_latest(read_stored(spark, p.gold_hour)).collect()}
        assert latest[0] == full["C1"]
        assert dash.trend("C1", "daily").count() == 7
        assert "C1, latest 24 hourly rows" in dash.insights_text("C1").first().text
        assert dash.breakdown("C2", "daily").count() == 4
        assert "cities: C0, C3" in dash.proposal_context(["C3", "C0"]).first().text
        assert dash.proposal_kpis(["C0"]).first().cities_analyzed == 1
        assert "InMemoryTableScan" in dash.city("C1")._jdf.queryExecution().toString()
    finally:
        dash.close()
    direct = CityDashboard(spark, p.gold_hour, p.gold_day, ttl_s=None)
    plan = direct.city("C1")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(city_id,C1)" in plan
    assert direct.latest_metrics("C1").first() == latest[0]


def test_clustered_write_splits_a_hot_key(spark, tmp_dir):
    from pyspark.sql import functions as F

    hot = spark.range(20000).select(F.lit("HOT").alias("city_id"), F.lit("T").alias("sensor_type"), "id")
    cold = spark.range(200).select(F.concat(F.lit("C"), (F.col("id") % 5).cast("string")).alias("city_id"),
                                   F.lit("T").alias("sensor_type"), "id")
    write_clustered(hot.unionByName(cold), f"{tmp_dir}/skew", ["city_id", "sensor_type"], files=8)
    per_file = (spark.read.parquet(f"{tmp_dir}/skew").groupBy(F.input_file_name().alias("f"))
                .agg(F.count(F.when(F.col("city_id") == "HOT", 1)).alias("hot")).collect())
    assert sum(1 for r in per_file if r.hot > 0) >= 4          # the hot key is spread over several files
    assert spark.read.parquet(f"{tmp_dir}/skew").count() == 20200


def test_sql_over_registered_views(spark, tmp_dir):
    from urbanlake.plans.catalog import sr
    from urbanlake.sources.csv import write_bronze_csv
    from urbanlake.sources.tables import register_views

    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), f"{tmp_dir}/src")
    refresh(spark, f"{tmp_dir}/src", f"{tmp_dir}/lake", scale=2)
    names = register_views(spark, f"{tmp_dir}/lake")
    assert set(names) == {"bronze_sensor_data", "silver_sensor_data", "gold_sensor_metrics_by_city_hour",
                          "gold_sensor_metrics_by_city_day"}
    r = spark.sql("SELECT MIN(event_date) AS start_date, MAX(event_date) AS end_date "
                  "FROM gold_sensor_metrics_by_city_day").first()
    assert r.start_date <= r.end_date
    assert spark.sql("SELECT COUNT(*) AS n FROM silver_sensor_data").first().n == \
        spark.read.parquet(f"{tmp_dir}/lake/silver").count()
    assert len(spark.sql("SELECT * FROM gold_sensor_metrics_by_city_day LIMIT 10").collect()) == 10


def test_clustered_write_with_map_column(spark, tmp_dir):
    from pyspark.sql import functions as F

    df = spark.range(100).select(F.lit("C").alias("city_id"), F.lit("T").alias("sensor_type"),
                                 F.create_map(F.lit("k"), F.col("id")).alias("props"))
    write_clustered(df, f"{tmp_dir}/maps", ["city_id", "sensor_type"], files=2)
    assert spark.read.parquet(f"{tmp_dir}/maps").count() == 100
