"""Stream = batch, incremental file pickup, quality counts per micro-batch, incremental gold."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanlake.operators.expectations import SILVER_EXPECTATIONS, apply_expectations, dq_metrics
from urbanlake.operators.gold import gold_day
from urbanlake.operators.silver import project_bronze
from urbanlake.plans.catalog import sr
from urbanlake.sources.csv import CSV_OPTIONS, infer_bronze_schema, read_bronze_batch, read_schema, write_bronze_csv
from urbanlake.sources.versions import read_stored
from urbanlake.streaming import ingest as st
from urbanlake.streaming.refresh import TablePaths, refresh, refresh_gold_incremental


def test_two_file_drops_equal_one_and_rerun_adds_nothing(spark, tmp_dir):
    rows = sr(spark, SF_SMALL)
    first, second = rows.filter(F.col("event_id") < 500), rows.filter(F.col("event_id") >= 500)
    p = TablePaths(tmp_dir)
    write_bronze_csv(first.drop("event_id"), p.source, files=2)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt))
    n1 = spark.read.parquet(p.silver).count()
    write_bronze_csv(second.drop("event_id"), p.source, files=2)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    counters = st.quality_counters(spark)
    sq = st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt))
    out = spark.read.parquet(p.silver).drop("processed_at")
    want = apply_expectations(rows.drop("event_id"), SILVER_EXPECTATIONS)
    assert out.count() == want.count() > n1
    assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0
    # rerun without new files adds nothing
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt))
    assert spark.read.parquet(p.silver).count() == want.count()
    # quality counters of the second run cover the second drop only
    counts = {n: (ps, fl) for n, _, ps, fl in st.stream_dq_metrics(sq, counters=counters)}
    batch2 = {r.expectation: (r.passed, r.failed) for r in dq_metrics(second, SILVER_EXPECTATIONS).collect()}
    assert counts == batch2


def test_bad_text_becomes_null(spark, tmp_dir):
    path = f"{tmp_dir}/bad"
    header = "Şehir ID'si/Adı,Sensör ID'si/Adı,Enlem,Boylam,Tarih/Zaman,Sensör Tipi,Sokak Tipi," \
             "Yakındaki Hizmetler,Araç Sayısı,kWh,Doluluk Oranı,Gürültü Seviyesi"
    lines = [header, 'C1,S1,abc,10,not a date,Trafik Sayacı,Cadde,"Okul, Park",12.5,,,']
    spark.sparkContext.parallelize(["\n".join(lines)], 1).saveAsTextFile(path)
    r = project_bronze(read_bronze_batch(spark, path), processed_at=False).first()
    assert r.latitude is None and r.event_timestamp is None and r.vehicle_count == 12
    assert r.longitude == 10.0 and r.nearby_services == "Okul, Park"
    from urbanlake.operators.silver import castable_expectations

    m = {x.expectation: (x.passed, x.failed) for x in dq_metrics(read_bronze_batch(spark, path),
                                                                castable_expectations()).collect()}
    assert m["castable_latitude"] == (0, 1) and m["castable_event_timestamp"] == (0, 1)
    assert m["castable_vehicle_count"] == (1, 0) and m["castable_longitude"] == (1, 0)
    assert m["castable_energy_kwh"] == (1, 0)          # empty field: missing, not malformed


def test_inferred_types(spark, tmp_dir):
    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), f"{tmp_dir}/src")
    types = {f.name: f.dataType.simpleString() for f in infer_bronze_schema(spark, f"{tmp_dir}/src").fields}
    assert types["Enlem"] == "double" and types["Araç Sayısı"] == "int"
    assert types["Tarih/Zaman"].startswith("timestamp")


def test_refresh_and_incremental_gold(spark, tmp_dir):
    rows = sr(spark, SF_SMALL).drop("event_id")
    p = TablePaths(tmp_dir)
    write_bronze_csv(rows.filter(F.dayofmonth("event_timestamp") <= 15), p.source)
    out = refresh(spark, p.source, tmp_dir, scale=2)
    assert {n for n, *_ in out["dq_metrics"]} == {e.name for e in SILVER_EXPECTATIONS}
    inc = f"{tmp_dir}/gold_day_inc"
    refresh_gold_incremental(spark, p.silver, spark.read.parquet(p.silver), inc, "day", 2)
    # second drop, then incremental refresh of the touched days only
    new = rows.filter(F.dayofmonth("event_timestamp") > 15)
    write_bronze_csv(new, p.source)
    refresh(spark, p.source, tmp_dir, scale=2)
    refresh_gold_incremental(spark, p.silver, new, inc, "day", 2)
    full = gold_day(spark.read.parquet(p.silver), scale=2)
    got = spark.read.parquet(inc).select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    assert read_stored(spark, p.gold_day).count() == full.count()


def test_incremental_refresh_reads_only_touched_days(spark, tmp_dir):
    from urbanlake.streaming.refresh import touched_silver

    rows = sr(spark, SF_SMALL).drop("event_id")
    p = TablePaths(tmp_dir)
    write_bronze_csv(rows, p.source)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt, partition_by_date=True))
    new = rows.filter(F.dayofmonth("event_timestamp") == 3)
    affected = touched_silver(spark, p.silver, new)
    plan = affected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "PartitionFilters: [event_date" in plan \
        or "event_date IN" in plan, plan
    days = {r[0] for r in affected.select(F.to_date("event_timestamp")).distinct().collect()}
    assert len(days) == 1


def test_continuous_query_picks_up_new_files(spark, tmp_dir):
    rows = sr(spark, SF_SMALL).drop("event_id")
    p = TablePaths(tmp_dir)
    write_bronze_csv(rows.filter(F.dayofmonth("event_timestamp") <= 10), p.source, files=2)
    q = st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt, available_now=False, processing_time="1 second",
                        max_files_per_trigger=1)
    try:
        q.processAllAvailable()
        first = spark.read.parquet(p.bronze).count()
        write_bronze_csv(rows.filter(F.dayofmonth("event_timestamp") > 10), p.source, files=2)
        q.processAllAvailable()
        assert spark.read.parquet(p.bronze).count() == rows.count() > first
        assert len([x for x in q.recentProgress if x.numInputRows]) >= 3     # one file per micro-batch
    finally:
        q.stop()


def test_columns_by_name_and_malformed_rows(spark, tmp_dir):
    import pytest

    from urbanlake.schemas import BRONZE_HEADERS

    row = ["C1", "S1", "10", "10", "2024-01-01 00:00:00", "Trafik Sayacı", "Cadde", "Park", "1", "", "", ""]
    cases = {"missing": (BRONZE_HEADERS[:-1], [row[:-1]]), "extra": (BRONZE_HEADERS + ["Extra"], [row + ["x"]]),
             "reordered": (BRONZE_HEADERS[::-1], [row[::-1]]), "empty": (BRONZE_HEADERS, []),
             "mixed": (BRONZE_HEADERS, [row]), "short": (BRONZE_HEADERS, [row, row[:5], row + ["x"]])}
    for name, (header, rows) in cases.items():
        text = "\n".join([",".join(header)] + [",".join(r) for r in rows])
        spark.sparkContext.parallelize([text], 1).saveAsTextFile(f"{tmp_dir}/{name}")
    assert read_bronze_batch(spark, f"{tmp_dir}/empty").count() == 0
    want = [x or None for x in row]
    for name in ("missing", "extra", "reordered"):
        r = read_bronze_batch(spark, f"{tmp_dir}/{name}").first()
        assert [r[h] for h in BRONZE_HEADERS] == want
        assert r["_extra"] == ('{"Extra":"x"}' if name == "extra" else None) and r["_corrupt_record"] is None
    bad = [r["_corrupt_record"] for r in read_bronze_batch(spark, f"{tmp_dir}/short").collect()]
    assert [b is not None for b in bad] == [False, True, True]
    # files of one folder that don't agree on their header fail
    spark.sparkContext.parallelize(["\n".join([",".join(BRONZE_HEADERS[::-1]), ",".join(row)])], 1).saveAsTextFile(f"{tmp_dir}/mixed/b")
    with pytest.raises(Exception):
        spark.read.schema(read_schema(BRONZE_HEADERS)).options(**CSV_OPTIONS).csv([f"{tmp_dir}/mixed", f"{tmp_dir}/mixed/b"]).collect()


def test_restart_after_stop_resumes_without_duplicates(spark, tmp_dir):
    import time

    rows = sr(spark, SF_SMALL).drop("event_id")
    p = TablePaths(tmp_dir)
    write_bronze_csv(rows, p.source, files=6)
    q = st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt, available_now=False, processing_time="2 seconds",
                        max_files_per_trigger=1)
    deadline = time.time() + 120
    while not [x for x in q.recentProgress if x.numInputRows] and time.time() < deadline:
        time.sleep(0.2)
    q.stop()                                   # stopped part-way through the backlog
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))   # resume from the checkpoint
    out = spark.read.parquet(p.bronze)
    assert out.count() == rows.count()
    assert out.distinct().count() == rows.select([F.col(c).cast("string") for c in rows.columns]).distinct().count()


def test_touched_days_apart_and_without_a_day(spark, tmp_dir):
    """Days between the first and the last one that no new row touches stay out; rows without a time are a day of their own."""
    from urbanlake.streaming.refresh import touched_silver

    rows = sr(spark, SF_SMALL).drop("event_id").withColumn(
        "event_timestamp", F.when(F.col("sensor_id") != "S1", F.col("event_timestamp")))
    path = f"{tmp_dir}/silver"
    rows.withColumn("event_date", F.to_date("event_timestamp")).write.partitionBy("event_date").parquet(path)
    for days, without in (([3, 7], False), ([5], True), ([], True)):
        new = rows.filter(F.dayofmonth("event_timestamp").isin(days) | (F.col("event_timestamp").isNull() & F.lit(without)))
        got = touched_silver(spark, path, new)
        assert got.count() == new.count() and got.exceptAll(new.select(got.columns)).count() == 0
        assert "MAX_PRUNED" not in got._jdf.queryExecution().toString()


def test_lost_counters_raise(spark, tmp_dir):
    import pytest

    p = TablePaths(tmp_dir)
    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), p.source)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    counters = st.quality_counters(spark)
    sq = st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt))
    assert sum(ps for _, _, ps, _ in counters.metrics(sq)) > 0
    run = str(sq.runId)
    with counters._lock:
        counters._terminated.discard(run)
    with pytest.raises(TimeoutError):
        counters.metrics(sq, timeout_s=0.3)
    with counters._lock:
        counters._terminated.add(run)
        del counters._totals[run]["valid_latitude__passed"]
    with pytest.raises(RuntimeError, match="valid_latitude"):
        counters.metrics(sq)


def test_silver_files_of_a_day_are_few_and_tables_carry_comments(spark, tmp_dir):
    from urbanlake.sources.tables import TABLES, table_comment

    p = TablePaths(tmp_dir)
    write_bronze_csv(sr(spark, SF_SMALL).drop("event_id"), p.source, files=6)
    out = refresh(spark, p.source, tmp_dir, scale=2, incremental=True)
    silver = spark.read.parquet(p.silver)
    files = silver.select("event_date", F.input_file_name().alias("f")).distinct().groupBy("event_date").count()
    assert files.agg(F.max("count")).first()[0] <= st.FILES_PER_DAY
    assert table_comment(silver) == TABLES["silver"].comment
    assert table_comment(spark.read.parquet(p.bronze)) == TABLES["bronze"].comment
    assert dict((n, f) for n, _, _, f in out["castable_metrics"])["well_formed"] == 0
    full = gold_day(silver, scale=2)
    got = read_stored(spark, p.gold_day).select(*full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_a_failed_view_leaves_the_old_one(spark, tmp_dir):
    import pytest

    from urbanlake.operators.gold import write_clustered

    path = f"{tmp_dir}/view"
    write_clustered(spark.range(10).withColumn("k", F.col("id") % 3), path, ["k"])
    bad = spark.range(10).withColumn("k", F.when(F.col("id") == 7, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("bigint"))
    with pytest.raises(Exception):
        write_clustered(bad, path, ["k"])
    assert spark.read.parquet(path).count() == 10
    write_clustered(spark.range(4).withColumn("k", F.col("id")), path, ["k"])
    assert spark.read.parquet(path).count() == 4


def test_quality_counters_sum_over_many_micro_batches(spark, tmp_dir):
    rows = sr(spark, SF_SMALL).drop("event_id")
    p = TablePaths(tmp_dir)
    write_bronze_csv(rows, p.source, files=5)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    counters = st.quality_counters(spark)
    sq = st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt, max_files_per_trigger=1))
    assert len(counters.batches(sq)) >= 2
    counts = {n: (ps, fl) for n, _, ps, fl in st.stream_dq_metrics(sq, counters=counters)}
    batch = {r.expectation: (r.passed, r.failed) for r in dq_metrics(rows, SILVER_EXPECTATIONS).collect()}
    assert counts == batch


def test_batch_silver_equals_stream_silver(spark, tmp_dir):
    from urbanlake.operators.silver import silver

    rows = sr(spark, SF_SMALL).drop("event_id")
    p = TablePaths(tmp_dir)
    write_bronze_csv(rows, p.source, files=3)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt))
    streamed = spark.read.parquet(p.silver).drop("processed_at")
    batch = silver(read_bronze_batch(spark, p.source), processed_at=False)
    assert batch.columns == streamed.columns
    assert batch.exceptAll(streamed).count() == 0 and streamed.exceptAll(batch).count() == 0


def test_listener_counts_batches_beyond_retained_progress(spark, tmp_dir):
    import pytest

    rows = sr(spark, SF_SMALL).drop("event_id")
    p = TablePaths(tmp_dir)
    write_bronze_csv(rows, p.source, files=6)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    counters = st.quality_counters(spark)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        sq = st.wait(st.start_silver(spark, p.bronze, p.silver, p.silver_ckpt, max_files_per_trigger=1))
        assert len(counters.batches(sq)) >= 3 > len(sq.recentProgress)   # more batches than progress retained
        got = {n: (ps, fl) for n, _, ps, fl in st.stream_dq_metrics(sq, counters=counters)}
        late = st.QualityCounters()                                # not registered when the query started
        with pytest.raises(RuntimeError):
            st.stream_dq_metrics(sq, counters=late)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    batch = {r.expectation: (r.passed, r.failed) for r in dq_metrics(rows, SILVER_EXPECTATIONS).collect()}
    assert got == batch
