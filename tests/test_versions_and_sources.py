"""Versioned tables, views by merging, mixed headers, inferred types, counters by batch."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from urbanlake.operators.expectations import SILVER_EXPECTATIONS, dq_metrics
from urbanlake.operators.gold import gold_day, gold_hour
from urbanlake.plans.catalog import sil, sr
from urbanlake.schemas import BRONZE_HEADERS
from urbanlake.sources.csv import write_bronze_csv
from urbanlake.sources.headers import read_bronze_mixed, start_bronze_mixed
from urbanlake.sources.inference import inferred_types, merged_counts, type_counts, typed_by
from urbanlake.sources.tables import TableCache, register_views
from urbanlake.sources.versions import ConcurrentCommit, TableStore, VersionedTable, read_stored
from urbanlake.streaming import ingest as st
from urbanlake.streaming import merged
from urbanlake.streaming.refresh import TablePaths, refresh


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# ------------------------------------------------------------------ versions

def test_readers_stay_on_their_version(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    assert store.drop("t") is False
    with pytest.raises(ValueError):
        store.drop("t", if_exists=False)
    with pytest.raises(ValueError):
        store.read("t")
    with pytest.raises(ValueError):
        store.table("no/name")
    assert store.save("t", spark.range(10)) == 1
    reader = store.read("t")
    assert store.save("t", spark.range(25)) == 2
    assert (reader.count(), store.read("t").count(), store.read("t", 1).count()) == (10, 25, 10)
    store.register(["t"])
    assert spark.sql("SELECT max(id) AS m FROM t").first().m == 24
    with pytest.raises(Exception):                       # a failed write leaves the table as it was
        store.save("t", spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")))
    assert store.table("t").versions() == [1, 2] and store.read("t").count() == 25
    assert store.drop("t") and not store.table("t").exists()


def test_of_two_writers_one_fails(spark, tmp_dir):
    table = VersionedTable(spark, f"{tmp_dir}/t")
    one = table.commit(spark.range(1))
    table.commit(spark.range(2), base=one)
    with pytest.raises(ConcurrentCommit):
        table.commit(spark.range(3), base=one)
    assert table.read().count() == 2 and table.versions() == [1, 2]


def test_parts_are_replaced_one_by_one(spark, tmp_dir):
    table = VersionedTable(spark, f"{tmp_dir}/t")
    rows = spark.createDataFrame([("a/b", 1), ("a/b", 2), ("c d", 3), (None, 4)], "k string, v int")
    first = table.commit(rows, F.col("k"))
    assert sorted(first.parts) == ["a/b", "c d", "none"]
    second = table.commit(spark.createDataFrame([("c d", 30), ("new", 5)], "k string, v int"), F.col("k"), "touched", gone=["none"])
    assert sorted(r.v for r in table.read().collect()) == [1, 2, 5, 30]
    assert second.parts["a/b"] == first.parts["a/b"] and second.parts["c d"] != first.parts["c d"]
    assert [r.v for r in table.read(parts=["c d"]).collect()] == [30] and table.read(parts=[]).count() == 0
    with pytest.raises(ValueError):
        table.commit(spark.range(1), F.lit("x"), "touched")
    with pytest.raises(ValueError):
        table.commit(rows, None, "touched")
    assert sorted(r.v for r in table.read(1).collect()) == [1, 2, 3, 4]
    assert table.vacuum(keep=2, min_age_s=0) == []
    assert table.vacuum(keep=1, min_age_s=0) == []        # part a/b of version 1 is still in use
    assert table.versions() == [2]
    table.commit(rows, F.col("k"))
    assert len(table.vacuum(keep=1)) == 0 and len(table.vacuum(keep=1, min_age_s=0)) == 2
    assert table.read().count() == 4
    table.commit(rows.limit(0), F.col("k"))
    assert table.read().count() == 0 and table.read().columns == ["k", "v"]


def test_cached_results_follow_the_version(spark, tmp_dir):
    path, made = f"{tmp_dir}/t", []
    table = VersionedTable(spark, path)
    table.commit(spark.range(4))
    cache = TableCache(spark, ttl_s=300)

    def panel(t):
        made.append(1)
        return t.agg(F.sum("id").alias("s"))

    try:
        for _ in range(3):
            assert cache.result(path, ("sum", "C1"), panel).first().s == 6
        assert len(made) == 1 and cache.result(path, ("sum", "C2"), panel).first().s == 6 and len(made) == 2
        table.commit(spark.range(5))
        assert cache.result(path, ("sum", "C1"), panel).first().s == 10 and len(made) == 3
        assert cache.get(path).count() == 5
    finally:
        cache.clear()


# ---------------------------------------------------------- views by merging

def test_incremental_refresh_feeds_the_same_views(spark, tmp_dir):
    """A full refresh of half the rows, then an incremental one of the rest, then a full one: the same tables each time."""
    rows, p = sr(spark, SF_SMALL), TablePaths(tmp_dir)
    write_bronze_csv(rows.filter("event_id % 2 = 0").drop("event_id"), p.source)
    refresh(spark, p.source, tmp_dir, scale=2)
    half = read_stored(spark, p.gold_day)
    n = half.agg(F.sum("record_count")).first()[0]
    write_bronze_csv(rows.filter("event_id % 2 = 1").drop("event_id"), p.source, files=3)
    refresh(spark, p.source, tmp_dir, scale=2, incremental=True, max_files_per_trigger=1)
    silver = spark.read.parquet(p.silver).drop("event_date")
    for _ in range(2):
        assert same(gold_day(silver, scale=2), read_stored(spark, p.gold_day))
        assert same(gold_hour(silver, scale=2), read_stored(spark, p.gold_hour))
        register_views(spark, tmp_dir)
        assert spark.sql("SELECT sum(record_count) AS n FROM gold_sensor_metrics_by_city_day").first().n == silver.count() > n
        refresh(spark, p.source, tmp_dir, scale=2)
    assert half.agg(F.sum("record_count")).first()[0] == n          # a reader of the first version still finds it
    assert VersionedTable(spark, p.gold_day).manifest().version >= 2
    refresh(spark, p.source, tmp_dir, scale=2, shared_pass=False)
    refresh(spark, p.source, tmp_dir, scale=2, incremental=True)
    assert same(gold_day(silver, scale=2), read_stored(spark, p.gold_day))


def test_replayed_and_late_batches(spark, tmp_dir):
    """A batch counts once however often it comes; only touched days are made anew; no time is a day of its own."""
    rows = sil(spark, SF_SMALL).drop("event_id").withColumn(
        "event_timestamp", F.when(F.col("sensor_id") != "S1", F.col("event_timestamp")))
    late = rows.filter(F.dayofmonth("event_timestamp") == 3)
    early = rows.exceptAll(late)
    assert merged.merge_batch(spark, tmp_dir, early, 0, "r", scale=2)
    days = merged.publish(spark, tmp_dir, scale=2)
    assert merged.merge_batch(spark, tmp_dir, late, 1, "r", scale=2)
    touched = merged.publish(spark, tmp_dir, scale=2)
    assert 0 < touched["gold_day"] < days["gold_day"]
    for batch_id, batch in ((0, early), (1, late)):
        assert not merged.merge_batch(spark, tmp_dir, batch, batch_id, "r", scale=2)
    assert merged.publish(spark, tmp_dir, scale=2) == {"gold_hour": 0, "gold_day": 0}
    assert same(gold_hour(rows, scale=2), read_stored(spark, f"{tmp_dir}/gold_hour"))
    assert same(gold_day(rows, scale=2), read_stored(spark, f"{tmp_dir}/gold_day"))
    assert merged.merge_batch(spark, tmp_dir, late, 0, "other", scale=2)      # another run starts from nothing
    merged.publish(spark, tmp_dir, scale=2)
    assert same(gold_day(late, scale=2), read_stored(spark, f"{tmp_dir}/gold_day"))


def test_crash_between_state_and_views(spark, tmp_dir, monkeypatch):
    rows = sil(spark, SF_SMALL).drop("event_id")
    rows.withColumn("event_date", F.to_date("event_timestamp")).write.partitionBy("event_date").parquet(f"{tmp_dir}/silver")

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(merged, "publish", broken)
    with pytest.raises(Exception):
        st.wait(merged.start_merged_gold(spark, f"{tmp_dir}/silver", tmp_dir, "r", scale=2, publish_each=True))
    monkeypatch.undo()
    st.wait(merged.start_merged_gold(spark, f"{tmp_dir}/silver", tmp_dir, "r", scale=2, publish_each=True))
    assert same(gold_day(rows, scale=2), read_stored(spark, f"{tmp_dir}/gold_day"))


# ------------------------------------------------------------- mixed headers

ROW = ["C1", "S1", "10", "20", "2024-01-01 00:00:00", "Trafik Sayacı", "Cadde", "Park, Okul", "1", "2.5", "", "x\"y"]


def _text(header, *rows, bom=False, end="\n"):
    cell = lambda x: '"' + x.replace('"', '\\"') + '"' if set(x) & {",", '"'} else x
    return ("\ufeff" if bom else "") + end.join(",".join(cell(x) for x in r) for r in [header, *rows])


def _write(path, name, text):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}.csv", "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_each_file_by_its_own_header(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    _write(src, "plain", _text(BRONZE_HEADERS, ROW, ROW))
    _write(src, "reversed", _text(BRONZE_HEADERS[::-1], ROW[::-1], bom=True, end="\r\n"))
    _write(src, "more", _text(["it's", *BRONZE_HEADERS, "b`t"], ["q", *ROW, "z"]))
    _write(src, "less", _text(BRONZE_HEADERS[:-1], ROW[:-1], ROW[:3], [*ROW, "x"]))
    _write(src, "again", _text(BRONZE_HEADERS, ROW, BRONZE_HEADERS, ROW))
    _write(src, "empty", "")
    _write(src, "header", _text(BRONZE_HEADERS))
    want = [x or None for x in ROW]
    out = read_bronze_mixed(spark, src).collect()
    good = [r for r in out if r["_corrupt_record"] is None]
    assert len(out) == 9 and len(good) == 7
    full = [r for r in good if r["Gürültü Seviyesi"] is not None]
    assert len(full) == 6 and all([r[h] for h in BRONZE_HEADERS] == want for r in full)
    assert [r["_extra"] for r in good if r["_extra"]] == ['{"it\'s":"q","b`t":"z"}']
    assert [r[h] for r in good if r["Gürültü Seviyesi"] is None for h in BRONZE_HEADERS] == [*want[:-1], None]
    _write(f"{tmp_dir}/twice", "a", _text(["kWh", "kWh"], ["1", "2"]))
    with pytest.raises(ValueError):
        read_bronze_mixed(spark, f"{tmp_dir}/twice")
    _write(f"{tmp_dir}/none", "a", "\n\n")
    assert read_bronze_mixed(spark, f"{tmp_dir}/none").count() == 0


def test_new_headers_while_the_stream_lives(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/bronze"
    for i, header in enumerate([BRONZE_HEADERS, BRONZE_HEADERS[::-1], [*BRONZE_HEADERS, "Yeni"]]):
        row = ROW[::-1] if i == 1 else [*ROW, "n"] if i == 2 else ROW
        _write(src, f"f{i}", _text(header, row))
        st.wait(start_bronze_mixed(spark, src, out, f"{tmp_dir}/ckpt"))
        assert spark.read.parquet(out).count() == i + 1
    rows = spark.read.parquet(out).collect()
    assert all([r[h] for h in BRONZE_HEADERS] == [x or None for x in ROW] for r in rows)
    assert [r["_extra"] for r in rows if r["_extra"]] == ['{"Yeni":"n"}']


def test_a_refresh_over_mixed_headers(spark, tmp_dir):
    p = TablePaths(tmp_dir)
    for i in range(3):
        header, row = list(BRONZE_HEADERS), [ROW[0], f"S{i}", *ROW[2:-1], "7.5"]
        if i == 1:
            header, row = header[::-1], row[::-1]
        _write(p.source, f"f{i}", _text(header, row))
        refresh(spark, p.source, tmp_dir, scale=2, incremental=True, mixed_headers=True)
        day = read_stored(spark, p.gold_day).first()
        assert (day.record_count, day.unique_sensors, day.total_energy_kwh, day.avg_noise_level) == (i + 1, i + 1, 2.5 * (i + 1), 7.5)


def test_lines_of_a_large_file_come_after_its_header(spark, tmp_dir):
    """A file of several splits: its header is the first line of the first split."""
    _write(f"{tmp_dir}/src", "big", _text(BRONZE_HEADERS[::-1], *[ROW[::-1]] * 3000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        out = read_bronze_mixed(spark, f"{tmp_dir}/src")
        assert out.filter("kWh = '2.5' AND _corrupt_record IS NULL").count() == 3000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


# ------------------------------------------------------------ inferred types

def test_types_of_a_lattice(spark):
    cells = {"whole": ["1", "-20", None], "number": ["1", "2.5", "1e3"], "day": ["2024-02-29", "2024-01-01", None],
             "time": ["2024-01-01", "2024-01-01 10:00:00", "2024-01-01T10:00"], "logical": ["true", "FALSE", None],
             "text": ["1", "x", "2"], "bad_day": ["2024-02-30", None, None], "nothing": [None, None, None],
             "blank": ["", "1", "2"], "long": ["123456789012345678901", "1", "2"]}
    rows = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{c} string" for c in cells))
    want = {"whole": "bigint", "number": "double", "day": "date", "time": "timestamp", "logical": "boolean", "text": "string",
            "bad_day": "string", "nothing": "string", "blank": "string", "long": "double"}
    got = {r["column"]: r.type for r in inferred_types(type_counts(rows)).collect()}
    assert got == want
    parts = [type_counts(rows.filter(F.col("text") == x)) for x in ("1", "x", "2")]
    assert {r["column"]: r.type for r in inferred_types(merged_counts(parts[::-1])).collect()} == want
    assert {r.type for r in inferred_types(type_counts(rows.limit(0))).collect()} == {"string"}


def test_values_that_do_not_fit_are_rescued(spark):
    rows = spark.createDataFrame([("1", "2024-01-01", "a"), ("x", None, None), (None, "soon", "b")], "n string, d string, s string")
    typed = typed_by(rows, {"n": "bigint", "d": "date", "s": "string"})
    assert dict(typed.dtypes) == {"n": "bigint", "d": "date", "s": "string", "_rescued": "string"}
    assert sorted((str(r.n), str(r.d), r["_rescued"] or "") for r in typed.collect()) == [
        ("1", "2024-01-01", ""), ("None", "None", '{"d":"soon"}'), ("None", "None", '{"n":"x"}')]
    assert typed_by(rows, {"s": "string"}).columns == ["s", "_rescued"]


# --------------------------------------------------------- counters by batch

def test_counters_survive_a_crash_in_a_batch(spark, tmp_dir, monkeypatch):
    rows, p = sr(spark, SF_SMALL).drop("event_id"), TablePaths(tmp_dir)
    write_bronze_csv(rows, p.source, files=4)
    st.wait(st.start_bronze(spark, p.source, p.bronze, p.bronze_ckpt))
    start = lambda: st.start_counted_silver(spark, p.bronze, p.silver, p.counts, p.ckpt, max_files_per_trigger=1)
    real, calls = st.metrics_from_observation, []

    def once(*a):
        calls.append(1)
        if len(calls) == 2:                               # its silver rows are written, its counters are not
            raise OSError("lost")
        return real(*a)

    monkeypatch.setattr(st, "metrics_from_observation", once)
    with pytest.raises(Exception):
        st.wait(start())
    st.wait(start())
    monkeypatch.undo()
    by_batch = st.batch_metrics(spark, p.counts)
    total = {r.expectation: (r.p, r.f) for r in by_batch.groupBy("expectation").agg(
        F.sum("passed").alias("p"), F.sum("failed").alias("f")).collect()}
    assert total == {r.expectation: (r.passed, r.failed) for r in dq_metrics(rows, SILVER_EXPECTATIONS).collect()}
    assert by_batch.select("run").distinct().count() == 1 and by_batch.select("batch").distinct().count() >= 3
    assert spark.read.parquet(p.silver).count() == sil(spark, SF_SMALL).count()
