"""Gold views kept by merging partial aggregates.

The state is a versioned table of one row per (city, sensor type, hour, sensor) with
the mergeable parts of every gold measure.  A micro-batch of silver rows is reduced
to such rows and merged into the days that it touches; silver itself is never read
again.  The state's manifest records the run and the batch that it holds, so
a batch that is replayed after a failure is not added twice.  The views are then
brought up to date part by part: a view notes from which folder of the state each of
its days was made, and the days whose folder has changed are made anew.

A new run starts from nothing and takes all of silver; the views stay as they
are until its state is published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.operators.gold import GOLD_KEYS, METRICS, gold_from_sensor_hours, sensor_hours
from urbanlake.session import work_path
from urbanlake.sources.csv import FILES_PER_BATCH
from urbanlake.sources.tables import TABLES, with_comment
from urbanlake.sources.versions import NONE, VersionedTable

STATE = "sensor_hour"
VIEWS = {"hour": "gold_hour", "day": "gold_day"}


def day_part(grain: str = "hour"):
    """The part that a row of the state or of a view belongs to: its day."""
    return F.expr("CAST(event_hour AS DATE)" if grain == "hour" else "event_date")


def merge_sensor_hours(rows: DataFrame) -> DataFrame:
    """Partial aggregates of the same (city, type, hour, sensor) put together."""
    parts = [F.sum("n_rows").alias("n_rows"), F.sum("vehicle_count_total").alias("vehicle_count_total"),
             F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts")]
    for m in METRICS:
        parts += [F.sum(f"{m}_sum").alias(f"{m}_sum"), F.sum(f"{m}_n").alias(f"{m}_n"), F.max(f"{m}_max").alias(f"{m}_max")]
    return rows.groupBy(*GOLD_KEYS, "event_hour", "sensor_id").agg(*parts)


def merge_batch(spark: SparkSession, base: str, batch: DataFrame, batch_id: int, run: str, scale: int | None = None) -> bool:
    """Add a batch of silver rows to the state; False if the state has it already."""
    table = VersionedTable(spark, f"{base.rstrip('/')}/{STATE}")
    now = table.manifest()
    same_run = now is not None and now.note.get("run") == run
    if same_run and now.note["batch"] >= batch_id:
        return False
    path = work_path(spark, "gold-delta")
    sensor_hours(batch, scale).write.parquet(path)
    delta = spark.read.parquet(path)
    days = [r[0] or NONE for r in delta.select(day_part().cast("string")).distinct().collect()]
    merged = delta
    if same_run:
        merged = merge_sensor_hours(table.read_manifest(now, days).unionByName(delta))
    laid = merged.repartitionByRange(day_part(), *GOLD_KEYS, "sensor_id")
    table.commit(laid, day_part(), "touched" if same_run else "all", note={"run": run, "batch": batch_id}, base=now)
    return True


def publish(spark: SparkSession, base: str, scale: int | None = None) -> dict[str, int]:
    """Bring both views up to date with the state; how many days each was made anew."""
    base = base.rstrip("/")
    state = VersionedTable(spark, f"{base}/{STATE}")
    now = state.manifest()
    out = {}
    for grain, name in VIEWS.items():
        view = VersionedTable(spark, f"{base}/{name}")
        old = view.manifest()
        built = old.note.get("built", {}) if old else {}
        parts = now.parts if now else {}
        stale = [p for p, folder in parts.items() if built.get(p) != folder]
        gone = [p for p in (old.parts if old else {}) if p not in parts]
        out[name] = len(stale)
        if now is None or (old is not None and not stale and not gone):
            continue
        rows = state.read_manifest(now, stale)
        gold = with_comment(gold_from_sensor_hours(rows, grain, scale), TABLES[name].comment)
        laid = gold.repartitionByRange(day_part(grain), *TABLES[name].cluster_by).sortWithinPartitions(
            day_part(grain), *TABLES[name].cluster_by)
        view.commit(laid, day_part(grain), "touched" if old is not None and built else "all", gone, {"built": parts}, old)
    return out


def current_run(spark: SparkSession, base: str) -> str | None:
    now = VersionedTable(spark, f"{base.rstrip('/')}/{STATE}").manifest()
    return now.note.get("run") if now else None


def start_merged_gold(spark: SparkSession, silver_path: str, base: str, run: str | None = None, scale: int | None = None,
                      available_now: bool = True, max_files_per_trigger: int = FILES_PER_BATCH, publish_each: bool = False):
    """Stream silver into the state of a run, a new one by default; ``publish_each`` brings the views up to date with each batch."""
    run = run or uuid.uuid4().hex[:12]

    def add(batch: DataFrame, batch_id: int) -> None:
        merge_batch(spark, base, batch, batch_id, run, scale)
        if publish_each:
            publish(spark, base, scale)

    stream = (spark.readStream.schema(spark.read.parquet(silver_path).schema).option("maxFileAge", "36500d")
              .option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(silver_path))
    w = stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{base.rstrip('/')}/gold_ckpt/{run}")
    return (w.trigger(availableNow=True) if available_now else w).start()
