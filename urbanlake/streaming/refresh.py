"""One refresh of the sensor tables: bronze -> silver (streams) -> gold (views).

Tables are folders under a base path (``<base>/bronze``, ``<base>/silver``,
``<base>/gold_hour``, ``<base>/gold_day``) with checkpoints beside them.  The
gold tables are materialized views in versioned tables (``read_stored`` reads
them): both a full and an incremental refresh stream silver into one state of
partial aggregates (``merged.py``) and publish the same views from it, a full one
from nothing, an incremental one with the new files alone.
``refresh_gold_incremental`` is the form without a state: it recomputes the days
touched by new silver rows from silver (dynamic partition overwrite).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.operators.gold import gold_metrics, write_clustered
from urbanlake.functions.periods import day_of
from urbanlake.operators.silver import castable_expectations
from urbanlake.sources.csv import FILES_PER_BATCH
from urbanlake.sources.headers import start_bronze_mixed
from urbanlake.sources.tables import TABLES, with_comment
from urbanlake.sources.versions import VersionedTable
from urbanlake.streaming.ingest import quality_counters, start_bronze, start_silver, stream_dq_metrics, wait
from urbanlake.streaming.merged import VIEWS, current_run, day_part, publish, start_merged_gold


@dataclass(frozen=True)
class TablePaths:
    base: str

    def __getattr__(self, name):  # bronze, silver, gold_hour, gold_day, *_ckpt
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.base.rstrip('/')}/{name}"


def refresh_view(spark: SparkSession, silver_path: str, out_path: str, grain: str, scale: int | None = None,
                 cluster_by: list[str] | None = None) -> DataFrame:
    """Recompute one gold view from all of silver and overwrite it."""
    silver = spark.read.parquet(silver_path)
    if "event_date" in silver.columns:          # partition column of a date-partitioned silver
        silver = silver.drop("event_date")
    info = TABLES["gold_hour" if grain == "hour" else "gold_day"]
    gold = with_comment(gold_metrics(silver, grain, scale), info.comment)
    write_clustered(gold, out_path, cluster_by or list(info.cluster_by))
    return spark.read.parquet(out_path)


def refresh(spark: SparkSession, source_dir: str, base: str, scale: int | None = None,
            max_files_per_trigger: int = FILES_PER_BATCH, shared_pass: bool = True, zone: str = "UTC",
            incremental: bool = False, mixed_headers: bool = False) -> dict:
    """Run bronze and silver to completion (new files only), then bring both gold views up to date.

    ``max_files_per_trigger`` bounds the micro-batches that a backlog is worked
    off in.  ``incremental`` merges only new silver files into the state of the
    views; otherwise a new run takes all of silver.  Without ``shared_pass`` each
    view is computed from silver by itself and has no state (the next incremental
    refresh then starts a run).  With ``mixed_headers`` each file is read by its own
    header; without, a file whose header is another one stops the stream.  Returns the counts of the quality rules and of
    what did not parse.
    """
    p = TablePaths(base)
    counters = quality_counters(spark)          # sees every micro-batch, however many there are
    start = start_bronze_mixed if mixed_headers else start_bronze
    wait(start(spark, source_dir, p.bronze, p.bronze_ckpt, max_files_per_trigger=max_files_per_trigger))
    sq = wait(start_silver(spark, p.bronze, p.silver, p.silver_ckpt, partition_by_date=True,
                           max_files_per_trigger=max_files_per_trigger, zone=zone))
    dq = stream_dq_metrics(sq, counters=counters)
    castable = stream_dq_metrics(sq, castable_expectations(zone), counters)
    if not shared_pass and not incremental:
        VersionedTable(spark, p.sensor_hour).drop()
        silver = spark.read.parquet(p.silver).drop("event_date")
        for grain, name in VIEWS.items():
            gold = with_comment(gold_metrics(silver, grain, scale), TABLES[name].comment)
            VersionedTable(spark, getattr(p, name)).commit(gold.repartitionByRange(day_part(grain), *TABLES[name].cluster_by),
                                                           day_part(grain))
    else:
        run = current_run(spark, base) if incremental else None
        wait(start_merged_gold(spark, p.silver, base, run, scale, max_files_per_trigger=max_files_per_trigger))
        publish(spark, base, scale)
    return {"paths": p, "dq_metrics": dq, "castable_metrics": castable}


def refresh_gold_incremental(spark: SparkSession, silver_path: str, new_rows: DataFrame, out_path: str,
                             grain: str = "day", scale: int | None = None) -> None:
    """Recompute only the days that ``new_rows`` touch and overwrite just those partitions.

    Distinct counts and averages do not merge by addition, so whole touched
    days are recomputed from silver (``touched_silver``).  The gold folder is partitioned by ``event_date`` and written with dynamic
    partition overwrite, so untouched days are never rewritten.
    """
    gold = gold_metrics(touched_silver(spark, silver_path, new_rows), grain, scale)
    if "event_date" not in gold.columns:
        gold = gold.withColumn("event_date", F.to_date("event_hour"))
    # a per-write option: the session setting stays untouched for jobs running beside this one
    (gold.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date").parquet(out_path))


def touched_silver(spark: SparkSession, silver_path: str, new_rows: DataFrame) -> DataFrame:
    """All silver rows of the days that ``new_rows`` touch.

    The first and last day touched (one row) become a partition filter on a
    date-partitioned silver; an exact semi join keeps the days between them
    that are touched, rows without a day included.
    """
    touched = new_rows.select(day_of("event_timestamp").alias("touched_date")).distinct()
    silver = spark.read.parquet(silver_path)
    if "event_date" not in silver.columns:
        silver = silver.withColumn("event_date", day_of("event_timestamp"))
    span = touched.agg(F.min("touched_date").alias("low"), F.max("touched_date").alias("high"),
                       F.bool_or(F.col("touched_date").isNull()).alias("without")).first()
    day = F.col("event_date")
    between = day.between(F.lit(span.low), F.lit(span.high)) if span.low is not None else F.lit(False)
    near = silver.filter(between | day.isNull() if span.without else between)
    return near.join(touched, near["event_date"].eqNullSafe(touched["touched_date"]), "left_semi").drop("event_date")


def start_incremental_gold(spark: SparkSession, silver_path: str, out_path: str, checkpoint: str,
                           grain: str = "day", scale: int | None = None, available_now: bool = True,
                           max_files_per_trigger: int = FILES_PER_BATCH):
    """Keep a gold view current from the silver stream, one micro-batch at a time.

    Each batch recomputes its touched periods from silver, so replaying a
    batch after a failure gives the same table (idempotent).
    """
    def upsert(batch: DataFrame, epoch_id: int) -> None:
        refresh_gold_incremental(spark, silver_path, batch, out_path, grain, scale)

    # the silver sink's own schema (includes its partition column when date-partitioned)
    stream = (spark.readStream.schema(spark.read.parquet(silver_path).schema)
              .option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(silver_path))
    w = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
