"""Bronze and silver as Structured Streaming queries.

* bronze: CSV directory source -> parquet sink.  The checkpoint's file log
  remembers which files were read, so a rerun only picks up new files.
* silver: bronze parquet sink read as a stream -> typed projection ->
  quality counters (``observe``, measured before any drop) -> drop rules ->
  parquet sink.

``trigger(availableNow=True)`` processes everything present and stops (a
batch-style refresh that keeps exactly-once file tracking); pass
``available_now=False`` for a continuously running query.  Checkpoints and
sinks live in a shared folder, so a restarted driver or lost executor
resumes from the last committed micro-batch.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from urbanlake.operators.expectations import (
    SILVER_EXPECTATIONS,
    Expectation,
    apply_expectations,
    metric_columns,
    metrics_from_observation,
    observe_expectations,
)
from urbanlake.operators.silver import castable_expectations, project_bronze
from urbanlake.schemas import BRONZE_SCHEMA
from urbanlake.sources.csv import FILES_PER_BATCH, read_bronze_stream
from urbanlake.sources.tables import TABLES, with_comment

DQ_METRIC = "silver_dq"
CAST_METRIC = "silver_castable"
BATCH_COUNTS = "run string, rows bigint, expectation string, action string, passed bigint, failed bigint"
#: Files that a micro-batch writes for one event date, each with an even share of its rows.
FILES_PER_DAY = 4


def _start(df: DataFrame, sink: str, checkpoint: str, available_now: bool, processing_time: str | None,
           name: str | None, partition_by: list[str] | None = None) -> StreamingQuery:
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(sink)


def start_bronze(spark: SparkSession, source_dir: str, bronze_dir: str, checkpoint: str,
                 available_now: bool = True, processing_time: str | None = None,
                 max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """Raw CSV files -> bronze parquet (all text columns, file headers kept)."""
    stream = with_comment(read_bronze_stream(spark, source_dir, max_files_per_trigger), TABLES["bronze"].comment)
    return _start(stream, bronze_dir, checkpoint, available_now, processing_time, None)


def silver_stream_frame(spark: SparkSession, bronze_dir: str, rules: list[Expectation] | None = None,
                        processed_at: bool = True, partition_by_date: bool = False,
                        max_files_per_trigger: int = FILES_PER_BATCH, zone: str = "UTC",
                        files_per_day: int = FILES_PER_DAY) -> DataFrame:
    rules = SILVER_EXPECTATIONS if rules is None else rules
    bronze = (spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", str(max_files_per_trigger))
              .parquet(bronze_dir))
    counted = observe_expectations(bronze, castable_expectations(zone), CAST_METRIC)
    typed = observe_expectations(project_bronze(counted, processed_at, zone=zone), rules, DQ_METRIC)
    kept = with_comment(apply_expectations(typed, rules), TABLES["silver"].comment)
    if not partition_by_date:
        return kept
    # a day's rows meet in a few tasks by a hash of the whole row: few files, and no key that one task has alone
    share = F.pmod(F.xxhash64("sensor_id", "event_timestamp", *TABLES["silver"].cluster_by, "latitude", "longitude"),
                   F.lit(files_per_day))
    return kept.withColumn("event_date", F.to_date("event_timestamp")).repartition("event_date", share)


def start_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, checkpoint: str,
                 rules: list[Expectation] | None = None, processed_at: bool = True,
                 available_now: bool = True, processing_time: str | None = None,
                 partition_by_date: bool = False, max_files_per_trigger: int = FILES_PER_BATCH,
                 zone: str = "UTC") -> StreamingQuery:
    """Bronze parquet stream -> typed, quality-filtered silver parquet.

    ``partition_by_date`` writes one folder per event date, so consumers that
    need a few days (incremental gold) prune the rest at planning time.
    ``max_files_per_trigger`` bounds each micro-batch (a large backfill runs
    as many bounded batches, each committed on its own).  ``zone`` is the zone
    of the wall-clock times that offsets are put in.
    """
    return _start(silver_stream_frame(spark, bronze_dir, rules, processed_at, partition_by_date,
                                      max_files_per_trigger, zone), silver_dir,
                  checkpoint, available_now, processing_time, None,
                  ["event_date"] if partition_by_date else None)


def start_counted_silver(spark: SparkSession, bronze_dir: str, silver_dir: str, counts_dir: str, checkpoint: str,
                         rules: list[Expectation] | None = None, available_now: bool = True,
                         max_files_per_trigger: int = FILES_PER_BATCH, zone: str = "UTC") -> StreamingQuery:
    """Bronze -> silver with the quality counters of every micro-batch as rows of a table.

    A batch writes its silver rows and its counters (observed on the same
    pass, before any drop) to folders of its number before it is committed.
    A batch that is replayed after a failure replaces both, so the counters of
    all batches are those of the rows in silver, whoever restarts the stream
    and whatever a driver had in memory.
    """
    rules = SILVER_EXPECTATIONS if rules is None else rules

    def take(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"{DQ_METRIC}-{batch_id}")
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        typed = project_bronze(batch, zone=zone).observe(seen, F.count(F.lit(1)).alias("rows"), *metric_columns(rules))
        kept = with_comment(apply_expectations(typed, rules), TABLES["silver"].comment)
        kept.write.mode("overwrite").parquet(f"{silver_dir}/batch={batch_id}")
        counted = [(run, seen.get["rows"], *row) for row in metrics_from_observation(seen.get, rules)]
        (batch.sparkSession.createDataFrame(counted, BATCH_COUNTS).coalesce(1)
         .write.mode("overwrite").parquet(f"{counts_dir}/batch={batch_id}"))

    stream = (spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", str(max_files_per_trigger))
              .parquet(bronze_dir))
    w = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def batch_metrics(spark: SparkSession, counts_dir: str) -> DataFrame:
    """``run, batch, rows, expectation, action, passed, failed`` of every micro-batch (``run``: the checkpoint's query id)."""
    counts = spark.read.schema(f"{BATCH_COUNTS}, batch bigint").parquet(counts_dir)
    return counts.select("run", "batch", "rows", "expectation", "action", "passed", "failed")


def wait(query: StreamingQuery) -> StreamingQuery:
    """Wait for an availableNow query to finish, however long its backlog takes."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def stream_dq_metrics(query: StreamingQuery, rules: list[Expectation] | None = None,
                      counters: "QualityCounters | None" = None) -> list[tuple[str, str, int, int]]:
    """(expectation, action, passed, failed) summed over every micro-batch of ``query``.

    The counts come from a ``QualityCounters`` listener that was registered
    before the query started (``quality_counters(spark)``); the progress a
    query retains is bounded, so it cannot be the source.  A query the
    listener did not see from its start raises instead of undercounting.
    """
    if counters is None:
        counters = _COUNTERS.get(id(SparkSession.getActiveSession()))
    if counters is None or not counters.saw_start(query):
        raise RuntimeError("register quality_counters(spark) before starting the query to count its batches")
    return counters.metrics(query, rules)


class QualityCounters(StreamingQueryListener):
    """Adds up the observed quality counters of every micro-batch of every query run it sees.

    Progress retained on a query is bounded (``numRecentProgressUpdates``); a
    listener sees each batch once, so counters stay complete for queries that
    run for thousands of micro-batches.  Register once per session with
    ``spark.streams.addListener``.  Callbacks arrive on a listener thread.
    """

    def __init__(self, metric_names: tuple[str, ...] = (DQ_METRIC, CAST_METRIC)):
        self.metric_names = metric_names
        self._lock = threading.Lock()
        self._totals: dict[str, dict[str, int]] = {}
        self._batches: dict[str, set[int]] = {}
        self._started: set[str] = set()
        self._terminated: set[str] = set()

    # Keyed by run id: the query id stays the same when a query restarts from its checkpoint.
    def onQueryStarted(self, event):  # noqa: N802 - listener API
        with self._lock:
            self._started.add(str(event.runId))

    def saw_start(self, query: StreamingQuery, timeout_s: float = 10.0) -> bool:
        """True when the listener saw ``query`` start (events arrive asynchronously)."""
        deadline = time.monotonic() + timeout_s
        while True:
            with self._lock:
                if str(query.runId) in self._started:
                    return True
            if time.monotonic() > deadline:
                return False
            time.sleep(0.05)

    def onQueryProgress(self, event):  # noqa: N802
        progress = event.progress
        observed = progress.observedMetrics or {}
        rows = [observed[name] for name in self.metric_names if name in observed]
        if not rows:
            return
        qid = str(progress.runId)
        with self._lock:
            seen = self._batches.setdefault(qid, set())
            if progress.batchId in seen:
                return
            seen.add(progress.batchId)
            totals = self._totals.setdefault(qid, {})
            for row in rows:
                for k, v in row.asDict().items():
                    totals[k] = totals.get(k, 0) + int(v or 0)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        with self._lock:
            self._terminated.add(str(event.runId))

    def batches(self, query: StreamingQuery) -> set[int]:
        with self._lock:
            return set(self._batches.get(str(query.runId), set()))

    def metrics(self, query: StreamingQuery, rules: list[Expectation] | None = None,
                timeout_s: float = 30.0) -> list[tuple[str, str, int, int]]:
        """(expectation, action, passed, failed) over all batches of ``query`` seen so far.

        Listener events arrive asynchronously and in order: for a finished run
        this waits (up to ``timeout_s``) for the run's termination event, which
        follows all of its progress events; for a running query it waits for
        the latest reported batch that carried counters.  When they do not
        arrive in time, or lack a rule's counters, it raises: an incomplete
        count is no count.
        """
        rules = SILVER_EXPECTATIONS if rules is None else rules
        run = str(query.runId)
        deadline = time.monotonic() + timeout_s
        reported = [x.batchId for x in query.recentProgress
                    if any(name in (x.observedMetrics or {}) for name in self.metric_names)]

        def complete() -> bool:
            with self._lock:
                ended = run in self._terminated
            return (query.isActive or ended) and set(reported) <= self.batches(query)

        while not complete():
            if time.monotonic() > deadline:
                raise TimeoutError(f"the counters of streaming query {query.id} did not arrive in {timeout_s} s")
            time.sleep(0.05)
        with self._lock:
            totals = dict(self._totals.get(run, {}))
        if totals:
            missing = [r.name for r in rules if f"{r.name}__passed" not in totals]
            if missing:
                raise RuntimeError(f"not counted by the query: {', '.join(missing)}")
        return metrics_from_observation(totals, rules)


_COUNTERS: dict[int, QualityCounters] = {}


def quality_counters(spark: SparkSession) -> QualityCounters:
    """The session's ``QualityCounters`` listener (registered on first use)."""
    key = id(spark)
    if key not in _COUNTERS:
        counters = QualityCounters()
        spark.streams.addListener(counters)
        _COUNTERS[key] = counters
    return _COUNTERS[key]
