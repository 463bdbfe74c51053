"""Stored tables: names, comments, layout, and a reuse cache for dashboards."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from urbanlake.schemas import VIEW_NAMES
from urbanlake.sources.versions import VersionedTable, read_stored, stored_version


@dataclass(frozen=True)
class TableInfo:
    name: str
    comment: str
    cluster_by: tuple[str, ...] = ()


TABLES: dict[str, TableInfo] = {t.name: t for t in [
    TableInfo("bronze", "Raw sensor rows ingested incrementally from CSV files"),
    TableInfo("silver", "Typed sensor rows with English column names and quality rules applied",
              ("sensor_type", "city_id")),
    TableInfo("gold_hour", "Hourly metrics per city and sensor type", ("city_id", "sensor_type")),
    TableInfo("gold_day", "Daily metrics per city and sensor type", ("city_id", "sensor_type")),
    TableInfo("city_data", "Weekly price, demand and revenue per city service"),
]}


def with_comment(df: DataFrame, comment: str) -> DataFrame:
    """Attach a table comment as metadata of the first column (kept in the parquet schema)."""
    first = df.columns[0]
    return df.withMetadata(first, {**df.schema[first].metadata, "table_comment": comment})


def table_comment(df: DataFrame) -> str | None:
    return df.schema[df.columns[0]].metadata.get("table_comment")


def replace_table(spark: SparkSession, written: str, path: str) -> None:
    """Put a completely written plain folder in the place of ``path``.

    A failed job leaves the old folder as it was.  The old one is moved aside
    first and deleted last: for a moment there is none, and readers that
    listed its files lose them.  Tables that are read while they change are
    versioned ones (``versions.py``).
    """
    jvm = spark.sparkContext._jvm
    new, place = jvm.org.apache.hadoop.fs.Path(written), jvm.org.apache.hadoop.fs.Path(path)
    old = jvm.org.apache.hadoop.fs.Path(f"{written}-replaced")
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = store.exists(place)
    if had and not store.rename(place, old):
        raise OSError(f"can't move {path} aside")
    if not store.rename(new, place):
        raise OSError(f"can't put {written} in the place of {path}")
    if had:
        store.delete(old, True)


class TableCache:
    """Reuse loaded tables, and results made from them, until their version moves or ``ttl_s`` seconds are over.

    Tables and results are persisted in executor memory/disk (never collected)
    under the version they were made from.  A versioned table that has a newer
    version is read again at once; a plain folder has no version, so only the
    time-to-live renews it.
    """

    def __init__(self, spark: SparkSession, ttl_s: float = 300.0):
        self.spark, self.ttl_s = spark, ttl_s
        self._entries: dict[tuple, tuple[float, int | None, DataFrame]] = {}

    def _kept(self, key: tuple, path: str, make) -> DataFrame:
        now, version = time.monotonic(), stored_version(self.spark, path)
        hit = self._entries.get(key)
        if hit and now - hit[0] < self.ttl_s and hit[1] == version:
            return hit[2]
        if hit:
            hit[2].unpersist()
        df = make().persist()
        self._entries[key] = (now, version, df)
        return df

    def get(self, path: str) -> DataFrame:
        return self._kept((path,), path, lambda: read_stored(self.spark, path))

    def result(self, path: str, panel: tuple, make) -> DataFrame:
        """The result ``make(table)`` of a panel, kept by the table's version and the panel's name and arguments."""
        return self._kept((path, *panel), path, lambda: make(self.get(path)))

    def clear(self) -> None:
        for _, _, df in self._entries.values():
            df.unpersist()
        self._entries.clear()


def register_views(spark: SparkSession, base: str, extra: dict[str, str] | None = None) -> list[str]:
    """Expose the current tables under ``base`` (as written by ``refresh``) as session views for ``spark.sql``.

    ``extra`` maps further view names to parquet paths (e.g. ``{"city_data": path}``).  Views are
    session-scoped and read the stored parquet, so filters in the SQL reach the scan.
    """
    names = []
    paths = {view: f"{base.rstrip('/')}/{folder}" for folder, view in VIEW_NAMES.items()}
    paths.update(extra or {})
    for view, path in paths.items():
        if not VersionedTable(spark, path).exists():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
                continue
        read_stored(spark, path).createOrReplaceTempView(view)
        names.append(view)
    return names
