"""The dashboard's panels as DataFrame queries over the stored gold tables.

One object per application.  Every panel filters on the chosen city or
cities before anything else.  With a time-to-live the gold tables and the panels
made from them are kept in a ``TableCache`` (persisted on the executors) by the
table's version, so a panel that is shown again is not computed again, and a
refresh shows at once; the filter prunes cached batches by their statistics.  With
``ttl_s=None`` each panel reads parquet and the filter reaches the scan of
the clustered table.  Nothing is collected here; the caller collects the
(small) panel results it shows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from urbanlake.operators import context as ctx
from urbanlake.operators import serving as sv
from urbanlake.sources.tables import TableCache
from urbanlake.sources.versions import read_stored

TREND_ROWS = {"hourly": 168, "daily": 7}
SUMMARY_ROWS = 24


class CityDashboard:
    def __init__(self, spark: SparkSession, hourly_path: str, daily_path: str, ttl_s: float | None = None):
        self.spark = spark
        self.cache = TableCache(spark, ttl_s) if ttl_s else None
        self.paths = {"hourly": hourly_path, "daily": daily_path}

    def data(self, granularity: str = "hourly") -> DataFrame:
        if granularity not in self.paths:
            raise ValueError("granularity must be 'hourly' or 'daily'")
        path = self.paths[granularity]
        return self.cache.get(path) if self.cache else read_stored(self.spark, path)

    def _panel(self, granularity: str, panel: tuple, make) -> DataFrame:
        """A panel's result over one table, kept by the table's version when there is a cache."""
        if self.cache is None:
            return make(self.data(granularity))
        self.data(granularity)
        return self.cache.result(self.paths[granularity], panel, make)

    # ------------------------------------------------------------ city view
    def cities(self, granularity: str = "hourly") -> DataFrame:
        """Selectable cities, sorted (the first one is the default choice)."""
        return sv.served(self.data(granularity)).select("city_id").distinct().orderBy("city_id")

    def city(self, city: str, granularity: str = "hourly") -> DataFrame:
        return sv.city_rows(self.data(granularity), city)

    def latest_metrics(self, city: str, granularity: str = "hourly", zero_change: bool = False) -> DataFrame:
        """Latest values and their change against the previous row (NULL or 0 when no positive previous)."""
        return self._panel(granularity, ("latest", city, zero_change),
                           lambda t: sv.kpi_latest(sv.city_rows(t, city), 0.0 if zero_change else None))

    def insights_text(self, city: str, granularity: str = "hourly") -> DataFrame:
        """The metric summary of the city's latest rows, as prompt text."""
        summary = sv.recent_summary(self.city(city, granularity), SUMMARY_ROWS)
        return ctx.recent_summary_text(summary, granularity, SUMMARY_ROWS)

    def trend(self, city: str, granularity: str = "hourly", rows: int | None = None) -> DataFrame:
        """The four series over the latest rows (168 hourly or 7 daily rows by default)."""
        rows = rows or TREND_ROWS.get(granularity)
        return self._panel(granularity, ("trend", city, rows), lambda t: sv.trend(sv.city_rows(t, city), rows))

    def breakdown(self, city: str, granularity: str = "hourly") -> DataFrame:
        return self._panel(granularity, ("breakdown", city), lambda t: sv.breakdown_by_sensor_type(sv.city_rows(t, city)))

    # -------------------------------------------------------- proposal view
    def proposal_context(self, cities: list[str]) -> DataFrame:
        """The metric block of the selected cities (daily data), as prompt text."""
        return ctx.proposal_context_text(sv.city_profile(sv.select_cities(self.data("daily"), cities)))

    def proposal_kpis(self, cities: list[str]) -> DataFrame:
        return sv.context_kpis(self.data("daily"), cities)

    def comparison(self, cities: list[str]) -> DataFrame:
        return self._panel("daily", ("comparison", *cities), lambda t: sv.comparison_by_city_type(t, cities))

    def close(self) -> None:
        if self.cache:
            self.cache.clear()
