"""Text and JSON metric context per city (the input of a language-model prompt).

The prompt call itself is out of scope; these build the metric blocks with
Spark string functions, one row per city, so no gold table passes through the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.functions.text import fixed, fixed_sql
from urbanlake.operators.serving import KPI_VALUES, PROFILE_JSON_KEYS

#: Heading, column and decimals of each line of a block.
SELECTION_LINES = [("vehicles per day", "avg_vehicles", 2), ("energy per day (kWh)", "total_energy_kwh", 2),
                   ("bin fill (%)", "avg_occupancy_rate", 2), ("noise (dB)", "avg_noise_level", 2)]


def proposal_context_text(profile: DataFrame) -> DataFrame:
    """text: the means of a city selection, one line for each metric (one row).

    Cities stand in sorted order.  The block has one entry per selected city,
    so build it for a bounded selection.
    """
    entries = profile.filter("city_id IS NOT NULL").selectExpr(
        "city_id", *[f"concat(city_id, ' ', {fixed_sql(c, n)}) AS {c}" for _, c, n in SELECTION_LINES])
    columns = ", ".join(["city_id", *(c for _, c, _ in SELECTION_LINES)])
    lines = ["concat('cities: ', array_join(transform(e, x -> x.city_id), ', '))"]
    lines += [f"concat('{head}: ', array_join(transform(e, x -> x.{c}), ', '))" for head, c, _ in SELECTION_LINES]
    return (entries.agg(F.expr(f"array_sort(collect_list(struct({columns}))) AS e"))
            .selectExpr(f"concat_ws(char(10), {', '.join(lines)}) AS text"))


def recent_summary_text(summary: DataFrame, time_period: str = "hourly", n: int = 24) -> DataFrame:
    """city_id, text: the summary of a city's latest ``n`` rows (a peak only where the table has one)."""
    vehicles = [F.lit("vehicles: mean "), fixed("avg_vehicles", 0)]
    if "peak_vehicles" in summary.columns:
        vehicles += [F.lit(", peak "), fixed("peak_vehicles", 0)]
    lines = [
        F.concat(F.col("city_id"), F.lit(f", latest {n} {time_period} rows")),
        F.concat(*vehicles),
        F.concat(F.lit("energy (kWh): total "), fixed("total_energy_kwh", 2), F.lit(", mean "), fixed("avg_energy_kwh", 2)),
        F.concat(F.lit("bin fill (%): mean "), fixed("avg_occupancy_rate", 1)),
        F.concat(F.lit("noise (dB): mean "), fixed("avg_noise_level", 1)),
    ]
    return summary.select("city_id", F.concat_ws("\n", *lines).alias("text"))


def city_context_text(profile: DataFrame) -> DataFrame:
    """city_id, text: one line per city with its four mean metrics."""
    parts = ", ".join(f"concat('{c}=', {fixed_sql(c, 4)})" for c in KPI_VALUES)
    return profile.selectExpr("city_id", f"concat(city_id, ': ', concat_ws(', ', {parts})) AS text")


def metrics_document(profile: DataFrame) -> DataFrame:
    """One JSON object keyed by city, each value the city's metrics object.

    Its size is the number of cities (a dimension, not the data); it is a
    single-row result by definition, so build it for a bounded selection.
    """
    obj = F.struct(*[F.col(src).alias(key) for key, src in PROFILE_JSON_KEYS])
    entries = F.array_sort(F.collect_list(F.struct(F.col("city_id"), obj.alias("metrics"))))
    return profile.filter(F.col("city_id").isNotNull()).agg(
        F.to_json(F.map_from_entries(entries)).alias("document"))


__all__ = ["recent_summary_text", "city_context_text", "proposal_context_text", "metrics_document", "KPI_VALUES"]
