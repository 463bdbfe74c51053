"""Weekly price, demand and revenue table of the city services.

Observations (one row per week draw and service) carry the uniform draws as
columns; everything else is column arithmetic.  The four-row service
dimension is compiled into CASE lookups (no join); a user-supplied dimension
table is joined.  No shuffle otherwise except where a query asks for distinct
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.functions.calendar import festival_flag, holiday_flag, seasonality_sql, sunday_on_or_after, week_index
from urbanlake.functions.demand import clamp01_sql, d, elastic_demand_sql
from urbanlake.functions.measures import rounded_sql
from urbanlake.schemas import (
    BASE_CONGESTION,
    BASE_POPULATION,
    SERVICE_NAMES,
    SERVICES,
    SIGNAL_LOAD_PER_CONGESTION,
    WEEKLY_SPINE_PERIODS,
    WEEKLY_SPINE_START,
)


def service_dim(spark: SparkSession) -> DataFrame:
    """The four-row service dimension (base price, base demand, elasticity).

    Built from literals on the JVM side (a one-row range exploded into four
    rows), so using it never starts a Python worker.
    """
    rows = ", ".join(f"named_struct('service', '{s}', 'base_price', {d(p)}, 'base_demand', {d(q)}, "
                     f"'elasticity', {d(e)})" for s, p, q, e in SERVICES)
    return spark.range(1).selectExpr(f"inline(array({rows}))")


SERVICE_FIELDS = ["base_price", "base_demand", "elasticity"]


def service_lookup_sql(field: str, key: str = "service") -> str:
    """A service attribute as a CASE over the fixed dimension; an unknown service stops the job."""
    idx = 1 + SERVICE_FIELDS.index(field)
    branches = " ".join(f"WHEN '{row[0]}' THEN {d(row[idx])}" for row in SERVICES)
    return f"CASE {key} {branches} ELSE raise_error(concat('unknown service: ', coalesce({key}, 'NULL'))) END"


def with_service_attributes(df: DataFrame, services: DataFrame | None = None) -> DataFrame:
    """Add base_price, base_demand and elasticity of each row's service.

    The built-in four-row dimension is compiled into CASE expressions: no join
    and no hashing per row.  A user-supplied dimension table is joined plainly
    (the engine picks the strategy); a service that it lacks, or lists more
    than once, stops the job instead of losing or multiplying rows.
    """
    if services is None:
        return df.selectExpr("*", *[f"{service_lookup_sql(f)} AS {f}" for f in SERVICE_FIELDS])
    dim = services.groupBy("service").agg(F.count(F.lit(1)).alias("_listed"), *[F.first(f).alias(f) for f in SERVICE_FIELDS])
    fits = F.expr("CASE WHEN _listed = 1 THEN true "
                  "WHEN _listed > 1 THEN raise_error(concat('service listed twice: ', service)) "
                  "ELSE raise_error(concat('unknown service: ', coalesce(service, 'NULL'))) END")
    return df.join(dim, "service", "left").filter(fits).select(*df.columns, *SERVICE_FIELDS)


def with_services(df: DataFrame) -> DataFrame:
    """One copy of each row per service (the weeks x services product, done as a narrow explode)."""
    return df.withColumn("service", F.explode(F.array(*[F.lit(s) for s in SERVICE_NAMES])))


def weekly_spine(spark: SparkSession, start: str = WEEKLY_SPINE_START, periods: int = WEEKLY_SPINE_PERIODS) -> DataFrame:
    """t, week (date), service: ``periods`` Sundays from the first Sunday on/after ``start``."""
    first = sunday_on_or_after(F.lit(start).cast("date"))
    weeks = spark.range(periods).select(F.col("id").cast("int").alias("t"),
                                        F.date_add(first, (F.col("id") * 7).cast("int")).alias("week"))
    return with_services(weeks)


def weekly_spine_over(df: DataFrame, date_col: str) -> DataFrame:
    """Spine of the Sundays covering the dates of ``date_col`` (a min/max aggregate, then a sequence)."""
    bounds = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    first = sunday_on_or_after("lo")
    weeks = (bounds.filter(first <= F.col("hi"))
             .select(F.posexplode(F.sequence(first, F.col("hi"), F.expr("INTERVAL 7 DAYS"))).alias("t", "week")))
    return with_services(weeks.select(F.col("t").cast("int"), "week"))


def calendar_flags(dates: DataFrame, date_col: str, origin: str) -> DataFrame:
    """Distinct dates with their week index, festival and holiday flags."""
    d = F.col(date_col)
    return (dates.select(d.alias(date_col)).distinct()
            .select(date_col, week_index(d, origin).alias("t"), festival_flag(d).alias("festival"),
                    holiday_flag(d).alias("holiday")))


def city_state_features(obs: DataFrame, keys: list[str]) -> DataFrame:
    """Population, congestion and signal load of each observation.

    population = 1.1e7 * (1 + pop_u [+ 0.1 in festival weeks]);
    congestion = clamp(0.65 + congestion_u, 0, 1); signal_load = 0.6 * congestion.
    """
    drift = f"(1.0D + pop_u) + CASE WHEN festival = 1 THEN 0.1D ELSE 0.0D END"
    congestion = clamp01_sql(f"{d(BASE_CONGESTION)} + congestion_u")
    return obs.selectExpr(*keys, "service", "t", "festival", "holiday", "price_u", "noise_e",
                          f"{d(BASE_POPULATION)} * ({drift}) AS population",
                          f"{congestion} AS congestion",
                          f"{congestion} * {d(SIGNAL_LOAD_PER_CONGESTION)} AS signal_load")


def elastic_demand_table(obs: DataFrame, keys: list[str], demand_decimals: int | None = 4,
                         revenue_decimals: int | None = 2) -> DataFrame:
    """Price, demand and revenue of each observation from the constant-elasticity curve.

    price = base_price * (1 + price_u); demand with seasonality(t) and noise
    (1 + noise_e), congestion, festival and holiday effects, floored at 1.
    """
    joined = with_service_attributes(city_state_features(obs, keys))
    demand = elastic_demand_sql("service", "price", "base_price", "base_demand", "elasticity", "congestion",
                                "festival", "holiday", season=seasonality_sql("t"), noise="noise_e")
    priced = joined.selectExpr("*", "base_price * (1.0D + price_u) AS price")
    out = priced.selectExpr(*keys, "t", "service", "price", f"{demand} AS demand", "population", "congestion",
                            "signal_load", "festival", "holiday")
    return out.selectExpr(*keys, "t", "service", "price",
                          f"{rounded_sql('demand', demand_decimals)} AS demand",
                          f"{rounded_sql('demand * price', revenue_decimals)} AS revenue",
                          "population", "congestion", "signal_load", "festival", "holiday")


def demand_features(table: DataFrame, keys: list[str]) -> DataFrame:
    """The six model features and the label."""
    return table.select(*keys, "price", "population", "congestion", "signal_load", "festival", "holiday", "demand")


def city_data(table: DataFrame, origin: str, keys: list[str] | None = None) -> DataFrame:
    """The weekly table in its stored form: week as 'yyyy-MM-dd HH:mm:ss' text, flags as bigint."""
    week = F.date_add(F.lit(origin).cast("date"), F.col("t") * 7)
    return table.select(
        *(keys or []),
        F.date_format(week.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("week"),
        "service", "price", "demand", "revenue", "population", "congestion", "signal_load",
        F.col("festival").cast("bigint").alias("festival"), F.col("holiday").cast("bigint").alias("holiday"))


def save_table(df: DataFrame, path: str) -> DataFrame:
    """Drop-and-overwrite a table at ``path`` and return it read back (idempotent rerun)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
