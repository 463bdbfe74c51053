"""What-if scoring of pricing policies, as batch jobs over a policies table.

A policy is one row: four service prices, a fuel tax and festival/holiday
flags.  Scoring expands each policy to one row per service with a narrow
``inline`` (no join, no shuffle), adds the fixed scoring context and applies
either the closed-form demand curve (here) or a trained model (``ml.py``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanlake.functions.demand import d, elastic_demand_sql
from urbanlake.functions.measures import rounded_sql, scaled
from urbanlake.operators.weekly import with_service_attributes
from urbanlake.schemas import (
    BASE_CONGESTION,
    BASE_POPULATION,
    FUEL_TAX_CONGESTION,
    POLICY_RANGES,
    SCORING_SIGNAL_LOAD,
    SERVICE_NAMES,
    SERVICES,
)
from urbanlake.session import work_path

# Default sweep of every policy input: (column, values).
DEFAULT_SWEEPS: list[tuple[str, list]] = [
    ("metro_price", [float(v) for v in range(10, 101, 10)]),
    ("bus_price", [float(v) for v in range(5, 51, 5)]),
    ("private_transport_price", [float(v) for v in range(50, 151, 25)]),
    ("water_price", [1.0, 5.0, 10.0, 20.0]),
    ("fuel_tax", [0.0, 0.1, 0.2, 0.3]),
    ("festival", [0, 1]),
    ("holiday", [0, 1]),
]


def validate_policies(policies: DataFrame) -> DataFrame:
    """Fail the job on a policy outside the slider ranges or with a missing input (checked inside the plan)."""
    good = reduce(lambda a, b: a & b,
                  [F.col(c).between(lo, hi) for c, lo, hi in POLICY_RANGES]
                  + [F.col("festival").isin(0, 1), F.col("holiday").isin(0, 1)])
    return policies.filter(F.when(F.coalesce(good, F.lit(False)), True)
                           .otherwise(F.raise_error(F.lit("policy outside the allowed ranges"))))


def policy_grid(spark: SparkSession, sweeps: list[tuple[str, list]] | None = None) -> DataFrame:
    """Every combination of the sweep values, one policy per row.

    policy_id is the mixed-radix number of the value positions (last sweep
    varies fastest), decoded from ``spark.range`` in each task: no cross join
    and no global window.
    """
    sweeps = sweeps or DEFAULT_SWEEPS
    sizes = [len(v) for _, v in sweeps]
    total = reduce(lambda a, b: a * b, sizes, 1)
    cols = [F.col("id").alias("policy_id")]
    radix = total
    for (name, values), size in zip(sweeps, sizes):
        radix //= size
        pos = (F.floor(F.col("id") / F.lit(radix)) % size).cast("int")
        cols.append(F.element_at(F.array(*[F.lit(v) for v in values]), pos + 1).alias(name))
    return spark.range(total).select(*cols)


def policy_unpivot(policies: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """policy_id, service, price: one row per (policy, service)."""
    rows = ", ".join(f"named_struct('service', '{s}', 'price', {s}_price)" for s in SERVICE_NAMES)
    return policies.selectExpr("policy_id", *(keep or []), f"inline(array({rows}))")


def policy_features(policies: DataFrame) -> DataFrame:
    """policy_id, service and the six model features under the policy's scoring context.

    population 1.1e7, congestion 0.65 + 0.3 * fuel_tax, signal_load 0.6.
    """
    long = policy_unpivot(policies, keep=["fuel_tax", "festival", "holiday"])
    return long.selectExpr(
        "policy_id", "service", "price",
        f"{d(BASE_POPULATION)} AS population",
        f"{d(BASE_CONGESTION)} + {d(FUEL_TAX_CONGESTION)} * fuel_tax AS congestion",
        f"{d(SCORING_SIGNAL_LOAD)} AS signal_load",
        "CAST(festival AS INT) AS festival", "CAST(holiday AS INT) AS holiday")


def score_elastic(features: DataFrame, demand_decimals: int | None = 4, revenue_decimals: int | None = 2,
                  services: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """policy_id, service, demand, revenue from the closed-form curve (no season, no noise).

    ``services``: an optional dimension table replacing the built-in one.
    ``keep``: features that are carried along.
    """
    keep = keep or []
    j = with_service_attributes(features, services)
    demand = elastic_demand_sql("service", "price", "base_price", "base_demand", "elasticity", "congestion",
                                "festival", "holiday")
    out = j.selectExpr("policy_id", "service", "price", f"{demand} AS demand", *keep)
    return out.selectExpr("policy_id", "service", f"{rounded_sql('demand', demand_decimals)} AS demand",
                          f"{rounded_sql('demand * price', revenue_decimals)} AS revenue", *keep)


#: Bits of the low part of a sum's units.
LOW_BITS = 24


def policy_totals(scored: DataFrame, demand_scale: int | None = None, revenue_scale: int | None = None) -> DataFrame:
    """Per service: number of policies, mean/min/max demand and revenue.

    With scales the means are exact: a value's units are added as a high and a
    low part in 64-bit integers, which over 2^39 rows cannot overflow, and put
    together in DECIMAL(38,0) at the end.  One exchange of a row for each
    service and task.
    """
    aggs, scales = [F.count(F.lit(1)).alias("policies")], {"demand": demand_scale, "revenue": revenue_scale}
    for m, scale in scales.items():
        if scale is None:
            mean = F.avg(m)
        else:
            units = scaled(m, scale)
            high, low = F.shiftright(units, LOW_BITS), units.bitwiseAND(F.lit((1 << LOW_BITS) - 1))
            total = (F.sum(high).cast("decimal(38,0)") * F.lit(1 << LOW_BITS).cast("decimal(9,0)")
                     + F.sum(low).cast("decimal(38,0)"))
            mean = total.cast("double") / (F.nullif(F.count(m), F.lit(0)).cast("double") * F.lit(float(10 ** scale)))
        aggs += [mean.alias(f"avg_{m}"), F.min(m).alias(f"min_{m}"), F.max(m).alias(f"max_{m}")]
    return scored.groupBy("service").agg(*aggs)


# ------------------------------------------------- choosing among policies

#: Inputs that a sensitivity sweep changes, and by how much of their value.
SWEPT = [c for c, _, _ in POLICY_RANGES]
STEPS = (-0.2, -0.1, 0.0, 0.1, 0.2)


def _with_totals(rows: DataFrame, cases: list[tuple[dict[str, str], str]], keep: list[str], demand_decimals: int | None = 4,
                 revenue_decimals: int | None = 2) -> DataFrame:
    """``keep`` and, for each case ``i``, ``demand_i, revenue_i``: totals over the services, as ``score_elastic`` gives them.

    A case is a price for each service and a fuel tax, as Spark SQL text.  Each
    step is a projection of its own, so a curve is worked out once and the
    whole row stays in generated code.
    """
    each = [(i, s, prices[s], tax) for i, (prices, tax) in enumerate(cases) for s in SERVICE_NAMES]
    priced = rows.selectExpr(*keep, "festival", "holiday", *[f"{p} AS p_{i}_{s}" for i, s, p, _ in each],
                             *[f"{d(BASE_CONGESTION)} + {d(FUEL_TAX_CONGESTION)} * {tax} AS c_{i}" for i, (_, tax) in enumerate(cases)])
    of = {s: (base_price, base_demand, elasticity) for s, base_price, base_demand, elasticity in SERVICES}
    curve = lambda i, s: elastic_demand_sql(f"'{s}'", f"p_{i}_{s}", *[d(x) for x in of[s]], f"c_{i}", "festival", "holiday")
    curves = priced.selectExpr(*keep, *[f"p_{i}_{s}" for i, s, _, _ in each], *[f"{curve(i, s)} AS x_{i}_{s}" for i, s, _, _ in each])
    total = lambda i, one: " + ".join(one(i, s) for s in SERVICE_NAMES)
    demand = lambda i, s: rounded_sql(f"x_{i}_{s}", demand_decimals)
    revenue = lambda i, s: rounded_sql(f"x_{i}_{s} * p_{i}_{s}", revenue_decimals)
    return curves.selectExpr(*keep, *[f"{total(i, demand)} AS demand_{i}" for i in range(len(cases))],
                             *[f"{total(i, revenue)} AS revenue_{i}" for i in range(len(cases))])


def policy_outcomes(policies: DataFrame) -> DataFrame:
    """``policy_id, demand, revenue``: a policy's totals over its services, each policy in its own row."""
    given = ({s: f"{s}_price" for s in SERVICE_NAMES}, "fuel_tax")
    return _with_totals(policies, [given], ["policy_id"]).selectExpr("policy_id", "demand_0 AS demand", "revenue_0 AS revenue")


def policy_sensitivity(policies: DataFrame, steps: tuple[float, ...] = STEPS) -> DataFrame:
    """``policy_id, variable, step, value, demand, revenue, change``: every policy with one input changed at a time.

    ``demand`` and ``revenue`` are totals over the services; ``change`` is the
    revenue against the step before, NULL for the first.  A policy is exploded to a
    row for each input, the steps of a sweep stand side by side in it, and each
    is held against its neighbour there: no shuffle and no window.
    """
    steps = sorted(set(steps))
    names = ", ".join(f"named_struct('variable', '{v}', 'given', {v})" for v in SWEPT)
    rows = policies.selectExpr("*", f"inline(array({names}))")
    at = lambda c, k: f"CASE WHEN variable = '{c}' THEN {c} * ({d(1)} + {d(k)}) ELSE {c} END"
    cases = [({s: at(f"{s}_price", k) for s in SERVICE_NAMES}, f"({at('fuel_tax', k)})") for k in steps]
    swept = _with_totals(rows, cases, ["policy_id", "variable", "given"])
    points = ", ".join(
        f"named_struct('step', {d(k)}, 'value', given * ({d(1)} + {d(k)}), 'demand', demand_{i}, 'revenue', revenue_{i}, "
        f"'change', {f'revenue_{i} - revenue_{i - 1}' if i else 'CAST(NULL AS DOUBLE)'})" for i, k in enumerate(steps))
    return swept.selectExpr("policy_id", "variable", f"inline(array({points}))")


def _banded(scored: DataFrame, bands_per_unit: int) -> DataFrame:
    return scored.withColumn("band", F.floor(F.col("congestion") * F.lit(float(bands_per_unit))).cast("int"))


def policy_best(scored: DataFrame, bands_per_unit: int = 100) -> DataFrame:
    """``service, band, revenue, ties, first_policy, last_policy``: the highest revenue of each service and congestion band.

    ``scored`` has the policies' ``congestion`` beside their revenue; ``band`` is
    the whole number of ``1 / bands_per_unit`` in it.  ``ties`` policies reach that
    revenue, from ``first_policy`` to ``last_policy``.  Equal revenues are
    counted before the largest is taken, both with partial aggregates in the
    map side, so a service with all policies is no hot key.
    """
    level = (_banded(scored, bands_per_unit).groupBy("service", "band", "revenue")
             .agg(F.count(F.lit(1)).alias("ties"), F.min("policy_id").alias("first_policy"), F.max("policy_id").alias("last_policy")))
    best = level.groupBy("service", "band").agg(F.max(F.struct("revenue", "ties", "first_policy", "last_policy")).alias("b"))
    return best.select("service", "band", "b.*")


def policy_best_rows(scored: DataFrame, bands_per_unit: int = 100) -> DataFrame:
    """``service, band, policy_id, revenue``: every policy that reaches the best revenue of its service and band."""
    rows = _banded(scored, bands_per_unit)
    best = rows.groupBy("service", "band").agg(F.max("revenue").alias("revenue"))
    # at most one row for each service and band
    return rows.join(best, ["service", "band", "revenue"]).select("service", "band", "policy_id", "revenue")


def pareto_frontier(rows: DataFrame, x: str = "revenue", y: str = "demand") -> DataFrame:
    """The rows that no other row beats: none has more of ``x`` or ``y`` without having less of the other.  Ties stay.

    The rows are reduced to the best ``y`` of each ``x`` and dealt out by ranges of
    ``x``.  Each range finds its local frontier by a running maximum; a range's
    points last if they also pass the maximum of all ranges with larger ``x``, which
    is one number for each range.  No pair of rows is compared.  Rows without
    ``x`` or ``y`` are not on the frontier.

    The rows are written first: a filter or join key on ``x`` would otherwise be
    pushed below their projections and work ``x`` out again, in methods too long
    for the JVM to compile, at every pass.  The frontier is written as well, so
    its size is known when the rows are joined to it.
    """
    spark = rows.sparkSession
    path = work_path(spark, "pareto")
    rows.write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    points = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x).agg(F.max(y).alias(y))
    # a written table: the number of a row's range is the same however often it is read
    points.repartitionByRange(F.desc(x)).withColumn("_range", F.spark_partition_id()).write.parquet(f"{path}/ranges")
    points = spark.read.parquet(f"{path}/ranges")
    tops = points.groupBy("_range").agg(F.max(y).alias("_top"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # a row for each range
    tops = tops.select("_range", F.max("_top").over(before).alias("_passed"))
    larger = Window.partitionBy("_range").orderBy(F.desc(x)).rowsBetween(Window.unboundedPreceding, -1)
    local = points.withColumn("_local", F.max(y).over(larger)).filter(F.col("_local").isNull() | (F.col(y) > F.col("_local")))
    lasting = local.join(tops, "_range").filter(F.col("_passed").isNull() | (F.col(y) > F.col("_passed"))).select(x, y)
    lasting.write.parquet(f"{path}/frontier")
    return rows.join(spark.read.parquet(f"{path}/frontier"), [x, y], "left_semi")
