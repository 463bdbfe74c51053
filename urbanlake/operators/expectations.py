"""Named data-quality expectations with actions (warn, drop, fail).

An expectation is a SQL predicate over the output columns of a dataset.  A row
passes when the predicate is TRUE; a NULL predicate fails unless the
expectation says ``null_passes``.  Actions:

* ``warn``  keep the row, count the failure;
* ``drop``  remove the row, count the failure;
* ``fail``  stop the job at the first failing row.

Counting is one distributed aggregate (batch) or a named ``observe`` metric
per micro-batch (stream), measured on the rows *before* any drop.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlake.schemas import SENSOR_TYPES, SILVER_RULES

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"
    null_passes: bool = False

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}; expected one of {ACTIONS}")

    def passed_sql(self) -> str:
        """TRUE exactly when the row passes (a NULL predicate counts as ``null_passes``)."""
        return f"coalesce(({self.predicate}), {str(self.null_passes).lower()})"

    def passed(self) -> Column:
        return F.expr(self.passed_sql())


def expect(name: str, predicate: str, null_passes: bool = False) -> Expectation:
    return Expectation(name, predicate, "warn", null_passes)


def expect_or_drop(name: str, predicate: str, null_passes: bool = False) -> Expectation:
    return Expectation(name, predicate, "drop", null_passes)


def expect_or_fail(name: str, predicate: str, null_passes: bool = False) -> Expectation:
    return Expectation(name, predicate, "fail", null_passes)


_quoted_types = ", ".join("'" + t + "'" for t in SENSOR_TYPES)

# The quality rules of the silver sensor table, in declaration order.
SILVER_EXPECTATIONS: list[Expectation] = [
    (expect_or_drop if drop else expect)(name, predicate.format(types=_quoted_types)) for name, predicate, drop in SILVER_RULES
]


def _all_sql(rules: list[Expectation]) -> str:
    return " AND ".join(r.passed_sql() for r in rules) if rules else "true"


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _fail_guard(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    fails = [r for r in rules if r.action == "fail"]
    if not fails:
        return df
    # raise_error inside the plan: no extra pass, works on streams too.
    branches = " ".join(f"WHEN NOT {r.passed_sql()} THEN raise_error({_quote('expectation ' + r.name + ' failed')})"
                        for r in fails)
    return df.filter(F.expr(f"CASE {branches} ELSE true END"))


def apply_expectations(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Rows that pass every drop rule (warn rules only count; fail rules raise)."""
    df = _fail_guard(df, rules)
    drops = [r for r in rules if r.action == "drop"]
    return df.filter(F.expr(_all_sql(drops))) if drops else df


def quarantine(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Rows removed by drop rules, with the names of the rules they broke (comma-joined, rule order)."""
    drops = [r for r in rules if r.action == "drop"]
    if not drops:
        return df.withColumn("failed_expectations", F.lit(None).cast("string")).limit(0)
    failed = ", ".join(f"CASE WHEN NOT {r.passed_sql()} THEN {_quote(r.name)} END" for r in drops)
    return (df.filter(F.expr(f"NOT ({_all_sql(drops)})"))
            .withColumn("failed_expectations", F.expr(f"concat_ws(',', {failed})")))


def metric_sql(rules: list[Expectation]) -> list[str]:
    """One pass/fail counter pair per rule as SQL text."""
    out = []
    for r in rules:
        out.append(f"count_if({r.passed_sql()}) AS `{r.name}__passed`")
        out.append(f"count_if(NOT {r.passed_sql()}) AS `{r.name}__failed`")
    return out


def metric_columns(rules: list[Expectation]) -> list[Column]:
    """One pass/fail counter pair per rule, for ``agg`` or ``observe``."""
    return [F.expr(e) for e in metric_sql(rules)]


def dq_metrics(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """expectation, action, passed, failed: one row per rule, counted over all input rows.

    One global aggregate: each task reduces its rows to 2*len(rules) counters,
    so nothing but counters is shuffled.
    """
    counts = df.agg(*metric_columns(rules))
    rows = ", ".join(f"{_quote(r.name)}, {_quote(r.action)}, CAST(`{r.name}__passed` AS BIGINT), "
                     f"CAST(`{r.name}__failed` AS BIGINT)" for r in rules)
    return counts.selectExpr(f"stack({len(rules)}, {rows}) AS (expectation, action, passed, failed)")


def observe_expectations(df: DataFrame, rules: list[Expectation], name: str = "dq") -> DataFrame:
    """Attach the counters as an observed metric (read from query progress on streams)."""
    return df.observe(name, *metric_columns(rules))


def metrics_from_observation(values: dict, rules: list[Expectation]) -> list[tuple[str, str, int, int]]:
    """Turn an observed-metrics dict into (expectation, action, passed, failed) rows."""
    return [(r.name, r.action, int(values.get(f"{r.name}__passed", 0)), int(values.get(f"{r.name}__failed", 0)))
            for r in rules]
