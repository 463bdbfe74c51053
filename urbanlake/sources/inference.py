"""Column types of raw text, inferred by one mergeable aggregate.

For every column the aggregate counts the values that are there and how many of
them read as each type of a lattice: whole numbers are also decimal numbers,
days are also times, and everything is text.  Counts of two batches are added, so
types grow as files arrive and never depend on their order or on a sample.
``typed_by`` reads the text by these types; a value that doesn't fit, as a later
batch may bring one, is NULL in its column and kept in the JSON object
``_rescued``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a value of each type looks like, the narrowest first; each one's cast is tried as well.
WHOLE = r"^[+-]?[0-9]{1,18}$"
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{1,3})?$"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?)?$"
LOGICAL = r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"
LATTICE: list[tuple[str, str, str]] = [
    ("boolean", LOGICAL, "boolean"),
    ("bigint", WHOLE, "bigint"),
    ("double", NUMBER, "double"),
    ("date", DAY, "date"),
    ("timestamp", TIME, "timestamp_ntz"),
]


def reads_as(column: str, pattern: str, spark_type: str) -> str:
    """Whether a text column's value is of a type (Spark SQL text)."""
    c = f"`{column}`"
    return f"({c} RLIKE '{pattern}' AND try_cast({c} AS {spark_type}) IS NOT NULL)"


def type_counts(text: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``column, n_values, n_boolean, n_bigint, n_double, n_date, n_timestamp``: one aggregate over all rows and columns."""
    columns = columns or text.columns
    counts = []
    for i, c in enumerate(columns):
        counts += [f"count(`{c}`) AS c{i}_values", *[f"count_if({reads_as(c, p, t)}) AS c{i}_{n}" for n, p, t in LATTICE]]
    names = ["values", *[n for n, _, _ in LATTICE]]
    one = text.agg(*[F.expr(x) for x in counts])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"c{i}_{n}").alias(f"n_{n}") for n in names]) for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*rows)))


def merged_counts(counts: list[DataFrame]) -> DataFrame:
    """The counts of several batches put together."""
    rows = reduce(lambda a, b: a.unionByName(b), counts)
    return rows.groupBy("column").agg(*[F.sum(c).alias(c) for c in rows.columns if c != "column"])


def inferred_types(counts: DataFrame) -> DataFrame:
    """The counts and each column's ``type``: the narrowest that all of its values read as; text where there are none."""
    branches = F.when(F.col("n_values") == 0, F.lit("string"))
    for name, _, _ in LATTICE:
        branches = branches.when(F.col(f"n_{name}") == F.col("n_values"), F.lit(name))
    return counts.withColumn("type", branches.otherwise(F.lit("string")))


def typed_by(text: DataFrame, types: dict[str, str], keep: list[str] | None = None) -> DataFrame:
    """The columns as the given types; values that are not of them in ``_rescued``, as JSON by column."""
    known = {n: (p, t) for n, p, t in LATTICE}
    columns, lost = [F.col(f"`{k}`") for k in keep or []], []
    for c, name in types.items():
        if name == "string":
            columns.append(F.col(f"`{c}`"))
            continue
        pattern, spark_type = known[name]
        good = reads_as(c, pattern, spark_type)
        columns.append(F.expr(f"CASE WHEN {good} THEN CAST(`{c}` AS {spark_type}) END").alias(c))
        lost.append(F.when(F.expr(f"`{c}` IS NOT NULL AND NOT {good}"), F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").alias("value"))))
    rescued = F.map_from_entries(F.array_compact(F.array(*lost))) if lost else None
    json = F.lit(None).cast("string") if rescued is None else F.when(F.size(rescued) > 0, F.to_json(rescued))
    return text.select(*columns, json.alias("_rescued"))


def read_types(counts: DataFrame) -> dict[str, str]:
    """Type by column: one row for each column of the table."""
    return {r["column"]: r["type"] for r in inferred_types(counts).select("column", "type").collect()}
