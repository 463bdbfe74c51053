"""Silver: rename the raw Turkish columns, type them, add processing time.

Casts are ``try_cast``: a malformed field becomes NULL (and is then seen by the
quality rules) instead of failing a whole micro-batch under ANSI mode.  Numbers
are read as doubles first, so a count written ``12.0`` is 12; NaN and
infinities are no measurements and become NULL; a time with a zone offset is
the wall-clock time of ``zone`` at that instant, one without stays as written.
``castable_expectations`` counts what does not parse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.operators.expectations import SILVER_EXPECTATIONS, Expectation, apply_expectations, expect
from urbanlake.schemas import BRONZE_COLUMNS, CORRUPT

#: Texts that end in a zone offset after a time of day.
OFFSET = "[0-9]:[0-9]{2}.*(Z|[+-][0-9]{1,2}(:?[0-9]{2})?)$"


def typed_sql(header: str, spark_type: str, zone: str = "UTC") -> str:
    """One raw text column as its silver type (Spark SQL text)."""
    c = f"`{header}`"
    if spark_type == "string":
        return c
    if spark_type == "timestamp_ntz":
        instant = f"CAST(try_cast({c} AS TIMESTAMP) AS TIMESTAMP_NTZ)"
        return (f"CASE WHEN {c} RLIKE '{OFFSET}' THEN convert_timezone(current_timezone(), '{zone}', {instant}) "
                f"ELSE try_cast({c} AS TIMESTAMP_NTZ) END")
    if spark_type == "timestamp":
        return f"try_cast({c} AS TIMESTAMP)"
    number = f"try_cast({c} AS DOUBLE)"
    finite = f"CASE WHEN abs({number}) < double('Infinity') THEN {number} END"
    return finite if spark_type == "double" else f"try_cast({finite} AS {spark_type.upper()})"


def castable_expectations(zone: str = "UTC") -> list[Expectation]:
    """Warn rules over the raw text columns: a value is present but does not parse as its silver type.

    Counted on bronze (before typing), so a value that becomes NULL is told
    apart from one that was missing in the file.  ``well_formed`` counts the
    rows whose number of fields is not the header's.
    """
    rules = [expect(f"castable_{n}", f"`{h}` IS NULL OR ({typed_sql(h, t, zone)}) IS NOT NULL")
             for h, n, t in BRONZE_COLUMNS if t != "string"]
    return [*rules, expect("well_formed", f"`{CORRUPT}` IS NULL")]


def project_bronze(bronze: DataFrame, processed_at: bool = True, keep: list[str] | None = None,
                   timestamp_type: str = "timestamp_ntz", zone: str = "UTC") -> DataFrame:
    """Raw text columns -> English names and Spark types (optionally processed_at).

    ``keep``: extra columns passed through unchanged in front (e.g. a key).
    ``timestamp_type``: ``timestamp_ntz`` keeps the files' wall-clock times
    (independent of the session time zone; times with an offset are put in
    ``zone``); ``timestamp`` reads them in the session time zone as instants.
    """
    types = {n: (timestamp_type if t.startswith("timestamp") else t) for _, n, t in BRONZE_COLUMNS}
    cols = [F.col(k) for k in keep or []] + [F.expr(typed_sql(h, types[n], zone)).alias(n) for h, n, _ in BRONZE_COLUMNS]
    if processed_at:
        cols.append(F.current_timestamp().alias("processed_at"))
    return bronze.select(*cols)


def silver(bronze: DataFrame, rules: list[Expectation] | None = None, processed_at: bool = True) -> DataFrame:
    """Typed, quality-filtered sensor rows.  Rules run on output names, after the projection."""
    return apply_expectations(project_bronze(bronze, processed_at), SILVER_EXPECTATIONS if rules is None else rules)
