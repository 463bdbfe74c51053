"""Raw sensor CSV files (the bronze input).

Files are UTF-8 with a header row; columns carry Turkish names with spaces,
apostrophes and slashes.  The columns are taken by name: one file's header says
their order (a one-line read when the reader is made), expected columns that it
lacks are NULL and others go to the JSON object ``_extra``.  All fields are read as
text and typed in silver; a row with too many or too few fields keeps its whole
line in ``_corrupt_record``.  A file whose header differs from that of the
others in the folder fails loudly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanlake.schemas import BRONZE_COLUMNS, BRONZE_HEADERS, CORRUPT, EXTRA

CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    # Header names are checked against the read schema: a file in another order
    # fails instead of shifting values into the wrong field.
    "enforceSchema": "false",
}
#: Files that one micro-batch reads at most, so that a backlog of any size is worked off in steps.
FILES_PER_BATCH = 1000


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of the files under ``path``; the expected ones while there is none."""
    try:
        found = spark.read.option("header", "true").option("encoding", "UTF-8").csv(path).columns
    except Exception as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "PATH_NOT_FOUND" in str(e):
            return list(BRONZE_HEADERS)
        raise
    return found or list(BRONZE_HEADERS)


def read_schema(header: list[str]) -> T.StructType:
    return T.StructType([T.StructField(h, T.StringType(), True) for h in [*header, CORRUPT]])


def by_name(raw: DataFrame) -> DataFrame:
    """The expected columns in their order, the malformed line, and further columns as a JSON object."""
    present = [c for c in raw.columns if c != CORRUPT]
    extra = [c for c in present if c not in BRONZE_HEADERS]
    further = F.to_json(F.create_map(*[x for c in extra for x in (F.lit(c), F.col(f"`{c}`"))])) if extra else F.lit(None)
    return raw.select(*[(F.col(f"`{h}`") if h in present else F.lit(None).cast("string")).alias(h) for h in BRONZE_HEADERS],
                      F.col(CORRUPT), further.cast("string").alias(EXTRA))


def read_bronze_batch(spark: SparkSession, path: str) -> DataFrame:
    return by_name(spark.read.schema(read_schema(header_of(spark, path))).options(**CSV_OPTIONS).csv(path))


def read_bronze_stream(spark: SparkSession, path: str, max_files_per_trigger: int = FILES_PER_BATCH) -> DataFrame:
    """Incremental CSV directory source: each file is read once (tracked in the checkpoint)."""
    reader = (spark.readStream.schema(read_schema(header_of(spark, path))).options(**CSV_OPTIONS)
              .option("maxFilesPerTrigger", str(max_files_per_trigger)))
    return by_name(reader.csv(path))


def infer_bronze_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0):
    """Typed schema inferred by a batch pass over the files (stand-in for column-type inference)."""
    return (spark.read.option("header", "true").option("inferSchema", "true")
            .option("samplingRatio", str(sampling_ratio)).csv(path).schema)


def to_bronze_text(typed: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed sensor rows -> raw text columns with the file headers (inverse of silver typing)."""
    return typed.select(*[F.col(k) for k in keep or []],
                        *[F.col(name).cast("string").alias(header) for header, name, _ in BRONZE_COLUMNS])


def write_bronze_csv(typed: DataFrame, path: str, files: int | None = None) -> None:
    """Write sensor rows as raw CSV files (one file per partition)."""
    out = to_bronze_text(typed)
    if files:
        out = out.repartition(files)
    out.write.mode("append").option("header", "true").option("encoding", "UTF-8").csv(path)


__all__ = ["BRONZE_HEADERS", "read_bronze_batch", "read_bronze_stream", "infer_bronze_schema",
           "to_bronze_text", "write_bronze_csv"]
