"""Raw CSV files of one folder whose headers differ.

The folder is read as lines with the path of their file.  A file's first line is
its header; the headers are a table of one row for each file, found in one
aggregate over the lines.  The few distinct headers each become a branch that
parses a line by that header and puts the fields under the expected names, so
all files are typed in one pass whatever the order of their columns: expected
columns that a file lacks are NULL, further ones go to the JSON object
``_extra``, and a line with too many or too few fields is kept in
``_corrupt_record``.  A stream works file by file as they arrive, so a header
never seen before, with new columns too, needs no restart.

A quoted field may hold separators, but no line end.  Lines that equal their
file's header are headers, also further down (as in files put together).  Files
without a line give no rows.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from urbanlake.schemas import BRONZE_HEADERS, BRONZE_SCHEMA, CORRUPT, EXTRA
from urbanlake.sources.csv import FILES_PER_BATCH, read_schema
from urbanlake.sources.tables import TABLES, with_comment

#: Distinct headers of one batch; more are not variants of a table.
MOST_HEADERS = 500
LINES = "value string"


def _lines(rows: DataFrame) -> DataFrame:
    """``value, file, block``: lines that hold something, with their file and where their split of it starts."""
    line = F.regexp_replace("value", "\r$", "")
    return rows.select(line.alias("value"), F.col("_metadata.file_path").alias("file"),
                       F.col("_metadata.file_block_start").alias("block")).filter(line != "")


def header_table(lines: DataFrame) -> DataFrame:
    """``file, header``: the first line of every file, without a byte order mark."""
    # within a split lines come in order, and splits are ordered by where they start
    at = lines.withColumn("at", F.struct("block", F.monotonically_increasing_id().alias("row")))
    return at.groupBy("file").agg(F.regexp_replace(F.min_by("value", "at"), "^\ufeff", "").alias("header"))


def _parsed(header: str) -> str:
    """Spark SQL text that parses ``value`` by a header into the columns of bronze."""
    names = next(csv.reader(io.StringIO(header)))
    if len(set(names)) != len(names):
        raise ValueError(f"a column stands twice in the header {header!r}")
    quote = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in read_schema(names))
    row = f"from_csv(value, {quote(ddl)}, map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', {quote(CORRUPT)}))"
    field = lambda n: f"r.`{n.replace('`', '``')}`"
    extra = [n for n in names if n not in BRONZE_HEADERS]
    further = f"to_json(map({', '.join(x for n in extra for x in (quote(n), field(n)))}))" if extra else "CAST(NULL AS STRING)"
    columns = [f"{quote(h)}, {field(h) if h in names else 'CAST(NULL AS STRING)'}" for h in BRONZE_HEADERS]
    made = f"named_struct({', '.join([*columns, f'{quote(CORRUPT)}, {field(CORRUPT)}', f'{quote(EXTRA)}, {further}'])})"
    return f"transform(array({row}), r -> {made})[0]"      # the line is parsed once, not for each column


def by_header(lines: DataFrame) -> DataFrame:
    """The columns of bronze from the lines of any number of files."""
    headers = header_table(lines)
    known = [r.header for r in headers.select("header").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(known) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different headers")
    if not known:
        return lines.sparkSession.createDataFrame([], BRONZE_SCHEMA)
    rows = lines.join(headers, "file").filter(F.regexp_replace("value", "^\ufeff", "") != F.col("header"))
    branches = F.expr(_parsed(known[0]))
    if len(known) > 1:
        branches = F.when(F.col("header") == known[0], branches)
        for h in known[1:]:
            branches = branches.when(F.col("header") == h, F.expr(_parsed(h)))
    return rows.select(branches.alias("r")).select("r.*")


def read_bronze_mixed(spark: SparkSession, path: str) -> DataFrame:
    """All files of a folder, each by its own header."""
    return by_header(_lines(spark.read.schema(LINES).text(path)))


def start_bronze_mixed(spark: SparkSession, source_dir: str, bronze_dir: str, checkpoint: str, available_now: bool = True,
                       max_files_per_trigger: int = FILES_PER_BATCH) -> StreamingQuery:
    """Raw CSV files -> bronze Parquet in a folder for each batch, which a replay of the batch replaces."""
    def take(batch: DataFrame, batch_id: int) -> None:
        rows = with_comment(by_header(batch), TABLES["bronze"].comment)
        rows.write.mode("overwrite").parquet(f"{bronze_dir}/batch={batch_id}")

    lines = _lines(spark.readStream.schema(LINES).option("maxFilesPerTrigger", str(max_files_per_trigger)).text(source_dir))
    w = lines.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()
