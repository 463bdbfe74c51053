"""Clustering on several keys at once, and a zone map that skips files for filters on any of them.

Each key's values are cut into ``2^bits`` ranges of about equal numbers of rows; the
bits of a row's range numbers, interleaved, are its place on a space-filling (Z)
curve.  Rows are range-partitioned and sorted by that place, so a file covers a small
box of the key space.  The zone map has each file's smallest and largest value of
every key; a reader takes only the files whose box meets its filter.

The cuts come from a sample of bounded size (``SAMPLE`` rows, by a hash of the keys); they
only shape the files and never decide which rows are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.sources.versions import Manifest, VersionedTable

#: Rows that the cuts are taken from, at most.
SAMPLE = 20_000
BITS = 6
ZONES = "zones"


def key_cuts(df: DataFrame, keys: list[str], bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """For each key up to ``2^bits - 1`` values that cut its rows into ranges."""
    total = df.count()
    share = 1.0 if total <= sample else sample / total
    few = df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 20)) < int(share * (1 << 20)) + 1) if share < 1 else df
    out = {}
    for k in keys:
        values = sorted(r[0] for r in few.select(k).filter(F.col(k).isNotNull()).limit(2 * sample).collect())
        cuts = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        out[k] = sorted(set(cuts))
    return out


def _range_number(key: str, cuts: list) -> Column:
    """How many cuts a value has reached; a null has reached none."""
    reached = [F.when(F.col(key) >= F.lit(c), 1).otherwise(0) for c in cuts]
    tree = reached or [F.lit(0)]
    while len(tree) > 1:                                  # a balanced sum keeps the expression shallow
        tree = [tree[i] + tree[i + 1] if i + 1 < len(tree) else tree[i] for i in range(0, len(tree), 2)]
    return tree[0]


def z_value(numbers: list[Column], bits: int = BITS) -> Column:
    """The numbers' bits interleaved, the first number's first."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, n in enumerate(numbers):
            bit = F.shiftright(n.cast("long"), b).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, b * len(numbers) + len(numbers) - 1 - i))
    return out


def write_zordered(df: DataFrame, path: str, keys: list[str], bits: int = BITS, max_records_per_file: int = 5_000_000,
                   files: int | None = None) -> VersionedTable:
    """Write a versioned table along the curve of ``keys``, with its zone map as a table beside it.

    A hash of the row is the last sort key of the ranges, so rows of one place
    are still dealt over several files.
    """
    spark = df.sparkSession
    cuts = key_cuts(df.select(*keys), keys, bits)
    rows = df.withColumn("_range_numbers", F.array(*[_range_number(k, cuts[k]) for k in keys]))
    rows = rows.withColumn("_z", z_value([F.col("_range_numbers")[i] for i in range(len(keys))], bits))
    order = [F.col("_z"), F.xxhash64(*df.columns)]
    laid = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    laid = laid.sortWithinPartitions("_z").drop("_range_numbers", "_z")
    table, zones = VersionedTable(spark, path), VersionedTable(spark, f"{path.rstrip('/')}-{ZONES}")
    before = spark.conf.get("spark.sql.files.maxRecordsPerFile", None)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", str(max_records_per_file))
    try:
        made = table.commit(laid)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile") if before is None else spark.conf.set("spark.sql.files.maxRecordsPerFile", before)
    zones.commit(zone_map(table, made, keys), note={"of": made.version, "keys": keys})
    return table


def zone_map(table: VersionedTable, version: Manifest, keys: list[str]) -> DataFrame:
    """``file, n`` and for each key ``<key>_low, <key>_high, <key>_nulls``, from a scan of the keys alone."""
    rows = table.read_manifest(version).select(F.col("_metadata.file_path").alias("file"), *keys)
    aggs = [x for k in keys for x in (F.min(k).alias(f"{k}_low"), F.max(k).alias(f"{k}_high"),
                                      F.count_if(F.col(k).isNull()).alias(f"{k}_nulls"))]
    return rows.groupBy("file").agg(F.count(F.lit(1)).alias("n"), *aggs)


def matching_files(spark: SparkSession, path: str, wanted: dict[str, tuple]) -> list[str]:
    """Files whose zones meet ``{key: (low, high)}``; None as a bound is open."""
    zones = VersionedTable(spark, f"{path.rstrip('/')}-{ZONES}").read()
    for k, (low, high) in wanted.items():
        if low is not None:
            zones = zones.filter(F.col(f"{k}_high") >= F.lit(low))
        if high is not None:
            zones = zones.filter(F.col(f"{k}_low") <= F.lit(high))
    return sorted(r.file for r in zones.select("file").collect())


def read_zordered(spark: SparkSession, path: str, wanted: dict[str, tuple] | None = None) -> DataFrame:
    """The rows with ``low <= key <= high`` for every wanted key, from the files that can have any."""
    table, zones = VersionedTable(spark, path), VersionedTable(spark, f"{path.rstrip('/')}-{ZONES}")
    made, mapped = table.manifest(), zones.manifest()
    if made is None:
        raise ValueError(f"there is no table at {path}")
    rows = table.read_manifest(made)
    if not wanted:
        return rows
    if mapped is not None and mapped.note.get("of") == made.version:
        files = matching_files(spark, path, wanted)
        rows = spark.read.schema(made.schema).parquet(*files) if files else spark.createDataFrame([], made.schema)
    for k, (low, high) in wanted.items():
        if low is not None:
            rows = rows.filter(F.col(k) >= F.lit(low))
        if high is not None:
            rows = rows.filter(F.col(k) <= F.lit(high))
    return rows
