"""Spark session defaults and the shared work folder.

Intermediate tables, stream checkpoints and saved models go under the
folder the cluster names in ``spark.checkpoint.dir`` (a shared file system on
a real cluster).  A folder of our own is only chosen when the session has none
set, which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app_name: str = "urbanlake",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and the bench; on a cluster use the cluster's session."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("URBANLAKE_DRIVER_MEMORY", "16g")))
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is configured."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="urbanlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/urbanlake/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_SCHEMAS: dict[tuple[str, int], object] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """Batch scan of one input table; Catalyst prunes columns and pushes filters.

    The schema of a local file is inferred once per file version (path and
    modification time) and then passed to the reader, so repeated queries skip
    the footer read; other file systems infer it as usual.
    """
    path = table_path(sf_dir, name)
    if ":" in path or not os.path.exists(path):          # URI or remote store: plain read
        return spark.read.parquet(path)
    key = (os.path.abspath(path), os.stat(path).st_mtime_ns)
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)
