"""Fixtures of the training-data operators' tests; test modules import them by name."""

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def make(spark):
    """Documents from ``(doc_id, text, source)`` rows, with extra columns whose names clash with the operators' own."""
    def build(rows):
        df = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows],
                                   "doc_id long, text string, lang string, source string, n_chars long")
        return (df.withColumn("row", F.lit("x")).withColumn("score", F.lit(-1)).withColumn("size", F.lit(7))
                .withColumn("shard", F.lit(9)).withColumn("kept", F.lit("no")).withColumn("_key", F.lit(1))
                .withColumn("fp", F.lit(2)).withColumn("words", F.lit(3)).withColumn("number", F.lit(4)))
    return build


@pytest.fixture(scope="session")
def labelled(spark):
    def build(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return build
