"""From raw documents to token ids in five stages.

Each stage works on all that its predecessor kept.  ``run`` writes every
stage's result to the shared work folder as Parquet and reads it back as the
next one's documents; all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from urbanlake.llm import mixing, pieces, quality, simhash, toxicity
from urbanlake.llm.common import saved
from urbanlake.llm.queries import vocabulary
from urbanlake.session import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field scores at a half or more go."""
    return toxicity.without_toxic(docs, read_table(spark, sf_dir, "labels"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or the log-likelihood ratio go."""
    return quality.good_documents(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints stays: three-word shingles, three bits."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, shuffled within its shards."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document drawn, and whether they decode to its text."""
    return pieces.encode_documents(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("source mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL expresses neither the learnt field nor the encoder; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = saved(docs, f"pipeline-{i}-{name.replace(' ', '-')}")
    return docs
