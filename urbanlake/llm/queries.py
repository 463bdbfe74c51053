"""Registered queries of this package and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm import (
    licenses,
    lmscore,
    mixing,
    periodic,
    pieces,
    pstable,
    quality,
    simhash,
    streamdedup,
    tokenfile,
    toxicity,
    warc,
    whitening,
)
from urbanlake.session import read_table, table_path, work_path


def vocabulary(name: str) -> str:
    """Path of one of the public tokenizers' files."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.98 or more among all vectors of one label."""
    return pstable.near_duplicates(read_table(spark, sf_dir, "embeddings"), min_cosine=0.98)


#: Brute force: every pair of one label, then everything that links reach.
ORACLE["op1_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.c AS component_id, e.vec_id = c.c AS kept
FROM embeddings e
LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) n ON n.x = e.vec_id
LEFT JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) c ON c.x = e.vec_id
"""


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-word shingles, links at 3 or fewer differing bits."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the log-likelihood ratio's verdict on every document."""
    return quality.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1 share 150% of all words, none above twice its own; the shard of each time a document is taken."""
    plan = mixing.mixing_plan(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("shards")).alias("taken"),
                       F.concat_ws(",", F.col("shards").cast("array<string>")).alias("shards"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and fuzzy notices in every document."""
    found = licenses.license_scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                        F.size("spans").cast("long").alias("n_notices"))


@query
def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back through the merged index."""
    return warc.archive_round_trip(read_table(spark, sf_dir, "pages")).drop("urlkey", "captured")


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to packed files and read back."""
    return tokenfile.token_files(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids as count and checksum, and whether they decode to the text."""
    return pieces.digests(pieces.encode_documents(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model")))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score by the field learnt on the training fold."""
    scored = toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"))


@query
def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's trigram backoff score by all other documents; rounded, as sums depend on their order."""
    scored = lmscore.backoff_scores(read_table(spark, sf_dir, "documents"))
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).otherwise(F.lit(0.0))
    return scored.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round(mean, 4).alias("mean_log_score"))


ORACLE["op2_lm_scores"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents),
t AS (SELECT doc_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM d),
g AS (SELECT doc_id, n, i, w AS g1,
        lag(w) OVER o || ' ' || w AS g2, lag(w, 2) OVER o || ' ' || lag(w) OVER o || ' ' || w AS g3
      FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
c1 AS (SELECT *, count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY doc_id, g1) AS n1,
              count(*) OVER () - n AS others FROM g),
c2 AS (SELECT *, CASE WHEN g2 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY doc_id, g2) END AS n2 FROM c1),
c3 AS (SELECT *, CASE WHEN g3 IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY doc_id, g3) END AS n3 FROM c2),
b AS (SELECT *, lag(n1) OVER o AS b1, lag(n2) OVER o AS b2, least(i, 3) AS m
      FROM c3 WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT doc_id, sum(CASE
        WHEN n3 > 0 THEN ln(n3 / b2)
        WHEN n2 > 0 THEN ln(n2 / b1) + (m - 2) * ln(0.4)
        WHEN n1 > 0 THEN ln(n1 / others) + (m - 1) * ln(0.4)
        ELSE ln(1.0 / (others + 1.0)) + m * ln(0.4) END) AS x
      FROM b GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, round(coalesce(x, 0), 4) AS log_score,
       round(CASE WHEN len(ws) > 0 THEN x / len(ws) ELSE 0 END, 4) AS mean_log_score
FROM d LEFT JOIN s USING (doc_id)
"""


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: documents whose checksum ends in 0 with the loop that the contract puts into them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    # each transform of one struct names a value once; a plain column would be worked out anew for every word
    words = rf"transform(array(named_struct('g', g, 'words', regexp_extract_all(text, r'{periodic.WORD}', 0))), s -> "
    start = "transform(array(named_struct('words', s.words, 'n', size(s.words), 'g', s.g, 'a', CAST(s.g % size(s.words) AS INT))), t -> "
    loop = ("array_join(transform(t.words, (w, i) -> CASE WHEN i < t.a THEN w "
            "ELSE t.words[CAST(t.a + (i - t.a) % (1 + (t.n - t.a) div (3 + t.g % 8)) AS INT)] END), ' ')")
    done = f"CASE WHEN size(s.words) > 0 THEN {start}{loop})[0] ELSE '' END"
    rows = docs.select("doc_id", "text", F.floor(h / 10).cast("long").alias("g"), (h % 10 == 0).alias("loops"))
    return rows.select("doc_id", F.expr(f"CASE WHEN loops AND text IS NOT NULL THEN {words}{done})[0] ELSE text END").alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, and the digest of the text without their repeats."""
    return periodic.digests(periodic.collapsed(looped(read_table(spark, sf_dir, "documents"))))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the four leading components."""
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"), components=4, grid=256)


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document streamed through the keyed state, with the document that stays in its place."""
    docs = read_table(spark, sf_dir, "documents")
    stream = streamdedup.document_stream(spark, table_path(sf_dir, "documents"), docs.schema)
    found = streamdedup.deduplicate(stream, work_path(spark, "exact-dedup"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


ORACLE["op13_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""
