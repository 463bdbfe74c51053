"""Quality rules by a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Unigrams and bigrams of every document are hashed into ``buckets`` bins.  Over
all documents the bins' counts are the raw multinomial, over the documents that
labels call good the target multinomial.  A bin's share of the target is set
against its share of the raw one with ``ADD`` grams added to the target's count
and to the count that the raw share lets expect: a bin with little evidence
claims nothing, one with much claims its ratio, however large the whole target
is.  (With ``prior``, a Dirichlet prior of that many grams takes ADD's place;
its pull on every bin depends on the target's size.)  A document's score is the mean over its grams of
``ln(target(bin) / raw(bin))``, and a document is kept when no base rule fails
and the score is at least ``threshold``: the same verdict in every run.

Both multinomials and the scores cover all documents.  The one table that
reaches every task is the bins' weights, ``buckets`` doubles whatever the input.

Defined cases: a null or blank text has no word, fails the base rules and has
score 0; a document without a label, or with a null one, counts in the raw
multinomial only; several labels of a document count as good if one is; without
any good document every weight is 0.  Repeated rows are documents of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import saved

#: ASCII white space: what stands between words.
WHITE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: Grams added to each bin's counts, and the least mean score that is kept; chosen together.
ADD = 10.0
THRESHOLD = -0.05


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def _chain_hash(h: Column, n: int) -> Column:
    """Hashes of every ``n`` neighbours of an array of hashes."""
    heads = F.slice(h, F.lit(1), F.greatest(F.size(h) - (n - 1), F.lit(0)))
    return F.transform(heads, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)]))


def n_repeat_words(windows: Column) -> Column:
    """Words inside windows whose hash occurs twice or more; ``windows`` holds a hash for each start.

    Equal hashes are neighbours after sorting.  Their starts, in order, cover
    WINDOW words each, less what the next start covers too.
    """
    def repeated(s: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            return (F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(F.filter(s, again), lambda x: x["p"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    ordered = F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    found = _let(_let(ordered, repeated), covered)
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), found).otherwise(F.lit(0)).cast("long")


def gram_bins(h: Column, buckets: int) -> Column:
    """Bins of the unigrams and bigrams; ``buckets`` is a power of two."""
    return F.transform(F.concat(h, _chain_hash(h, 2)), lambda x: x.bitwiseAND(F.lit(buckets - 1)).cast("int"))


def _hashes(docs: DataFrame, *keep: str) -> DataFrame:
    """The word hashes as column ``h``."""
    return docs.select(*keep, words_of(F.col("text")).alias("words")).select(
        *keep, F.transform("words", lambda x: F.xxhash64(x)).alias("h"))


def gram_weights(docs: DataFrame, labels: DataFrame, buckets: int, prior: float | None) -> DataFrame:
    """``bin, weight``: ln of the target's share over the raw share, for each bin that occurs."""
    added, pull = (ADD, 0.0) if prior is None else (0.0, float(prior))
    good = (labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1")
            .select("doc_id", F.lit(1).alias("good")))
    told = docs.select("doc_id", "text").join(good.hint("shuffle_hash"), "doc_id", "left")
    counts = saved(_hashes(told, "good").select("good", F.explode(gram_bins(F.col("h"), buckets)).alias("bin"))
                   .groupBy("bin").agg(F.count(F.lit(1)).alias("raw"), F.count("good").alias("target")), "gram-counts")
    all_raw, all_target = counts.agg(F.sum("raw")).scalar(), counts.agg(F.sum("target")).scalar()
    share = F.col("raw") / all_raw
    return counts.select("bin", F.ln((F.col("target") + share * F.lit(pull) + F.lit(added))
                                     / (share * (all_target + F.lit(pull)) + F.lit(added))).alias("weight"))


def judged(docs: DataFrame, labels: DataFrame, carried: Column, buckets: int = 1 << 16, prior: float | None = None,
           threshold: float = THRESHOLD) -> DataFrame:
    """``row`` (the carried struct), the base counts, ``score, number, base_failed, kept``; one row per row of ``docs``."""
    spark = docs.sparkSession
    bins = spark.range(buckets).select(F.col("id").cast("int").alias("bin"))
    row = (bins.join(gram_weights(docs, labels, buckets, prior), "bin", "left")
           .agg(F.sort_array(F.collect_list(F.struct("bin", F.coalesce("weight", F.lit(0.0)).alias("weight")))).alias("w"))
           .select(F.transform("w", lambda x: x["weight"]).alias("weights")))
    weights = row.scalar()

    text = F.coalesce(F.col("text"), F.lit(""))
    without = lambda chars: F.length(F.translate(text, chars, ""))
    base = docs.select(
        carried.alias("row"), without(WHITE).cast("long").alias("word_chars"),
        (F.length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"), words_of(F.col("text")).alias("words"))
    counted = base.select("row", "word_chars", "n_symbols", "n_dup_lines", F.size("words").cast("long").alias("n_words"),
                          F.transform("words", lambda x: F.xxhash64(x)).alias("h"))
    hashed = counted.select("*", _chain_hash(F.col("h"), WINDOW).alias("windows"), weights.alias("weights"))
    scored = hashed.select(
        "row", "n_words", "word_chars", "n_symbols", "n_dup_lines", n_repeat_words(F.col("windows")).alias("n_repeat_words"),
        (F.aggregate(gram_bins(F.col("h"), buckets), F.lit(0.0), lambda a, x: a + F.get(F.col("weights"), x))
         / F.greatest(2 * F.col("n_words") - 1, F.lit(1))).alias("score"),
        F.monotonically_increasing_id().alias("number"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return scored.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed, score, kept``; one row per row of ``docs``."""
    found = judged(docs, labels, F.struct("doc_id"), **options)
    return found.select("row.doc_id", *[c for c in found.columns if c not in ("row", "number")])


def good_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The kept rows of ``docs``, as they are."""
    # The row number keeps the filter above the arrays: pushed below, it would compute them anew for each element.
    found = judged(docs, labels, F.struct("*"), **options)
    return found.filter(F.col("kept") & (F.col("number") >= 0)).select("row.*")
