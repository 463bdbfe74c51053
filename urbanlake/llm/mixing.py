"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree, in DataFrame functions only.

A document's size is its number of words, a source's size their sum.  The
sources, ordered by code point with null last, weigh ``weights`` in turn and
share ``budget`` times all words; no target passes ``most`` times its source,
and what is cut off is shared anew by weight among the others.

Every source is dealt into ``blocks`` blocks by a hash of the document id,
which permutes its documents.  A source at r whole times its size plus a rest
takes all its blocks r times, then fills the rest by classes of length, longest
first: documents longer than the rest, then down to a 4th, a 16th and a 64th of
it, then all shorter ones.  A class takes its share of what is left, in block
and hash order, to the document before or after the share's end: the one that
the shorter classes can make good, else the nearer one.  So no long document
stands in the way of short ones behind it.  The taken blocks are the source's
quota.  The quotas of all sources are split among the
output shards by halving: a node that holds some shards gives its left half
as many blocks as their share, and how many of each source is one draw of the
multivariate hypergeometric distribution.  A leaf is a shard's exact quota of
each source; the shards then draw their quotas as consecutive, so disjoint,
ranges of the source's permuted blocks, and a shard's documents are shuffled
by a hash of their own.

All of it comes from hashes of ids and a seed, so reruns agree.  What meets in
one task is a row for each source, or for each block of one source, or the
documents of one block; a document is decided in its own row from its source's
record, so texts move only to their shards.

Defined cases: null and blank texts have size 0 and are drawn like others (a
source without words has target 0 and is not drawn); a null source is a source;
a null ``doc_id`` hashes as its text; repeated rows are documents of their
own and are drawn alike; an empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlake.llm.common import saved

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST = 2
BLOCKS = 1024
#: A class's documents are longer than the rest divided by this; what is shorter than all is the last class.
PARTS = (1, 4, 16, 64)


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *parts)), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def with_blocks(docs: DataFrame, blocks: int, seed: int) -> DataFrame:
    """Adds ``_key`` (of the source, never null), ``_size``, ``_hash`` and ``_block``."""
    nameless = F.concat(F.lit("text-"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), nameless)))
    return (docs.withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
            .withColumn("_size", F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long"))
            .withColumn("_hash", F.substring(digest, 9, 24))
            .withColumn("_block", (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % blocks).cast("int")))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], budget: float, most: float) -> DataFrame:
    """``_key, source, rank, source_size, target`` from a row for each source.

    Sources are capped in the order of cap / weight; a source is capped when its
    share of what the earlier ones leave passes its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.col("rank") % len(weights)) + 1).cast("int"))
    table = (sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("int"))
             .withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most))))
    everything = Window.partitionBy()
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("rank"))
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    table = (table
             .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(budget)))
             .withColumn("left_words", F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
             .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
             .withColumn("capped", F.col("left_words") / F.col("left_weight") * F.col("weight") >= F.col("cap")))
    capped = lambda c: F.sum(F.when(F.col("capped"), F.col(c)).otherwise(F.lit(0))).over(everything)
    free_weight = F.sum("weight").over(everything) - capped("weight")
    free_words = F.col("budget") - capped("cap")
    return table.select("_key", "source", "rank", "source_size",
                        F.when(F.col("capped"), F.col("cap"))
                        .otherwise(free_words / F.when(free_weight > 0, free_weight) * F.col("weight")).alias("target"))


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Quantile ``u`` of the number of good ones among ``draws`` of ``total`` without replacement.

    Sums the probabilities' ratios over the support within nine standard
    deviations of the mean, which leaves out less than double precision shows.
    """
    n, k, m = total.cast("double"), good.cast("double"), draws.cast("double")
    mean = F.when(n > 0, m * k / n).otherwise(F.lit(0.0))
    spread = F.when(n > 1, F.sqrt(F.greatest(mean * (1 - k / n) * (n - m) / (n - 1), F.lit(0.0)))).otherwise(F.lit(0.0))
    low = F.greatest(F.lit(0.0), m - (n - k), F.floor(mean - 9 * spread - 4).cast("double")).cast("long")
    high = F.least(k, m, F.ceil(mean + 9 * spread + 4).cast("double")).cast("long")

    def ratio(x: Column) -> Column:
        x = x.cast("double")
        return (k - x) * (m - x) / ((x + 1) * (n - k - m + x + 1))

    zero = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("s"), F.lit(-1).cast("long").alias("at"))

    def step(bar: Column | None):
        def one(acc: Column, x: Column) -> Column:
            s = acc["s"] + acc["w"]
            at = acc["at"] if bar is None else F.when((acc["at"] < 0) & (s >= bar), x).otherwise(acc["at"])
            return F.struct((acc["w"] * ratio(x)).alias("w"), s.alias("s"), at.alias("at"))
        return one

    def pick(support: Column) -> Column:
        whole = F.aggregate(support, zero, step(None), lambda acc: acc["s"])
        found = F.transform(F.array(whole * u), lambda bar: F.aggregate(support, zero, step(bar), lambda acc: acc["at"]))
        return F.when(F.get(found, F.lit(0)) < 0, high).otherwise(F.get(found, F.lit(0)))

    return F.get(F.transform(F.array(F.sequence(low, high)), pick), F.lit(0))


def split_left(quotas: Column, wanted: Column, seed: Column) -> Column:
    """How many of each source's quota go to the left half, as one multivariate hypergeometric draw."""
    zero = F.struct(wanted.cast("long").alias("wanted"), F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
                    F.array().cast("array<bigint>").alias("out"))

    def one(acc: Column, x: Column) -> Column:
        got = hypergeometric(acc["total"], x, acc["wanted"], _uniform(seed, F.size(acc["out"]).cast("string")))
        return F.get(F.transform(F.array(got), lambda g: F.struct(
            (acc["wanted"] - g).alias("wanted"), (acc["total"] - x).alias("total"),
            F.concat(acc["out"], F.array(g)).alias("out"))), F.lit(0))

    return F.aggregate(quotas, zero, one, lambda acc: acc["out"])


def shard_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``rank, shard, blocks`` from ``rank, quota``: the leaves of the splitting tree."""
    root = (quotas.agg(F.sort_array(F.collect_list(F.struct("rank", F.col("quota").cast("long").alias("quota")))).alias("q"))
            .select(F.lit(0).alias("low"), F.lit(shards).alias("high"),
                    F.transform("q", lambda x: x["quota"]).alias("quotas"))
            .filter(F.size("quotas") > 0))
    nodes = root
    for _ in range(max(shards - 1, 0).bit_length()):
        span, total = F.col("high") - F.col("low"), F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x)
        half = (F.col("low") + F.floor(span / 2)).cast("int")
        wanted = F.floor(total * (half - F.col("low")) / span)
        name = F.concat_ws("-", F.lit(f"node-{seed}"), F.col("low").cast("string"), F.col("high").cast("string"))
        nodes = (nodes.withColumn("half", half)
                 .withColumn("left", F.when(span > 1, split_left(F.col("quotas"), wanted, name)).otherwise(F.col("quotas")))
                 .withColumn("right", F.zip_with("quotas", "left", lambda a, b: a - b))
                 .select(F.explode(F.when(span > 1, F.array(
                     F.struct("low", F.col("half").alias("high"), F.col("left").alias("quotas")),
                     F.struct(F.col("half").alias("low"), "high", F.col("right").alias("quotas"))))
                     .otherwise(F.array(F.struct("low", "high", "quotas")))).alias("node")).select("node.*"))
    return nodes.select(F.col("low").alias("shard"), F.posexplode("quotas").alias("rank", "blocks"))


def _length_class(size: Column, rest: Column) -> Column:
    """The number of the document's class, the longest being 0."""
    return sum((F.when(size * part > rest, 0).otherwise(1) for part in PARTS), F.lit(0)).cast("int")


def _cuts_by_class(sized: DataFrame, targets: DataFrame, blocks: int) -> DataFrame:
    """``_key, cuts``: for each class the block (``last``) and the hash in it (``cut``) up to which the rest takes it.

    The classes follow each other, as a class is given what the longer ones left.
    """
    classed = (sized.join(targets.select("_key", "rest"), "_key").filter("rest > 0")
               .withColumn("_class", _length_class(F.col("_size"), F.col("rest"))))
    by_block = saved(classed.groupBy("_key", "_class", "_block").agg(F.sum("_size").alias("words")), "mix-classes")
    of_class = by_block.groupBy("_key").pivot("_class", list(range(len(PARTS) + 1))).agg(F.sum("words")).na.fill(0)
    state = (targets.filter("rest > 0").select("_key", "rest").join(of_class, "_key")
             .withColumn("left", F.col("rest"))
             .withColumn("cuts", F.array().cast("array<struct<last:int,cut:string>>")))
    for k in range(len(PARTS) + 1):
        words = F.col(str(k)).cast("double")
        below = sum((F.col(str(j)) for j in range(k + 1, len(PARTS) + 1)), F.lit(0)).cast("double")
        goal = F.when(words > 0, F.greatest(F.col("left"), F.lit(0.0)) * words / (words + below)).otherwise(F.lit(0.0))
        state = saved(state.withColumn("goal", goal).withColumn("below", below), "mix-goals")
        in_order = Window.partitionBy("_key").orderBy("_block")
        ends = (by_block.filter(F.col("_class") == k).withColumn("upto", F.sum("words").over(in_order))
                .join(state.select("_key", "goal"), "_key").filter(F.col("upto") > F.col("goal"))
                .groupBy("_key").agg(F.min(F.struct("_block", (F.col("upto") - F.col("words")).alias("before"), "goal")).alias("e"))
                .select("_key", "e.*"))
        hashed = Window.partitionBy("_key").orderBy("_hash")
        passed = F.col("upto") > F.col("goal")
        near = (classed.filter(F.col("_class") == k).join(ends, ["_key", "_block"])
                .groupBy("_key", "_block", "before", "goal", "_hash").agg(F.sum("_size").alias("words"))
                .withColumn("upto", F.col("before") + F.sum("words").over(hashed))
                .groupBy("_key", "_block", "before")
                .agg(F.max(F.when(~passed, F.struct("upto", F.col("_hash").alias("cut")))).alias("under"),
                     F.min(F.when(passed, F.struct("upto", F.col("_hash").alias("cut")))).alias("over")))

        def cost(upto: Column) -> Column:
            miss = F.greatest(upto - F.col("left"), F.col("left") - F.col("below") - upto, F.lit(0.0))
            return F.struct(miss.alias("miss"), F.abs(upto - F.col("goal")).alias("off"))

        under = F.coalesce(F.col("under"), F.struct(F.col("before").alias("upto"), F.lit("").alias("cut")))
        pick = F.when(cost(F.col("over.upto")) < cost(under["upto"]), F.col("over")).otherwise(under)
        whole = F.col("_block").isNull()
        state = (state.join(near, "_key", "left").withColumn("pick", pick)
                 .select("_key", "rest", *[F.col(str(j)) for j in range(len(PARTS) + 1)],
                         (F.col("left") - F.when(whole, F.col(str(k))).otherwise(F.col("pick.upto"))).alias("left"),
                         F.concat("cuts", F.array(F.struct(
                             F.when(whole, F.when(F.col(str(k)) > 0, blocks).otherwise(0)).otherwise(F.col("_block")).cast("int").alias("last"),
                             F.when(whole, F.lit("")).otherwise(F.col("pick.cut")).alias("cut")))).alias("cuts")))
    return state.select("_key", "cuts")


def source_records(sized: DataFrame, weights: tuple[int, ...], budget: float, most: float, blocks: int, shards: int,
                   seed: int) -> DataFrame:
    """A row for each source with all that decides its documents.

    ``_key, source_size, target``; ``whole``: times that every block is taken;
    ``cuts``: for each class of length the block in which the rest ends, with
    the last hash taken in it; ``shard_of``: the shard of each block drawn, in drawing order.
    """
    by_block = saved(sized.groupBy("_key", "source", "_block").agg(F.sum("_size").alias("words")), "mix-blocks")
    sizes = by_block.groupBy("_key", "source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, budget, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    targets = saved(targets.withColumn("whole", whole)
                    .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    cuts = _cuts_by_class(sized, targets, blocks)
    covered = F.array_max(F.transform("cuts", lambda x: x["last"] + F.when(x["cut"] != "", 1).otherwise(0)))
    records = (targets.join(cuts, "_key", "left")
               .withColumn("quota", F.col("whole").cast("long") * blocks + F.coalesce(covered, F.lit(0))))
    records = saved(records, "mix-records")
    shard_of = (shard_quotas(records.select("rank", "quota"), shards, seed)
                .groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("shard", "blocks"))).alias("b"))
                .select("rank", F.flatten(F.transform("b", lambda x: F.array_repeat(x["shard"], x["blocks"].cast("int")))).alias("shard_of")))
    return records.join(shard_of, "rank").select("_key", "source_size", "target", "whole", "rest", "cuts", "shard_of")


def _draws(blocks: int, most: int) -> Column:
    """The shard of every draw of a row: one for each whole time, one more when the rest covers it."""
    whole = [F.when(F.col("whole") > i, F.get("shard_of", i * blocks + F.col("_block"))) for i in range(most)]
    cut = F.get("cuts", _length_class(F.col("_size"), F.col("rest")))
    rest = F.when((F.col("_block") < cut["last"]) | ((F.col("_block") == cut["last"]) & (F.col("_hash") <= cut["cut"])),
                  F.get("shard_of", F.col("whole") * blocks + F.col("_block")))
    return F.array_compact(F.array(*whole, rest))


def _records(docs: DataFrame, weights: tuple[int, ...], budget: float, most: int, blocks: int, shards: int | None,
             seed: int) -> tuple[DataFrame, DataFrame, int]:
    """The documents' sizes and blocks, the sources' records, and the number of shards."""
    shards = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sized = saved(with_blocks(docs.select("doc_id", "source", "text"), blocks, seed).drop("text"), "mix-sizes")
    return sized, saved(source_records(sized, weights, budget, most, blocks, shards, seed), "mix-sources"), shards


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST,
                blocks: int = BLOCKS, shards: int | None = None, seed: int = 7) -> DataFrame:
    """``doc_id, size, source_size, target, shards``: the shard of each time the document is taken.

    Without a number of shards there are as many as shuffle partitions.
    """
    sized, records, _ = _records(docs, weights, budget, most, blocks, shards, seed)
    return sized.join(records, "_key").select("doc_id", F.col("_size").alias("size"), "source_size", "target",
                                              _draws(blocks, most).alias("shards"))


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, most: int = MOST,
                    blocks: int = BLOCKS, shards: int | None = None, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, as often as the mix takes them, in their shards' partitions and order."""
    _, records, shards = _records(docs, weights, budget, most, blocks, shards, seed)
    rows = with_blocks(docs.select(F.struct("*").alias("row"), "doc_id", "source", "text"), blocks, seed)
    drawn = rows.join(records, "_key").select("row", F.posexplode(_draws(blocks, most)).alias("time", "shard"))
    order = F.xxhash64(F.coalesce(F.col("row.doc_id"), F.lit(0)), F.col("time"), F.lit(seed))
    return (drawn.withColumn("order", order).repartitionById(shards, "shard")
            .sortWithinPartitions("shard", "order").select("row.*"))
