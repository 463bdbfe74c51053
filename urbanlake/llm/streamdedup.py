"""Exact dedup of a stream of documents with keyed state that never expires.

Texts are equal when they are the same bytes after each run of blanks became one
space.  Two streaming queries, built from DataFrame functions only, keep their
tables and checkpoints in one folder:

* ``intake`` takes the documents.  The copies of a text within a micro-batch are
  grouped by digest *and* whole text, so the grouping itself compares all bytes, and
  copies meet in the map side before the shuffle.  It writes one content row per text
  (``content``) and one narrow row per document (``members``).
* ``index`` streams over the content rows without their texts.  Its state, in RocksDB
  on disk and backed up to the checkpoint, holds for each digest the smallest
  identifier, the number of documents and the locator (batch, file, row) of the first
  content met.  A digest that was there before is a hit: when the run's batches are in
  the state, the contents at the hits' locators and the new ones are read back, once
  for the whole run, and compared in full.

A hit whose bytes differ is written to ``collisions``; ``decisions`` then takes the
documents of that digest apart by their texts.  Documents of one batch that share
digest and a second checksum but not the text can't be told apart any more and stop
the job.  All writes go to a folder of their batch, so a batch that is
replayed after a failure replaces what it left; the index starts when the intake's
batches are committed.

Defined cases: a null text is empty, and empty texts are equal.  A null identifier
is larger than any other; of rows with the same text and identifier one is kept.
Extra columns are ignored.  An empty stream gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlake.llm.common import saved

BLANKS = r"[\x20\x09-\x0D]+"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: A store is closed once its batch is saved, so executors hold only the stores of running tasks; it reserves no space ahead.
STATE = {"spark.sql.streaming.stateStore.providerClass": ROCKS,
         "spark.sql.streaming.stateStore.unloadOnCommit": "true",
         "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
         "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
         "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
         "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8"}
CONTENT = "digest binary, text string, mark long, n long, first_id long, epoch long"
MEMBERS = "digest binary, mark long, id long, epoch long"
GROUPS = ("digest binary, n long, keep_id long, locator struct<epoch:long,file:string,row:long>, "
          "last_epoch long, pieces long, epoch long")


def normalised(text: str = "text") -> Column:
    """The text with each run of blanks as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that a streaming query takes with it when it starts."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of ``epoch=`` folders, empty while there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _finish(writer) -> None:
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def intake(docs: DataFrame, store: str, key: str = "doc_id", text: str = "text",
           digest: Callable[[Column], Column] = sha256) -> None:
    """Take what a stream of documents has: a content row for each text of a batch, a member row for each document."""
    rows = docs.select(F.col(key).cast("long").alias("id"), normalised(text).alias("text"))
    rows = rows.select("id", "text", digest(F.col("text")).alias("digest"), F.xxhash64("text").alias("mark"))

    def take(batch: DataFrame, epoch: int) -> None:
        (batch.groupBy("digest", "text", "mark").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
         .write.mode("overwrite").parquet(f"{store}/content/epoch={epoch}"))
        batch.select("digest", "mark", "id").write.mode("overwrite").parquet(f"{store}/members/epoch={epoch}")

    _finish(rows.writeStream.foreachBatch(take).option("checkpointLocation", f"{store}/intake_ckpt"))


def check_hits(spark: SparkSession, store: str) -> None:
    """Compare in full the contents of every digest met again since the last check; those that differ are ``collisions``.

    One pass for all micro-batches of a run, so texts are not read anew for each of
    them.  The mark that it is done is written last: a check that failed is repeated.
    """
    groups = _table(spark, f"{store}/groups", GROUPS)
    since = _table(spark, f"{store}/checked", "last long, epoch long").agg(F.max("epoch")).scalar()
    new = groups.filter(F.col("epoch") > F.coalesce(since, F.lit(-1)))
    last = new.agg(F.max("epoch"), F.max("last_epoch")).first()
    if last[0] is None:
        return
    done = _table(spark, f"{store}/checked", "last long, epoch long").agg(F.max("last")).first()[0]
    done = -1 if done is None else done
    hits = saved(new.filter("pieces > 1").groupBy("digest").agg(F.min("locator").alias("locator")), "dedup-hits")
    if not hits.isEmpty():
        content = _table(spark, f"{store}/content", CONTENT).select("epoch", "digest", "text")
        fresh = content.filter(F.col("epoch") > done).join(hits.select("digest"), "digest", "left_semi").select("digest", "text")
        kept = hits.select(F.col("locator.epoch").alias("epoch"), "digest").filter(F.col("epoch") <= done)
        both = fresh.unionAll(content.join(kept, ["epoch", "digest"]).select("digest", "text"))
        texts = both.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("n"))
        (texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("digest")
         .write.mode("overwrite").parquet(f"{store}/collisions/epoch={last[0]}"))
    spark.range(1).select(F.lit(last[1]).cast("long").alias("last")).write.mode("overwrite").parquet(
        f"{store}/checked/epoch={last[0]}")


def index(spark: SparkSession, store: str) -> None:
    """Bring the keyed state up to date with the content rows, and check the bytes of every hit."""
    if _table(spark, f"{store}/content", CONTENT).isEmpty():
        return
    stream = (spark.readStream.schema(CONTENT).option("maxFileAge", "36500d").parquet(f"{store}/content")
              .select("digest", "n", "first_id", "epoch",
                      F.struct("epoch", F.col("_metadata.file_path").alias("file"),
                               F.col("_metadata.row_index").alias("row")).alias("place")))
    state = stream.groupBy("digest").agg(F.sum("n").alias("n"), F.min("first_id").alias("keep_id"),
                                         F.min("place").alias("locator"), F.max("epoch").alias("last_epoch"),
                                         F.count(F.lit(1)).alias("pieces"))

    def note(changed: DataFrame, epoch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{store}/groups/epoch={epoch}")

    with _settings(spark, STATE):
        _finish(state.writeStream.outputMode("update").foreachBatch(note)
                .option("checkpointLocation", f"{store}/index_ckpt"))
    check_hits(spark, store)


def decisions(spark: SparkSession, store: str) -> DataFrame:
    """``id, keep_id, group_size, kept, digest`` for every document taken so far."""
    members = _table(spark, f"{store}/members", MEMBERS)
    # a written table: the join below then reads plain exchanges, which adaptive execution splits at a large group
    groups = saved(_table(spark, f"{store}/groups", GROUPS).groupBy("digest")
                   .agg(F.max("n").alias("group_size"), F.min("keep_id").alias("keep_id")), "dedup-groups")
    bad = _table(spark, f"{store}/collisions", "digest binary, epoch long").select("digest").distinct()
    apart = None
    if not bad.isEmpty():
        content = _table(spark, f"{store}/content", CONTENT).join(bad, "digest", "left_semi")
        unclear = content.groupBy("epoch", "digest", "mark").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
        if not unclear.isEmpty():
            raise RuntimeError("documents of one batch share digest and checksum, but not the text")
        texts = content.groupBy("digest", "text").agg(F.sum("n").alias("group_size"), F.min("first_id").alias("keep_id"))
        apart = (members.join(bad, "digest", "left_semi")
                 .join(content.select("epoch", "digest", "mark", "text"), ["epoch", "digest", "mark"])
                 .join(texts, ["digest", "text"]).select("digest", "id", "group_size", "keep_id", F.xxhash64("text").alias("which")))
        members = members.join(bad, "digest", "left_anti")
    # rows of one text and identifier are counted before the join, so that it carries one row for them
    rows = members.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("rows")).join(groups, "digest")
    if apart is not None:
        apart = apart.groupBy("digest", "which", "id", "group_size", "keep_id").agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.unionByName(apart.drop("which"))
    first = F.col("id").eqNullSafe(F.col("keep_id"))
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("id", "keep_id", "group_size", (first & (F.col("copy") == 1)).alias("kept"), "digest"))


def deduplicate(docs: DataFrame, store: str, key: str = "doc_id", text: str = "text",
                digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Take all that the stream has now, and give every document's decision; call again with the same ``store`` for more."""
    intake(docs, store, key, text, digest)
    index(docs.sparkSession, store)
    return decisions(docs.sparkSession, store).withColumnRenamed("id", key)


def document_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1000) -> DataFrame:
    """A Parquet folder or single file as a stream: bounded micro-batches, and no file is too old to be taken."""
    path = path.rstrip("/")
    # the source takes a plain path for a folder; as a pattern it may be a file as well
    pattern = path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_batch))
            .option("maxFileAge", "36500d").parquet(pattern))
