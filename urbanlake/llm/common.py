"""Helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.session import work_path

#: Members of a candidate bucket that one task row compares with each other or with as many others.
BLOCK = 1000


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared work folder and read it again.

    This cuts the lineage: a lost executor costs a reread, not a recomputation,
    and what follows sees the same rows however often it runs.
    """
    path = work_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and UTF-8 bytes of the text; a null text is empty."""
    return docs.select(F.col(key).cast("long").alias(key),
                       F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("utf8"))


def bucket_blocks(members: DataFrame, keys: list[str], identity: str, payload: DataFrame | None = None,
                  block: int = BLOCK) -> DataFrame:
    """Candidate buckets cut into pairs of blocks, one row each.

    ``members`` has the bucket's ``keys`` and an ``identity`` column; ``payload``
    (identity and struct ``m``) is joined to those that share a bucket, so that
    what shares none is never carried along; without it ``m`` is the identity.
    A bucket of n members is dealt into ceil(n / block) blocks by the
    identity's hash; each pair of blocks becomes one row with the array
    ``members`` of structs ``(side, m)``, so that no row holds more than about
    two blocks however large the bucket is.  Each pair of members meets in
    exactly one row.  Buckets of one member are left out.
    """
    n = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    dealt = (members.join(n, keys)
             .withColumn("_blocks", blocks)
             .withColumn("_own", F.pmod(F.xxhash64(identity), F.col("_blocks")).cast("int"))
             .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))))
    dealt = dealt.withColumn("m", F.struct(identity)) if payload is None else dealt.join(payload, identity)
    return (dealt.groupBy(*keys, F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"))
            .agg(F.collect_list(F.struct((F.col("_own") < F.col("_other")).cast("int").alias("first"),
                                         (F.col("_own") > F.col("_other")).cast("int").alias("second"),
                                         "m")).alias("members")))


def spanning_star(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, the smallest index that each row reaches through links."""
    n = len(linked)
    label = np.arange(n)
    reach = linked.copy()
    np.fill_diagonal(reach, True)
    while True:
        low = np.where(reach, label[None, :], n).min(axis=1)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges (a, b)``: the smallest node it reaches.

    Alternates the large-star and small-star steps (Kiveris et al., 2014) until
    the edges stay as they are: then each component is a star around its
    smallest node.  Every round is written to the shared work folder.  Minima
    are combined before the shuffle; the joins that carry them back are plain
    equi-joins, which adaptive execution splits at a hub.
    """
    e = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
              .filter("a <> b").distinct(), f"{name}-0")
    before, i = None, 0
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            break
        before, i = now, i + 1
        both = e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (low.select("a", F.col("m").alias("b"))
                 .unionAll(large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))))
        e = saved(small.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  f"{name}-{i}")
    star = e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return star.unionAll(e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def batches(rows: Iterator[pa.RecordBatch], size: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size``, so that a task's working set stays small."""
    for b in rows:
        for at in range(0, b.num_rows, size):
            yield b.slice(at, size)


def by_bytes(rows: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of a binary column, one row at least."""
    for b in rows:
        upto = np.cumsum(pc.binary_length(b.column(column)).to_numpy(zero_copy_only=False))
        at = 0
        while at < b.num_rows:
            end = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right"))
            end = min(max(end, at + 1), b.num_rows)
            yield b.slice(at, end - at)
            at = end


class RaggedCache:
    """Integer sequences by string, filled by ``encode(strings) -> (integers one after the other, how many each)``.

    A batch's strings are numbered by Arrow, so only its distinct strings are
    looked up, and their sequences are gathered without a Python step for each
    integer.  When it holds more than ``most`` strings it
    starts anew, so its memory stays bounded.
    """

    def __init__(self, encode, most: int = 1_200_000) -> None:
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.int32)
        self.start = np.empty(1 << 14, dtype=np.int64)
        self.length = np.empty(1 << 14, dtype=np.int64)
        self.used = 0

    def _room(self, name: str, need: int) -> np.ndarray:
        a = getattr(self, name)
        if need > len(a):
            a = np.concatenate([a, np.empty(max(need, 2 * len(a)) - len(a), dtype=a.dtype)])
            setattr(self, name, a)
        return a

    def _add(self, strings: list[str]) -> None:
        flat, sizes = self.encode(strings)
        n, total = len(self.code), len(flat)
        self._room("flat", self.used + total)[self.used:self.used + total] = flat
        self._room("start", n + len(strings))[n:n + len(strings)] = self.used + np.cumsum(sizes) - sizes
        self._room("length", n + len(strings))[n:n + len(strings)] = sizes
        self.used += total
        self.code.update(zip(strings, range(n, n + len(strings)), strict=True))

    def gather(self, strings: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All sequences one after the other, and how many integers each document has; ``counts``: its strings."""
        if len(self.code) > self.most:
            self._clear()
        coded = strings.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        places = np.fromiter((-1 if c is None else c for c in map(self.code.get, distinct)), np.int64, len(distinct))
        fresh = np.flatnonzero(places < 0)
        if len(fresh):
            places[fresh] = np.arange(len(self.code), len(self.code) + len(fresh))
            self._add([distinct[i] for i in fresh.tolist()])
        codes = places[coded.indices.to_numpy(zero_copy_only=False)]
        sizes = self.length[codes]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.start[codes] - (ends - sizes), sizes) + np.arange(total)
        upto = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return self.flat[at], np.diff(upto)
