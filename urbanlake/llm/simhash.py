"""SimHash near-dedup by pigeonhole blocks.

Texts become 64-bit fingerprints; fingerprints that differ in at most
``max_bits`` bits are linked, and a document's component is the set that links
reach.  With b blocks, ``max_bits`` differing bits leave at least b - max_bits
blocks untouched, so each close pair agrees on some choice of b - max_bits
blocks: the fingerprints are joined on every such choice and the pairs found
are verified by their Hamming distance.

Equal fingerprints are one class before any join, so copies never form pairs.
Defined cases: a null, empty or white-space text has fingerprint zero and is
linked like any other; repeated rows each give a row; a null ``doc_id`` keeps
its row but never names a component (null if no other row of its component
has an id).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import batches, bucket_blocks, connected_components, saved, spanning_star, text_bytes

BITS = 64


def fingerprint(utf8: bytes, shingle: int, seed: int) -> int:
    """Majority vote, bit by bit, over the XXH64 of the text's word shingles; 0 without words."""
    words = utf8.lower().split()          # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    xxh = xxhash.xxh64_intdigest
    h = np.array([xxh(g, seed) for g in grams], dtype=np.uint64)
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(h), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, fp``: the fingerprint's 64 bits as a signed long; the hash tells rows of one id apart."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            fps = [fingerprint(t, shingle, seed) for t in b.column("utf8").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps, pa.int64())],
                                             ["doc_id", "text_hash", "fp"])

    return (text_bytes(docs).withColumn("text_hash", F.xxhash64("utf8"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


def block_masks(max_bits: int, blocks: int) -> list[int]:
    """Bit masks, one for each choice of blocks - max_bits of the blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    each = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(each[i] for i in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def close_links(fps: DataFrame, max_bits: int = 3, blocks: int = 5) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints (column ``fp``) of at most ``max_bits`` differing bits.

    Each block row gives a spanning star of what it links, not all pairs, so
    the edges reach exactly what the links reach.
    """
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(max_bits, blocks)])
    members = (fps.select("fp", F.posexplode(masks).alias("t", "mask"))
               .select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("block"), "fp"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            a_out, b_out = [], []
            lists = b.column("members")
            all_fp = lists.flatten().field("m").field("fp").to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            start = 0
            for end in ends:
                fp = all_fp[start:end]
                start = end
                u = fp.view(np.uint64)
                linked = np.bitwise_count(u[:, None] ^ u[None, :]) <= max_bits
                root = spanning_star(linked)
                away = root != np.arange(len(fp))
                a_out.append(fp[away])
                b_out.append(fp[root[away]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (a_out, b_out)], ["a", "b"])

    return bucket_blocks(members, ["t", "block"], "fp").select("members").mapInArrow(run, "a long, b long")


def fingerprint_components(docs: DataFrame, shingle: int, max_bits: int, seed: int, blocks: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and ``fp, first_doc, root`` with the smallest fingerprint that each reaches."""
    fps = saved(fingerprints(docs, shingle, seed), "simhash-fps")
    distinct = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "simhash-distinct")
    comp = connected_components(close_links(distinct.select("fp"), max_bits, blocks), "simhash")
    rooted = (distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first_doc", F.coalesce("component", "fp").alias("root")))
    return fps, rooted


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42, blocks: int = 5) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable, ``kept`` whether the
    row's own id is that one.
    """
    fps, rooted = fingerprint_components(docs, shingle, max_bits, seed, blocks)
    ids = rooted.groupBy("root").agg(F.min("first_doc").alias("component_id"))
    # a written table of one row for each fingerprint: the join reads plain exchanges, which adaptive execution splits
    of_fp = saved(rooted.join(ids, "root").select("fp", "component_id"), "simhash-of-fp")
    return fps.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42, blocks: int = 5) -> DataFrame:
    """One row of ``docs`` for each component, as it is: the smallest id's, and of several with that id the smallest text hash's."""
    fps, rooted = fingerprint_components(docs, shingle, max_bits, seed, blocks)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    of_fp = fps.groupBy("fp").agg(F.min(first).alias("b"))              # copies are combined before the join
    best = (of_fp.join(rooted.select("fp", "root"), "fp").groupBy("root").agg(F.min("b").alias("b"))
            .select(F.col("b.doc_id").alias("best_id"), F.col("b.text_hash").alias("best_hash")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("own_id"),
                       F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).alias("own_hash"))
    kept = rows.join(saved(best, "simhash-best"), F.col("own_id").eqNullSafe(F.col("best_id")) & (F.col("own_hash") == F.col("best_hash")),
                     "left_semi")
    return kept.dropDuplicates(["own_id", "own_hash"]).select("row.*")
