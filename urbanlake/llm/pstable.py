"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are normalised and projected on Gaussian directions; a projection,
shifted at random and cut into cells of ``width``, is one hash, ``per_table``
hashes together are a table's bucket, and vectors that share a bucket in any of
``tables`` tables are compared by exact cosine in double precision.

For two unit vectors at distance c one hash agrees with probability
``1 - 2 N(-w/c) - 2c / (sqrt(2 pi) w) (1 - exp(-w^2 / 2c^2))`` (Datar et al.,
2004).  The defaults miss a pair at cosine 0.98 (c = 0.2) with probability
4e-6, closer pairs with less, and bring an unrelated pair together in about one
of 400 cases.

Equal vectors of a label are one class before hashing.  Each linked pair is
counted in the first table in which its classes meet, so sums over tables hold
every link once; each block row gives a spanning star of what it links instead
of its pairs.

Defined cases: a vector that is null, empty, all zeros or holds null, NaN or
infinite components, or whose label is null, links with nothing (``n_links`` 0,
its own component).  Vectors of different lengths are not compared.  Repeated
rows are vectors of their own; a row with a null ``vec_id`` counts as a vector
but never names a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import bucket_blocks, connected_components, saved, spanning_star


def usable(embedding: str = "embedding", label: str = "label") -> Column:
    """Whether a vector can link at all."""
    e = F.col(embedding)
    fine = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(label).isNotNull() & e.isNotNull() & fine & F.exists(e, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows scaled to unit length, in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_hashes(classes: DataFrame, tables: int, per_table: int, width: float, seed: int) -> DataFrame:
    """``cid, buckets``: one bucket hash for each table."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        mix = np.random.default_rng(seed).integers(1, 1 << 63, size=per_table, dtype=np.uint64) | np.uint64(1)
        for b in rows:
            vectors = b.column("embedding")
            dims = vectors.value_lengths().to_numpy(zero_copy_only=False)
            out = np.empty((b.num_rows, tables), dtype=np.int64)
            for dim in np.unique(dims):
                if dim not in planes:
                    rng = np.random.default_rng([seed, int(dim)])
                    planes[dim] = (rng.standard_normal((int(dim), tables * per_table)),
                                   rng.uniform(0, width, tables * per_table))
                at = np.flatnonzero(dims == dim)
                a, shift = planes[dim]
                cells = np.floor((_matrix(vectors.take(pa.array(at)), int(dim)) @ a + shift) / width).astype(np.int64)
                h = (cells.reshape(-1, tables, per_table).view(np.uint64) * mix).sum(axis=2, dtype=np.uint64)
                h ^= h >> np.uint64(29)
                out[at] = (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(b.num_rows + 1, dtype=np.int32) * tables, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("cid"), lists], ["cid", "buckets"])

    return classes.select("cid", "embedding").mapInArrow(run, "cid long, buckets array<long>")


def _compare(min_cosine: float):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for row in range(b.num_rows):
                t = b.column("t")[row].as_py()
                members = b.column("members")[row].values
                m = members.field("m")
                cid = m.field("cid").to_numpy()
                size = m.field("n").to_numpy()
                dim = len(m.field("embedding")[0])
                x = _matrix(m.field("embedding"), dim)
                sig = m.field("buckets").flatten().to_numpy().reshape(len(cid), -1)
                linked = (x @ x.T) >= min_cosine
                first = members.field("first").to_numpy().astype(bool)
                second = members.field("second").to_numpy().astype(bool)
                if first.any() or second.any():          # two blocks: pairs across them only
                    linked &= first[:, None] != first[None, :]
                i, j = np.nonzero(np.triu(linked, 1))
                fresh = np.ones(len(i), dtype=bool)      # pairs that no earlier table brought together
                for u in range(t):
                    fresh &= sig[i, u] != sig[j, u]
                i, j = i[fresh], j[fresh]
                if not len(i):
                    continue
                links = np.bincount(i, size[j], len(cid)) + np.bincount(j, size[i], len(cid))
                near = np.zeros_like(linked)
                near[i, j] = near[j, i] = True
                root = spanning_star(near)
                some = links > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cid[some]), pa.array(links[some].astype(np.int64)), pa.array(cid[root[some]])],
                    ["cid", "links", "root"])
    return run


def near_duplicates(vectors: DataFrame, min_cosine: float = 0.98, tables: int = 32, per_table: int = 10,
                    width: float = 1.5, seed: int = 20) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors (vec_id, embedding, label)``."""
    rows = vectors.select("vec_id", "label", "embedding")
    good = rows.filter(usable())
    classes = saved(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                    .withColumn("cid", F.monotonically_increasing_id()), "pstable-classes")
    hashed = saved(bucket_hashes(classes, tables, per_table, width, seed), "pstable-hashes")
    payload = classes.join(hashed, "cid").select("cid", F.struct("cid", "n", "embedding", "buckets").alias("m"))
    members = (classes.select("cid", "label", F.size("embedding").alias("dim")).join(hashed, "cid")
               .select("cid", "label", "dim", F.posexplode("buckets").alias("t", "bucket")))
    found = saved(bucket_blocks(members, ["label", "dim", "t", "bucket"], "cid", payload)
                  .select("t", "members").mapInArrow(_compare(min_cosine), "cid long, links long, root long"),
                  "pstable-links")
    comp = connected_components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")), "pstable")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    rooted = (classes.select("cid", "first_id").join(comp.withColumnRenamed("node", "cid"), "cid", "left")
              .withColumn("root", F.coalesce("component", "cid")))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    result = saved(classes.select("cid", "n").join(rooted.join(ids, "root").select("cid", "component_id"), "cid")
                   .join(links, "cid", "left")
                   .select("cid", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
                   "pstable-result")
    # both joins read written tables through plain exchanges, which adaptive execution splits at a class of many copies;
    # the second one carries numbers only
    linked = (good.join(classes.select("label", "embedding", "cid"), ["label", "embedding"]).select("vec_id", "cid")
              .join(result, "cid").select("vec_id", "n_links", "component_id"))
    alone = rows.filter(~usable()).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return linked.unionAll(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
