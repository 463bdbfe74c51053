"""Periodic runs, whitening and streaming dedup against plain versions."""

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from brute import ODD, WORD  # noqa: E402
from llm_fixtures import make  # noqa: E402, F401

from urbanlake.llm import periodic, streamdedup, whitening  # noqa: E402
from urbanlake.llm.queries import QUERIES  # noqa: E402
from urbanlake.session import read_table, work_path  # noqa: E402

SMALL = os.environ.get("URBANLAKE_TEST_SF", "/root/testdata/sf0.001")


# ------------------------------------------------------------- periodic runs

def brute_runs(words, least=6, times=4):
    """Every maximal stretch at its smallest period, by comparing the words with themselves shifted."""
    names = {}
    w = np.array([names.setdefault(x, len(names)) for x in words], dtype=np.int64)
    out = []
    for q in range(1, len(w) // times + 1):
        same = np.concatenate([[False], w[:-q] == w[q:], [False]])
        begin, end = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(~same[1:] & same[:-1])
        for s, e in zip(begin.tolist(), (end + q).tolist(), strict=True):
            if e - s >= max(least, times * q) and not any(
                    q % d == 0 and (w[s:s + q - d] == w[s + d:s + q]).all() for d in range(1, q)):
                out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def some_texts(count, seed=5):
    rng = random.Random(seed)
    for _ in range(count):
        words = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(0, 150))]
        for _ in range(rng.randint(0, 2)):
            at, piece = rng.randint(0, len(words)), [rng.choice("abcdefg") for _ in range(rng.randint(1, 30))]
            words[at:at] = piece * rng.randint(2, 9) + piece[:rng.randint(0, len(piece))]
        yield words


@pytest.mark.parametrize("base", [16, 64, periodic.BASE])
def test_runs_equal_brute_force(spark, make, base):  # noqa: F811
    """Small tiles: runs are cut into fragments of many tiles and stitched."""
    texts = [" \t".join(w) for w in some_texts(150)] + ["word " * 3000, ("one two three " * 400 + "end ") * 2]
    rows = list(enumerate(texts))
    docs = make([(i, t, "a") for i, t in rows])
    found = {r.doc_id: r for r in periodic.collapsed(docs, base=base).collect()}
    assert sorted(found) == [i for i, _ in rows]
    for i, t in rows:
        runs = brute_runs(t.split())
        assert [tuple(r) for r in found[i].runs] == runs, (i, base)
        assert found[i].collapsed == brute_collapsed(t.split(), runs)


def test_runs_of_odd_rows(spark, make):  # noqa: F811
    out = periodic.collapsed(make(ODD)).collect()
    assert len(out) == len(ODD)
    long = next(r for r in out if r.doc_id == 5)
    assert [tuple(r) for r in long.runs] == [(0, 30_000, 1)] and long.collapsed == "word"
    assert all(r.runs == [] for r in out if r.doc_id != 5)
    assert sorted(r.collapsed for r in out if r.doc_id in (1, 2, 3)) == ["", "", ""]
    assert periodic.collapsed(make(ODD).limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(make(ODD), times=3)


def test_runs_query_on_a_whole_table(spark):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect()}
    docs = read_table(spark, SMALL, "documents").collect()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = WORD.findall(d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute_runs(words)
        some += bool(runs)
        r = got[d.doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert some > 5


# ----------------------------------------------------------------- whitening

def plain_whitening(vectors, k, grid=256):
    x = np.floor(grid * np.array(vectors, dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    y = fit - fit.sum(axis=0) / len(fit)
    values, vecs = np.linalg.eigh(y.T @ y / len(fit))
    order = np.argsort(-values)[:k]
    far = ((len(fit) * x - fit.sum(axis=0)).astype(object) ** 2).sum(axis=1)
    return len(fit), far, (x - fit.sum(axis=0) / len(fit)) @ vecs[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_whitening_equals_an_eigendecomposition(spark):
    rows = read_table(spark, SMALL, "embeddings").select("vec_id", "embedding").collect()
    n, far, z, share = plain_whitening([r.embedding for r in rows], 4)
    got = {(r.vec_id, r.component): r for r in QUERIES["op12_embedding_whitening"](spark, SMALL).collect()}
    assert len(got) == 4 * len(rows)
    sign = [np.sign(got[rows[0].vec_id, c].whitened) * np.sign(z[0, c - 1]) for c in range(1, 5)]
    for i, r in enumerate(rows):
        for c in range(1, 5):
            g = got[r.vec_id, c]
            assert (g.n, g.deviation) == (n, far[i])
            assert abs(g.whitened - sign[c - 1] * z[i, c - 1]) < 1e-8
            assert abs(g.explained / share[c - 1] - 1) < 1e-10 and g.identity_error < 1e-9


def test_small_matrices():
    rng = np.random.default_rng(3)
    for width, rank, scale in [(1, 1, 1.0), (7, 7, 1e6), (12, 5, 1e-3), (30, 30, 1.0)]:
        a = rng.standard_normal((width, rank)) * np.logspace(0, 4, rank) * scale
        scatter = a @ a.T
        factor = whitening.pivoted_cholesky(scatter)
        assert factor.shape == (width, rank) and np.allclose(factor @ factor.T, scatter, rtol=1e-9, atol=1e-12 * scatter.max())
        values, vectors = whitening.one_sided_jacobi(factor)
        true = np.linalg.eigvalsh(scatter)[::-1][:rank]
        assert np.allclose(values, true, rtol=1e-7, atol=1e-12 * true[0])
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-10)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_whitening_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [3.0, -1.0]), (4, [0.5, 0.25]), (5, None), (6, []), (7, [1.0]),
            (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [None, 1.0]), (4, [0.5, 0.25])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("x", F.lit(1)).withColumn("key", F.lit(2))
    out = whitening.whitened(table).collect()
    assert sorted((r.vec_id or 0, r.component) for r in out) == sorted((i, c) for i in (0, 1, 2, 4, 4) for c in (1, 2))
    assert {r.n for r in out} == {3} and max(r.identity_error for r in out) < 1e-9
    one = whitening.whitened(table.filter("vec_id in (1, 2)"))
    assert one.count() == 0 and one.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whitened(table.filter("vec_id = 99")).count() == 0
    assert whitening.whitened(table.filter("vec_id in (5, 6)")).count() == 0


def test_deviations_beyond_64_bits():
    x = np.array([[10**9, 0], [4 * 10**9, 1], [3, 5]], dtype=np.int64)
    sums = [5 * 10**18, 7]
    for n in (2, 10**9, 10**10):
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        assert whitening.deviations(x, n, sums) == [e if e < 1 << 63 else None for e in exact]


# ----------------------------------------------------------- streaming dedup

def plain_decisions(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(" ".join(_split(t)), []).append(i)
    out = []
    for t, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), at == 0) for at, i in enumerate(ids)]
    return sorted(out, key=str)


def _split(text):
    import re
    return re.split("[\x20\x09-\x0D]+", text or "")


def in_files(spark, rows, path):
    schema = "doc_id long, text string, digest string, n int, kept int"
    for i, t in rows:
        spark.createDataFrame([(i, t, "x", 1, 2)], schema).coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path).schema


STREAMED = [(7, "a  b"), (3, "a b"), (9, "a\tb"), (9, "a b"), (None, "a b"), (5, " a b"), (1, None), (2, ""), (4, "\n"), (8, " "),
            (6, "word " * 2000), (11, "word  " * 2000), (None, "alone")]


@pytest.mark.parametrize("weak", [False, True])
def test_stream_dedup_over_batches(spark, weak):
    """Batches of two files; then more files for the same state.  With a weak digest nearly all texts collide."""
    base = work_path(spark, "test-stream")
    digest = (lambda t: F.unhex(F.lpad(F.hex(F.octet_length(t) % 2), 2, "0"))) if weak else streamdedup.sha256
    seen = []
    for part in (STREAMED[:8], STREAMED[8:]):
        schema = in_files(spark, part, f"{base}/docs")
        seen += part
        found = streamdedup.deduplicate(streamdedup.document_stream(spark, f"{base}/docs", schema, 2), f"{base}/state",
                                        digest=digest)
        got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()), key=str)
        assert got == plain_decisions(seen)
    collided = spark.read.parquet(f"{base}/state/collisions")
    assert (collided.count() > 0) == weak


def test_stream_dedup_after_a_check_that_failed(spark, monkeypatch):
    """The state has taken the batches, the byte check has not run: the next call makes up for it."""
    base = work_path(spark, "test-stream")
    digest = lambda t: F.unhex(F.lpad(F.hex(F.octet_length(t) % 2), 2, "0"))
    schema = in_files(spark, STREAMED[:8], f"{base}/docs")
    stream = lambda: streamdedup.document_stream(spark, f"{base}/docs", schema, 2)

    def lost(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(streamdedup, "check_hits", lost)
        with pytest.raises(RuntimeError, match="executor lost"):
            streamdedup.deduplicate(stream(), f"{base}/state", digest=digest)
    found = streamdedup.deduplicate(stream(), f"{base}/state", digest=digest)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in found.collect()), key=str) == plain_decisions(STREAMED[:8])
    assert spark.read.parquet(f"{base}/state/collisions").count() > 0


def test_stream_dedup_of_nothing(spark):
    base = work_path(spark, "test-stream")
    empty = spark.createDataFrame([], "doc_id long, text string")
    empty.write.parquet(f"{base}/docs")
    found = streamdedup.deduplicate(streamdedup.document_stream(spark, f"{base}/docs", empty.schema), f"{base}/state")
    assert found.count() == 0 and found.columns == ["doc_id", "keep_id", "group_size", "kept", "digest"]


def test_stream_dedup_uses_rocksdb_and_no_python_worker(spark):
    base = work_path(spark, "test-stream")
    schema = in_files(spark, STREAMED[:3], f"{base}/docs")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    found = streamdedup.deduplicate(streamdedup.document_stream(spark, f"{base}/docs", schema), f"{base}/state")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    offsets = "".join(r.value for r in spark.read.text(f"{base}/state/index_ckpt/offsets").collect())
    assert "RocksDB" in offsets
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
