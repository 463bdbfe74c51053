"""Periodic runs of words: maximal stretches that repeat a shorter piece.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) of at least ``max(least, times * q)`` words that no
neighbouring word extends at that period.

Method (scale tiles, Main and Lorentz's boundaries): periods are taken by
octaves ``Q <= q < 2Q``.  A text is cut into tiles; a text beyond ``base`` words
is exploded into overlapping tiles for each octave, sized by the octave, and
they are dealt out.  Within a tile every multiple ``b`` of Q is a boundary.  A run
of the octave has boundaries whose Z-value for its period, the number of words
that agree from ``b`` and from ``b + q`` on, is Q or more, so all boundaries and
periods are one comparison of arrays.  The arrays hold exact names of the
windows of 2^j words (Karp, Miller and Rosenberg): windows are equal if their
names are.  Neighbouring boundaries of one period are a chain; Z-values below Q
at its two ends, forward and backward, give its exact limits.  Fragments
are shuffled by document and period, and those that share a period or more are
stitched to whole runs.

Defined cases: a null text is empty; a text without words has no runs.  Rows
with the same key and text are one group on the way and come back one by one; a
null key is a key like any other.  Extra columns are carried along by
``collapsed`` and ignored by ``periodic_runs``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from urbanlake.llm.common import batches

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a tile that holds all octaves of a text up to that length.
BASE = 32_768
#: Words that are solved at once, in as many whole tiles as they make.
GROUP = 150_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
PIECES = "key long, content long, period long, start long, stop long"


# ------------------------------------------------------------- within a task

def _names(first: np.ndarray, ends: np.ndarray, levels: int) -> np.ndarray:
    """``names[j, i]``: equal for windows of 2^j words that are equal; a window met once gets a name of its own.

    ``first`` has the names of single words (distinct between texts), ``ends``
    the end of each position's text.  Windows past a text's end match nothing.
    """
    n = len(first)
    alone = (-1 - np.arange(n)).astype(np.int32)
    out = np.repeat(alone[None, :], levels, axis=0)
    counts = np.bincount(first) if n else np.zeros(0, dtype=np.int64)
    live = np.flatnonzero(counts[first] > 1) if n else np.zeros(0, dtype=np.int64)
    out[0, live] = first[live]
    for j in range(1, levels):
        half, below = 1 << (j - 1), out[j - 1]
        live = live[live + 2 * half <= ends[live]]
        live = live[below[live + half] >= 0]
        if not len(live):
            return out[:j]
        pair = below[live].astype(np.int64) << 32 | below[live + half]
        order = np.argsort(pair, kind="stable")
        fresh = np.concatenate([[True], np.diff(pair[order]) != 0])
        group = np.cumsum(fresh) - 1
        twice = np.bincount(group)[group] > 1
        at = live[order[twice]]
        out[j, at] = group[twice]
        live = np.sort(at)
    return out


def _primes(q: np.ndarray) -> Iterator[np.ndarray]:
    """One prime factor of each number at a time, 1 where none is left."""
    left = q.copy()
    smallest = np.arange(int(q.max()) + 1)
    for p in range(2, int(len(smallest) ** 0.5) + 1):
        if smallest[p] == p:
            at = smallest[p * p::p]
            at[at == np.arange(p * p, len(smallest), p)] = p
    while (left > 1).any():
        factor = np.maximum(smallest[left], 1)
        left = left // factor
        yield factor


def stretches(first: np.ndarray, ends: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, stop, period`` of all stretches at their smallest period that a boundary of its octave sees.

    These are all stretches of four octave lengths or more; some shorter ones are among them.
    """
    names = _names(first, ends, max(1, max(longest // 4, 1).bit_length()))
    found = []
    pad = 1 << len(names)
    n = len(first)
    wide = np.empty((len(names), n + 3 * pad), dtype=np.int32)
    wide[:] = -1 - n - np.arange(n + 3 * pad)             # past the ends nothing matches
    wide[:, pad:pad + n] = names
    for k in range(len(names)):
        Q, at = 1 << k, np.flatnonzero(names[k] >= 0)
        b = (at // Q - 1) * Q
        at, b = at[b >= 0], b[b >= 0]
        hit = names[k][at] == names[k][b]
        b, q = b[hit], at[hit] - b[hit]
        if not len(b):
            continue
        order = np.lexsort((b, q))
        b, q = b[order], q[order]
        head = np.concatenate([[True], (np.diff(q) != 0) | (np.diff(b) != Q)])
        tail = np.concatenate([head[1:], [True]])
        low, high, q = b[head].copy(), b[tail] + Q, q[head]
        for j in range(k - 1, -1, -1):                    # backward and forward Z-values, below Q here
            step = 1 << j
            low -= step * (wide[j, low - step + pad] == wide[j, low - step + q + pad])
            high += step * (wide[j, high + pad] == wide[j, high + q + pad])
        whole = np.ones(len(q), dtype=bool)               # at its smallest period?
        for factor in _primes(q):
            d = q // factor
            span = np.maximum(q - d, 1)
            j = np.frexp(span.astype(np.float64))[1] - 1
            end = low + span - (1 << j)
            same = (wide[j, low + pad] == wide[j, low + d + pad]) & (wide[j, end + pad] == wide[j, end + d + pad])
            whole &= ~(same & (factor > 1))
        found.append((low[whole], (high + q)[whole], q[whole]))
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _solve(least: int, times: int):
    """Fragments of tiles: ``key, content, offset, whole, low, high, text`` -> ``PIECES``."""

    def groups(rows: Iterator[pa.RecordBatch]):
        held, size = [], 0
        for b in batches(rows, 1024):
            for key, content, offset, whole, low, high, text in zip(
                    *(b.column(i).to_pylist() for i in range(6)), b.column("text").cast(pa.binary()).to_pylist(),
                    strict=True):
                words = text.split()                      # bytes: splits at 0x20 and 0x09-0x0D only
                held.append((key, content, offset, whole, low, high, words))
                size += len(words)
                if size >= GROUP:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tiles in groups(rows):
            codes, upto = [], 0
            for t in tiles:
                number: dict[bytes, int] = {}
                codes.append(np.fromiter((number.setdefault(w, len(number)) for w in t[6]), np.int64, len(t[6])) + upto)
                upto += len(number)
            sizes = np.array([len(c) for c in codes], dtype=np.int64)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            start, stop, q = stretches(np.concatenate(codes), np.repeat(ends, sizes), int(sizes.max()))
            if not len(q):
                continue
            tile = np.searchsorted(ends, start, side="right")
            whole = np.array([t[3] for t in tiles])[tile]
            low, high = (np.array([t[i] for t in tiles], dtype=np.int64)[tile] for i in (4, 5))
            edge = ~whole & ((start == starts[tile]) | (stop == ends[tile]))
            keep = ((stop - start >= np.maximum(least, times * q)) | edge) & (q >= low) & (q < high)
            tile, start, stop, q = tile[keep], start[keep], stop[keep], q[keep]
            shift = np.array([t[2] for t in tiles], dtype=np.int64)[tile] - starts[tile]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tiles[i][0] for i in tile], pa.int64()), pa.array([tiles[i][1] for i in tile], pa.int64()),
                 pa.array(q), pa.array(start + shift), pa.array(stop + shift)],
                ["key", "content", "period", "start", "stop"])

    return run


# ------------------------------------------------------------------- as a job

def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(body).alias("content"), body.alias("text"))


def tiles(docs: DataFrame, base: int = BASE) -> DataFrame:
    """``key, content, offset, whole, low, high, text``: the tiles of all texts; low and high limit a tile's periods.

    A text of at most ``base`` words is one tile of all periods.  Of a longer one,
    the octaves up to ``base / 16`` share tiles of ``base`` words; each further
    octave Q has tiles of 16 Q words.  A tile reaches 8 Q words into the next one.
    These tiles are dealt out, so no task has all of a long text's.
    """
    short = F.octet_length("text") <= 2 * base            # at most ``base`` words for sure
    one = docs.filter(short).select("key", "content", F.lit(0).cast("long").alias("offset"), F.lit(True).alias("whole"),
                                    F.lit(0).cast("long").alias("low"), F.lit(1 << 40).cast("long").alias("high"), "text")
    words = docs.filter(~short).withColumn("words", F.expr(rf"regexp_extract_all(text, r'{WORD}', 0)"))
    top = 1 << max(0, (base // 16).bit_length() - 1)      # the octave from which on each has tiles of its own
    octaves = F.expr(f"""transform(sequence(0, greatest(0L, CAST(floor(log2(size(words) / 4.0D)) AS BIGINT)
                                            - {top.bit_length() - 1}L)), i -> shiftleft({top}L, CAST(i AS INT)))""")
    banded = words.select("*", F.explode(octaves).alias("Q"))
    core = f"(CASE WHEN Q = {top}L THEN {base}L ELSE 16L * Q END)"
    cut = banded.select("key", "content", "words", "Q",
                        F.explode(F.expr(f"sequence(0L, CAST(greatest(size(words) - 1, 0) AS BIGINT), {core})")).alias("offset"))
    many = cut.select("key", "content", "offset", F.lit(False).alias("whole"),
                      F.expr(f"CASE WHEN Q = {top}L THEN 0L ELSE Q END").alias("low"), F.expr("2L * Q").alias("high"),
                      F.expr(f"array_join(slice(words, CAST(offset + 1 AS INT), CAST({core} + 8L * Q AS INT)), ' ')").alias("text"))
    return one.unionAll(many.repartition("key", "content", "low", "offset"))


def stitched(pieces: DataFrame, least: int = 6, times: int = 4) -> DataFrame:
    """``key, content, period, start, stop``: fragments of a document and period that share a period or more, joined."""
    by = Window.partitionBy("key", "content", "period").orderBy("start", "stop")
    before = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum((F.coalesce(F.col("before") - F.col("start") < F.col("period"), F.lit(True))).cast("int")).over(
        by.rowsBetween(Window.unboundedPreceding, 0))
    joined = (pieces.distinct().withColumn("before", before).withColumn("island", island)
              .groupBy("key", "content", "period", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")))
    return (joined.filter(F.col("stop") - F.col("start") >= F.greatest(F.lit(least), F.lit(times) * F.col("period")))
            .drop("island"))


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, times: int = 4,
                  base: int = BASE) -> DataFrame:
    """``key, content, runs``: the runs, by start and period, of every text that has any (``content``: the text's hash)."""
    if times < 4:
        raise ValueError("a boundary is only sure to see stretches of four periods or more")
    if base < 16:
        raise ValueError("tiles hold 16 words at least")
    pieces = tiles(_keyed(docs, key, text), base).mapInArrow(_solve(least, times), PIECES)
    one = F.struct("start", (F.col("stop") - F.col("start")).alias("length"), "period")
    return (stitched(pieces, least, times).groupBy("key", "content")
            .agg(F.array_sort(F.collect_list(one)).cast(RUNS).alias("runs")))


def _collapse(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches(rows, 256):
        out = []
        for text, runs in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("runs").to_pylist(), strict=True):
            words = text.split()
            if runs:
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                for r in runs:
                    edge[r["start"] + r["period"]] += 1
                    edge[r["start"] + r["length"]] -= 1
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            out.append(b" ".join(words))
        kept = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(out, pa.binary()).cast(pa.string())],
                                         [*kept, "collapsed"])


def collapsed(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 6, times: int = 4,
              base: int = BASE) -> DataFrame:
    """``key, runs, collapsed`` for every row: its runs (empty where there are none) and the words that none repeats.

    A word goes if any run holds it behind that run's first period; the rest is joined by single spaces.
    """
    runs = periodic_runs(docs, key, text, least, times, base)
    found = runs.select(F.col("key").alias("k"), F.col("content").alias("c"), "runs")
    rows = _keyed(docs, key, text)
    rows = rows.join(found, rows["key"].eqNullSafe(found["k"]) & (rows["content"] == found["c"]), "left")
    rows = rows.select("key", F.coalesce("runs", F.expr(f"CAST(array() AS {RUNS})")).alias("runs"), "text")
    return rows.mapInArrow(_collapse, f"key long, runs {RUNS}, collapsed string").withColumnRenamed("key", key)


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one (ties: smallest start, then period) and the digests of runs and collapsed text."""
    best = F.expr("""array_min(transform(runs, r -> named_struct('a', -r.length, 'start', r.start, 'period', r.period,
                                                                 'length', r.length)))""")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    out = found.withColumn("_best", best)
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("_best.start").alias("start"),
                      F.col("_best.length").alias("length"), F.col("_best.period").alias("period"),
                      F.expr("1000L * _best.length div _best.period").alias("exponent_milli"),
                      F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                      F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
