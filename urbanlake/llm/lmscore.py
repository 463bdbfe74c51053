"""Language-model scores by stupid backoff, computed relationally.

Every document is scored by the n-grams of all other documents (Brants et al.,
2007): a word after the longest context that was seen with it gets its share of
that context's continuations, and each word of context given up costs a factor
``alpha``.  A document's score is the sum of its words' logarithms.  Counts
come from the whole input less the document's own, which makes the scores
held-out ones; with ``leave_one_out=False`` the own counts stay in.

The relations are kept in columns instead of one row for each n-gram:

1. ``token_blocks``: the documents of a partition, in blocks of about
   ``BLOCK_TOKENS`` words, as places in the block's vocabulary of word hashes.
   Written once as a table bucketed by block, so that the later steps see the
   same blocks and step 4 doesn't shuffle them.
2. ``block_grams``: the exploded n-grams: a block's distinct ones of each order
   as sorted hashes with their counts, combined before the shuffle, and cut into
   ranges of the hash.
3. ``gram_totals``: the count table, partitioned by ranges of the hash, and its
   join to the exploded n-grams.  A range holds about ``RANGE_GRAMS`` entries
   whatever the input, because the number of ranges follows the number of words.
   No list is cut into more than ``MOST_CUTS`` ranges at once: beyond that many,
   the lists of some blocks are first merged within a wider range, and the merged
   list is cut on, as often as it takes.  So a level has at most ``MOST_CUTS`` rows
   for each list and order, not blocks times ranges, and a frequent n-gram reaches
   its range as one entry for each merged list.  The counts go back the way that
   the n-grams came.
4. ``block_scores``: the counts of a block's ranges, in order, stand beside its
   sorted n-grams again; the words' scores are summed for each document.

Hashes have 26 bits more than the number of n-grams needs, so two n-grams are
taken for one about once in 2^26; 64 bits are the most, which 2.7e11 n-grams need
(beyond, that chance doubles with the input).  Numbers travel as byte planes (all
lowest bytes, then all next ones, up to the highest that is used) of sorted
hashes' differences, each plane of a long list compressed by itself.

Defined cases: words are what ASCII white space separates, A-Z lower-cased; a
null or empty text has no word and score 0; a word that no other document holds
counts as one beyond all others' words, ``1 / (words of others + 1)``, after
giving up its whole context; repeated rows are documents of their own and so
know each other; a null ``doc_id`` is scored.
"""

from __future__ import annotations

import math
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlake.llm.common import batches, text_bytes
from urbanlake.session import work_path

ORDER = 3
ALPHA = 0.4
BLOCK_TOKENS = 1_000_000
RANGE_GRAMS = 2_000_000
MOST_CUTS = 1_000
SPARE_BITS, MOST_BITS = 26, 64
SHORT = 64


def planes(x: np.ndarray) -> bytes:
    """64-bit numbers as planes of bytes, the lowest first, up to the highest that isn't zero.

    The first byte says how many planes there are and, by its highest bit,
    whether each is compressed by itself, which short lists are not; the
    compressed ones' sizes stand before them.
    """
    each = x.astype("<u8").view(np.uint8).reshape(-1, 8).T
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    if len(x) < SHORT:
        return bytes([width]) + each[:width].tobytes()
    packed = [zstandard.compress(p.tobytes(), 1) for p in each[:width]]
    return bytes([128 + width]) + struct.pack(f"<{width}I", *map(len, packed)) + b"".join(packed)


def numbers(data: bytes) -> np.ndarray:
    width = data[0] & 127
    if data[0] < 128:
        each = list(np.frombuffer(data, np.uint8, offset=1).reshape(width, -1))
    else:
        sizes, at, each = struct.unpack_from(f"<{width}I", data, 1), 1 + 4 * width, []
        for size in sizes:
            each.append(np.frombuffer(zstandard.decompress(data[at:at + size]), np.uint8))
            at += size
    out = np.zeros((len(each[0]), 8), dtype=np.uint8)
    for i, plane in enumerate(each):
        out[:, i] = plane
    return out.view("<u8").ravel()


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, lengths: np.ndarray, order: int, bits: int = 64) -> tuple[list[np.ndarray], np.ndarray]:
    """For each order, the hash of the n-gram that ends at each word; and how many words of its document each word ends.

    An order counts for a word only if its document has that many up to it.
    """
    within = np.arange(len(words)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
    out = [mix(words + np.uint64(1))]
    for n in range(2, order + 1):
        before = np.concatenate([[np.uint64(0)], out[-1][:-1]]) if len(words) else out[-1]
        out.append(mix(before * np.uint64(0x9E3779B97F4A7C15) + out[0] + np.uint64(n)))
    return [h >> np.uint64(64 - bits) for h in out], within


BLOCK_SCHEMA = "block long, doc_ids array<long>, lengths array<int>, vocabulary binary, tokens binary"


def token_blocks(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())),
                        ("vocabulary", pa.binary()), ("tokens", pa.binary())])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        doc_ids, lengths, tokens, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in known), dtype=np.uint64, count=len(known))
            return pa.RecordBatch.from_pylist([{
                "block": (part << 32) + seq, "doc_ids": doc_ids, "lengths": lengths, "vocabulary": hashes.tobytes(),
                "tokens": planes(np.concatenate(tokens))}], schema=schema)

        for b in batches(rows):
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("utf8").to_pylist(), strict=True):
                words = t.lower().split()
                tokens.append(np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int32, count=len(words)))
                doc_ids.append(d)
                lengths.append(len(words))
                held += len(words)
                if held >= BLOCK_TOKENS:
                    yield block()
                    known, seq = {}, seq + 1
                    doc_ids, lengths, tokens, held = [], [], [], 0
        if doc_ids:
            yield block()

    spark, table = docs.sparkSession, f"urbanlake_lm_blocks_{uuid.uuid4().hex}"
    (text_bytes(docs).mapInArrow(run, BLOCK_SCHEMA).write.format("parquet").option("path", work_path(spark, "llm-lm-blocks"))
     .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(table))
    return spark.table(table)


def _block_grams(block: dict, order: int, bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The hashes of each order, the words up to each one in its document, and the documents' lengths."""
    lengths = np.array(block["lengths"], dtype=np.int64)
    at = numbers(block["tokens"]).astype(np.int64)
    return (*gram_hashes(np.frombuffer(block["vocabulary"], np.uint64)[at], lengths, order, bits), lengths)


GRAM_SCHEMA = "range long, member long, n int, grams binary, counts binary"
TOTAL_SCHEMA = "range long, member long, n int, totals binary"


def cut_up(member: int, n: int, grams: np.ndarray, counts: np.ndarray, inside: int, fan: int, ranges: int,
           bits: int) -> pa.RecordBatch:
    """A member's sorted n-grams of one wider range as a row for each of the ``fan`` ranges in it that has any.

    ``ranges`` is the number of ranges of the narrower kind in all.
    """
    first = inside * fan
    bounds = np.array([((first + i) << bits) // ranges for i in range(1, fan)], dtype=np.uint64)
    cuts = [0, *np.searchsorted(grams, bounds).tolist(), len(grams)]
    spans = [(first + k, a, z) for k, (a, z) in enumerate(zip(cuts, cuts[1:], strict=False)) if a < z]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _, _ in spans], pa.int64()), pa.array([member] * len(spans), pa.int64()),
         pa.array([n] * len(spans), pa.int32()),
         pa.array([planes(np.diff(grams[a:z], prepend=np.uint64(0))) for _, a, z in spans], pa.binary()),
         pa.array([planes(counts[a:z]) for _, a, z in spans], pa.binary())], ["range", "member", "n", "grams", "counts"])


def block_grams(blocks: DataFrame, order: int, bits: int, ranges: int) -> DataFrame:
    """``range, member, n, grams, counts``: a block's distinct n-grams of one order in one range of the hash; the member is the block."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows, 1):
            block = b.to_pylist()[0]
            orders, within, _ = _block_grams(block, order, bits)
            for n, h in enumerate(orders, 1):
                grams, counts = np.unique(h[within >= n], return_counts=True)
                yield from batches(iter([cut_up(block["block"], n, grams, counts, 0, ranges, ranges, bits)]), 64)

    return blocks.mapInArrow(run, GRAM_SCHEMA)


def combined(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[slice]]:
    """The distinct n-grams of some lists, their counts, each entry's place among them, and each list's entries."""
    keys = [np.cumsum(numbers(g), dtype=np.uint64) for g in rows.column("grams").to_pylist()]
    counts = np.concatenate([numbers(c) for c in rows.column("counts").to_pylist()])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(k) for k in keys]).tolist()
    return (distinct, np.bincount(place, counts, len(distinct)).astype(np.uint64), place,
            [slice(z - len(k), z) for k, z in zip(keys, ends, strict=True)])


def by_order(rows: pa.Table) -> Iterator[tuple[int, np.ndarray, pa.Table]]:
    """The rows of each order, and where they stand."""
    order = rows.column("n").to_numpy()
    for n in np.unique(order).tolist():
        at = np.flatnonzero(order == n)
        yield n, at, rows.take(pa.array(at))


def with_totals(rows: pa.Table, totals: list[bytes]) -> pa.Table:
    return pa.table({"range": rows.column("range"), "member": rows.column("member"), "n": rows.column("n"),
                     "totals": pa.array(totals, pa.binary())})


def range_counts(grams: DataFrame) -> DataFrame:
    """``range, member, n, totals``: for each member's n-grams of a range, in order, their counts over all members."""

    def run(rows: pa.Table) -> pa.Table:
        totals = [b""] * rows.num_rows
        for _, at, part in by_order(rows):
            _, counts, place, lists = combined(part)
            for row, entries in zip(at, lists, strict=True):
                totals[row] = planes(counts[place[entries]])
        return with_totals(rows, totals)

    return grams.groupBy("range").applyInArrow(run, TOTAL_SCHEMA)


def gram_totals(grams: DataFrame, ranges: int, fans: list[int], members: int, held: float, bits: int) -> DataFrame:
    """``range_counts`` after cutting the ranges on by each of ``fans``.

    ``members`` lists meet in a range, of about ``held`` n-grams each.  As many
    as give ``RANGE_GRAMS`` are merged into one list, which is the member of the
    narrower ranges that it is cut into; its counts come back to its lists, which
    are shuffled once for both ways (the plan reuses the exchange).
    """
    if not fans:
        return range_counts(grams)
    fan, narrower = fans[0], ranges * fans[0]
    parts = max(1, math.ceil(members * held / RANGE_GRAMS))
    lists = grams.withColumn("part", F.pmod(F.xxhash64("member"), F.lit(parts)).cast("long"))

    def merge(rows: pa.Table) -> pa.Table:
        inside, part = rows.column("range")[0].as_py(), rows.column("part")[0].as_py()
        out = []
        for n, _, some in by_order(rows):
            distinct, counts, _, _ = combined(some)
            out.append(cut_up(part, n, distinct, counts, inside, fan, narrower, bits))
        return pa.Table.from_batches(out)

    def give_back(rows: pa.Table, found: pa.Table) -> pa.Table:
        totals = [b""] * rows.num_rows
        found = found.sort_by([("n", "ascending"), ("narrow", "ascending")])
        of, data = found.column("n").to_pylist(), found.column("totals").to_pylist()
        for n, at, part in by_order(rows):
            distinct, _, place, entries = combined(part)
            total = np.concatenate([numbers(x) for k, x in zip(of, data, strict=True) if k == n])
            if len(total) != len(distinct):
                raise ValueError("the counts don't belong to these lists")
            for row, some in zip(at, entries, strict=True):
                totals[row] = planes(total[place[some]])
        return with_totals(rows, totals)

    found = gram_totals(lists.groupBy("range", "part").applyInArrow(merge, GRAM_SCHEMA), narrower, fans[1:], parts,
                        RANGE_GRAMS / fan, bits)
    found = found.select(F.floor(F.col("range") / fan).cast("long").alias("range"), F.col("member").alias("part"), "n",
                         F.col("range").alias("narrow"), "totals")
    return (lists.groupBy("range", "part").cogroup(found.groupBy("range", "part"))
            .applyInArrow(give_back, TOTAL_SCHEMA))


def cuts_for(ranges: int) -> list[int]:
    """Equal cuts, one after the other, that give ``ranges`` ranges or a few more; none is above ``MOST_CUTS``."""
    steps = 1
    while MOST_CUTS ** steps < ranges:
        steps += 1
    fan = max(1, math.floor(ranges ** (1 / steps)) - 1)
    while fan ** steps < ranges:
        fan += 1
    return [fan] * steps


def seen_elsewhere(h: np.ndarray, doc: np.ndarray, totals: np.ndarray, leave_one_out: bool) -> np.ndarray:
    """How often each position's n-gram is counted; ``totals`` has the distinct ones' counts in order of their hash.

    A stable sort leaves the positions of equal n-grams in document order, so a
    document's own are neighbours.
    """
    order = np.argsort(h, kind="stable")
    s, d = h[order], doc[order]
    new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.empty(0, bool)
    place = np.cumsum(new) - 1
    if (place[-1] + 1 if len(s) else 0) != len(totals):
        raise ValueError("the counts don't belong to this block")
    count = totals[place]
    if leave_one_out and len(s):
        run = np.cumsum(new | np.concatenate([[True], d[1:] != d[:-1]])) - 1
        count = count - np.bincount(run)[run]
    out = np.empty(len(h), dtype=np.int64)
    out[order] = count
    return out


def word_scores(orders: list[np.ndarray], within: np.ndarray, lengths: np.ndarray, totals: list[np.ndarray], words: int,
                alpha: float, leave_one_out: bool) -> np.ndarray:
    """The logarithm of each word's score."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    others = words - (lengths[doc] if leave_one_out else np.zeros(len(doc), np.int64))
    available = np.minimum(within, len(orders))
    score = np.log(1.0 / (others + 1.0)) + available * math.log(alpha)
    shorter = others
    for n, h in enumerate(orders, 1):                     # a longer context overrules a shorter one
        real = within >= n
        count = np.zeros(len(doc), dtype=np.int64)
        count[real] = seen_elsewhere(h[real], doc[real], totals[n - 1], leave_one_out)
        hit = count > 0
        below = others if n == 1 else np.concatenate([[0], shorter[:-1]])
        score[hit] = np.log(count[hit] / below[hit]) + (available[hit] - n) * math.log(alpha)
        shorter = count
    return score


def block_scores(blocks: DataFrame, totals: DataFrame, words: int, order: int, bits: int, alpha: float,
                 leave_one_out: bool) -> DataFrame:
    def run(block: pa.Table, ranges: pa.Table) -> pa.Table:
        block = block.to_pylist()[0]
        orders, within, lengths = _block_grams(block, order, bits)
        ranges = ranges.sort_by([("n", "ascending"), ("range", "ascending")])
        of, data = ranges.column("n").to_pylist(), ranges.column("totals").to_pylist()
        total = []
        for n in range(1, order + 1):
            parts = [numbers(x).astype(np.int64) for k, x in zip(of, data, strict=True) if k == n]
            total.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
        each = word_scores(orders, within, lengths, total, words, alpha, leave_one_out)
        return pa.table({"doc_id": pa.array(block["doc_ids"], pa.int64()), "n_words": pa.array(lengths),
                         "log_score": pa.array(np.bincount(np.repeat(np.arange(len(lengths)), lengths), each, len(lengths)))})

    return (blocks.groupBy("block").cogroup(totals.groupBy("member"))
            .applyInArrow(run, "doc_id long, n_words long, log_score double"))


def backoff_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, leave_one_out: bool = True) -> DataFrame:
    """``doc_id, n_words, log_score``: a row for each row of ``docs (doc_id, text)``."""
    blocks = token_blocks(docs)
    count, words = blocks.agg(F.count(F.lit(1)), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    words = words or 0
    bits = min(MOST_BITS, (words * order).bit_length() + SPARE_BITS)
    fan, *fans = cuts_for(-(-words * order // RANGE_GRAMS))
    grams = block_grams(blocks, order, bits, fan)
    totals = gram_totals(grams, fan, fans, count, words * order / max(count, 1) / fan, bits)
    return block_scores(blocks, totals, words, order, bits, alpha, leave_one_out)
