"""Token ids in patched frame-of-reference files.

Documents are encoded with a tokenizer of the tokenizers library, end id
included, and their ids written in ascending ``doc_id`` order.  A file holds
blocks of 128 ids.  A block subtracts its minimum and packs what is left at the
bit width that its 90th percentile needs; what doesn't fit stands in the file's
exception list with its place.  The widths and an index of block starts allow
any block to be unpacked alone.  Layout of a file, little-endian::

    magic "PFOR1\\n", 10 unsigned 64-bit: documents, ids, blocks, packed bytes, exceptions, the five sections' sizes
    documents: ids as signed 64-bit, whether null as a byte, lengths as unsigned 32-bit
    blocks:    minimum as unsigned 32-bit, width as a byte, exceptions as a byte, start in the packed bytes as unsigned 64-bit
    packed:    128 x width bits for each block, most significant bit first
    places of exceptions as bytes, their values (less the minimum) as unsigned 32-bit

A text is cut where its tokenizer always ends a token, and each distinct run is
encoded once for a worker's cache; tests hold this against whole-text encoding.

The documents are range-partitioned by id, so a task writes the files of one
range, ``file_ids`` ids or the document that passes them in each.  File names
carry the task attempt and only files that the committed list names are read
back.  Defined cases: a null text is empty and has the end id alone; a null
``doc_id`` comes first; repeated ids follow each other in order of a hash of
their texts.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlake.llm.common import RaggedCache, by_bytes, saved, text_bytes
from urbanlake.session import work_path

BLOCK_IDS = 128
PERCENTILE = 90
FILE_IDS = 4_000_000
#: Bytes of text that are cut and looked up at once.
GROUP_BYTES = 8 << 20
#: The normaliser and the pre-tokenizer whose borders are cut at.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}
MAGIC = b"PFOR1\n"
#: What a byte is to the tokenizer's borders, and the pairs of kinds between which every text is cut.
BLANK, LETTER, DIGIT, APOSTROPHE, MARK, OTHER = range(6)
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[0x21:0x7F] = MARK
KINDS[ord("a"):ord("z") + 1] = KINDS[ord("A"):ord("Z") + 1] = LETTER
KINDS[ord("0"):ord("9") + 1] = DIGIT
KINDS[ord("'")] = APOSTROPHE
KINDS[[0x20, 0x0A]] = BLANK
BORDER = np.zeros(64, dtype=bool)
for _a, _b in [(LETTER, MARK), (LETTER, APOSTROPHE), (MARK, LETTER), *((DIGIT, x) for x in (LETTER, DIGIT, MARK, APOSTROPHE)),
               *((x, DIGIT) for x in (LETTER, MARK, APOSTROPHE)), *((BLANK, x) for x in range(1, 6))]:
    BORDER[_a * 8 + _b] = True


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits that each number needs."""
    return np.frexp(x.astype(np.float64))[1]


def pack(ids: np.ndarray) -> dict[str, np.ndarray]:
    """The blocks of a sequence of unsigned 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK_IDS)
    full = np.empty(blocks * BLOCK_IDS, dtype=np.uint32)
    full[:n] = ids
    full[n:] = ids[-1] if n else 0
    full = full.reshape(blocks, BLOCK_IDS)
    low = full.min(axis=1) if blocks else np.empty(0, np.uint32)
    over = full - low[:, None]
    rank = BLOCK_IDS * PERCENTILE // 100
    width = _bits(np.partition(over, rank, axis=1)[:, rank]).astype(np.uint8) if blocks else np.empty(0, np.uint8)
    outside = (over >> width.astype(np.uint32)[:, None]) > 0 if blocks else np.zeros((0, BLOCK_IDS), bool)
    outside[width == 32] = False                       # a shift by 32 is none
    sizes = width.astype(np.uint64) * (BLOCK_IDS // 8)
    start = np.cumsum(sizes) - sizes if blocks else np.empty(0, np.uint64)
    packed = np.zeros(int(sizes.sum()), dtype=np.uint8)
    for w in np.unique(width).tolist():
        if w:
            at = np.flatnonzero(width == w)
            kind, room = (">u2", 16) if w <= 16 else (">u4", 32)
            kept = np.where(outside[at], 0, over[at]).astype(kind)
            bits = np.unpackbits(kept.view(np.uint8).reshape(-1, room // 8), axis=1)[:, room - w:]
            packed[start[at].astype(np.int64)[:, None] + np.arange(w * BLOCK_IDS // 8)] = np.packbits(
                bits.reshape(len(at), -1), axis=1)
    return {"low": low, "width": width, "outside": outside.sum(axis=1).astype(np.uint8), "start": start.astype(np.uint64),
            "packed": packed, "place": np.nonzero(outside)[1].astype(np.uint8), "value": over[outside]}


def unpack(low: np.ndarray, width: np.ndarray, outside: np.ndarray, start: np.ndarray, packed: np.ndarray,
           place: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The ids of :func:`pack`."""
    over = np.zeros((len(width), BLOCK_IDS), dtype=np.uint32)
    for w in np.unique(width).tolist():
        if w:
            at = np.flatnonzero(width == w)
            kind, room = (">u2", 16) if w <= 16 else (">u4", 32)
            data = packed[start[at].astype(np.int64)[:, None] + np.arange(w * BLOCK_IDS // 8)]
            bits = np.zeros((len(at) * BLOCK_IDS, room), dtype=np.uint8)
            bits[:, room - w:] = np.unpackbits(data, axis=1).reshape(-1, w)
            over[at] = np.packbits(bits, axis=1).view(kind).reshape(len(at), BLOCK_IDS)
    over[np.repeat(np.arange(len(width)), outside), place] = value
    return (over + low[:, None]).ravel()[:n]


def file_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    p = pack(ids)
    docs = (np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is None for x in doc_ids], "u1").tobytes()
            + lengths.astype("<u4").tobytes())
    table = p["low"].astype("<u4").tobytes() + p["width"].tobytes() + p["outside"].tobytes() + p["start"].astype("<u8").tobytes()
    sections = [docs, table, p["packed"].tobytes(), p["place"].tobytes(), p["value"].astype("<u4").tobytes()]
    head = struct.pack("<10Q", len(doc_ids), len(ids), len(p["width"]), len(p["packed"]), len(p["place"]), *map(len, sections))
    return b"".join([MAGIC, head, *sections])


def read_file(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their lengths and all ids of a file."""
    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a token id file")
    docs, n, blocks, _, outside, *sizes = struct.unpack_from("<10Q", data, len(MAGIC))
    starts = len(MAGIC) + 80 + np.concatenate([[0], np.cumsum(sizes)])
    get = lambda kind, count, at: np.frombuffer(data, kind, count, int(at))
    d, b = starts[0], starts[1]
    ids = [None if null else int(x) for x, null in zip(get("<i8", docs, d), get("u1", docs, d + 8 * docs), strict=True)]
    return ids, get("<u4", docs, d + 9 * docs), unpack(
        get("<u4", blocks, b), get("u1", blocks, b + 4 * blocks), get("u1", blocks, b + 5 * blocks),
        get("<u8", blocks, b + 6 * blocks), get("u1", sizes[2], starts[2]), get("u1", outside, starts[3]),
        get("<u4", outside, starts[4]), n)


def runs_of(texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """The runs of all texts without the blanks between them, and how many each text has.

    Texts are in lower case where that is A-Z only and are cut at blanks, line
    ends and ASCII borders of tokens: on both sides of a digit, behind a letter,
    and before a letter unless an apostrophe stands there, which may begin a
    contraction.  A text that may hold a special token is cut at blanks alone.
    """
    special = np.array([b"<|" in t for t in texts], dtype=bool)
    lowered = [t if x else t.lower() for t, x in zip(texts, special, strict=True)]
    sizes = np.fromiter(map(len, lowered), dtype=np.int64, count=len(lowered))
    first = np.cumsum(sizes) - sizes
    kind = KINDS[np.frombuffer(b"".join(lowered), dtype=np.uint8)]
    start = np.zeros(len(kind), dtype=bool)
    start[1:] = BORDER[kind[:-1] * 8 + kind[1:]]
    for i in np.flatnonzero(special).tolist():
        one = kind[first[i]:first[i] + sizes[i]] == BLANK
        start[first[i] + 1:first[i] + sizes[i]] = one[:-1]
    start[first[sizes > 0]] = True
    kept = kind != BLANK
    start &= kept
    at = np.flatnonzero(start)
    upto = np.concatenate([[0], np.cumsum(kept)])
    offsets = np.append(upto[at], upto[-1]).astype(np.int32)
    data = np.frombuffer(b"".join(lowered), dtype=np.uint8)[kept]
    runs = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return runs, np.diff(np.searchsorted(at, np.append(first, len(kind))))


class Encoder:
    """Batch encoder of whole texts through a cache of the runs that no token reaches across.

    The cuts of :func:`runs_of` hold for tokenizers that put texts in lower case,
    drop blanks and part words, digits and other signs as ``RULES`` says; any
    other tokenizer is refused.
    """

    def __init__(self, tokenizer_json: str) -> None:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        rules = json.loads(tokenizer_json)
        if {k: rules[k] for k in RULES} != RULES:
            raise ValueError("the cuts between runs are not known to hold for this tokenizer")
        tokenizer = Tokenizer.from_str(tokenizer_json)

        def encode(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            words = [r.decode("utf-8", "replace") for r in runs]
            e = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)     # each run by itself
            return (np.array(e.ids, dtype=np.int32),
                    np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(runs)).astype(np.int64))

        self.cache = RaggedCache(encode)

    def encode(self, texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and how many each text has."""
        return self.cache.gather(*runs_of(texts.to_pylist()))


FILES = "part int, seq int, file string, docs long, ids long"
FILES_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("file", pa.string()), ("docs", pa.int64()),
                         ("ids", pa.int64())])


def write_ids(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the files; the committed list ``part, seq, file, docs, ids`` in global order of (part, seq)."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        # a vocabulary file, of fixed size; a worker keeps the value, and with it the encoder, from task to task
        shared = spark.sparkContext.broadcast({"tokenizer": f.read()})
    rows = text_bytes(docs).withColumn("h", F.xxhash64("utf8"))
    ranged = (rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("doc_id"), F.col("h"))
              .sortWithinPartitions("doc_id", "h", "utf8").drop("h"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, kept = TaskContext.get(), shared.value
        store, base = fs.FileSystem.from_uri(folder)
        ids, lengths, names, held, seq = [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, lengths, names, held, seq
            store.create_dir(base, recursive=True)
            name = f"ids-{task.partitionId():06d}-{task.taskAttemptId()}-{seq:04d}.pfor"
            with store.open_output_stream(f"{base}/{name}", compression=None) as f:
                f.write(file_bytes(names, np.concatenate(lengths), np.concatenate(ids)))
            out = pa.RecordBatch.from_pylist([{"part": task.partitionId(), "seq": seq, "file": name, "docs": len(names),
                                               "ids": held}], schema=FILES_ARROW)
            ids, lengths, names, held, seq = [], [], [], 0, seq + 1
            return out

        for b in by_bytes(rows, "utf8", GROUP_BYTES):
            if "encoder" not in kept:
                kept["encoder"] = Encoder(kept["tokenizer"])
            got, counts = kept["encoder"].encode(b.column("utf8"))
            ids.append(np.insert(got, np.cumsum(counts), end_id).astype(np.uint32))
            lengths.append(counts + 1)
            names.extend(b.column("doc_id").to_pylist())
            held += len(ids[-1])
            if held >= file_ids:
                yield flush()
        if names:
            yield flush()

    return saved(ranged.mapInArrow(run, FILES), "pfor-files")


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read from the files of the list."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)    # a row for each file
    first = files.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))
    dealt = first.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), "file")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for b in rows:
            for name, first in zip(b.column("file").to_pylist(), b.column("first").to_pylist(), strict=True):
                with store.open_input_file(f"{base}/{name}") as f:
                    names, lengths, ids = read_file(f.read())
                data, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths
                crc = [zlib.crc32(data[4 * a:4 * z]) for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(first + starts), pa.array(lengths.astype(np.int64)),
                     pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Writes all documents' ids and reads them back."""
    folder = work_path(docs.sparkSession, "llm-pfor")
    return read_ids(write_ids(docs, folder, tokenizer_path, end_id, file_ids), folder)
