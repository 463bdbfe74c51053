"""WARC archives of captures, with an index merged from locally sorted runs.

Every capture becomes a gzip member of a WARC 1.0 file: of captures with equal
payloads of at least ``min_bytes`` bytes the one with the largest ``page_id``
is stored as ``response``, the others as ``revisit`` records without payload
that refer to it.  Each writing task gets its captures in order of URL key and
timestamp, fills files of about ``file_bytes`` and returns the index entries of
its run in that order.

The runs' entries are dealt into ranges of (URL key, timestamp, page id), which
splits even one URL with a third of all captures; each range merges the
fragments of its runs with a loser tree, one comparison a level for each entry.
Ranges in order, and entries in order inside, are the global capture histories;
``position`` numbers them.

The archives are then read back through the index, file by file.  Files are
named after the task attempt, and only those that the committed index names are
read, so files of lost or repeated attempts do no harm.  They lie under the
shared folder of ``spark.checkpoint.dir``, reached through Arrow's file systems.

Defined cases: a null html is an empty payload, a null url an empty one; page
ids stand for capture seconds after 2024 (null: 0).  A null ``page_id`` is a
response only if no capture with its payload has an id; rows equal in page id
and payload are all responses.  An empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanlake.llm.common import batches, saved
from urbanlake.session import work_path

FILE_BYTES = 32 << 20
#: Index entries that one range merges, and archive bytes that one task reads back, beyond the session's partitions.
RANGE_ENTRIES, READ_BYTES = 200_000, 128 << 20
#: Seconds of 2024-01-01 and the span that capture times repeat after.
EPOCH, SPAN = 1_704_067_200, 1_000_000_000
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

INDEX = "urlkey string, ts long, page_id long, run int, seq long, file string, offset long, length long"
INDEX_ARROW = pa.schema([("urlkey", pa.string()), ("ts", pa.int64()), ("page_id", pa.int64()), ("run", pa.int32()),
                         ("seq", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def url_key(url: Column) -> Column:
    """Host labels from the top-level domain down, then path and query; without scheme, ``www.``, port and fragment."""
    low = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_replace(F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), r"^www\d*\.", "")
    rest = F.regexp_extract(low, r"^[a-z][a-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.when(host == "", low).otherwise(F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), rest))


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, ts: int, sha1: str, size: int, payload: bytes | None,
           refers_to: int | None) -> bytes:
    """One WARC record with its two closing line ends; ``sha1`` (hex) and ``size`` are the payload's, which a revisit lacks."""
    name = lambda x: f"<urn:page:{'' if x is None else x}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}",
            f"WARC-Date: {datetime.fromtimestamp(ts, UTC):%Y-%m-%dT%H:%M:%SZ}",
            f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%')}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(sha1)).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; a response's digest and size are taken from its payload itself."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    field = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    of = lambda x: int(x[10:-1]) if x and x != "<urn:page:>" else None
    kind = field["WARC-Type"]
    told = field["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response":
        size, digest = len(payload), digest32(payload)
        if digest != told:
            raise ValueError(f"payload of {field['WARC-Record-ID']} doesn't match its digest")
    else:
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        digest = told
    return {"page_id": of(field["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": of(field.get("WARC-Refers-To"))}


class LoserTree:
    """Merges sorted lists: each inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list]) -> None:
        self.runs, self.at, self.k = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(1, self.k)
        for run in range(self.k):
            self._play(run)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's next entry comes before run b's; a finished run comes last, equal keys by run."""
        done_a, done_b = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if done_a or done_b:
            return done_b and (not done_a or a < b)
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        """Walks up from the run's leaf; while the tree fills, the first to reach a node waits there."""
        node = (run + self.k) // 2
        while node > 0:
            waiting = self.losers[node]
            if waiting < 0:
                self.losers[node] = run
                return
            if self._before(waiting, run):
                self.losers[node], run = run, waiting
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """``(run, index)`` in global order."""
        while self.k:
            run = self.losers[0]
            if self.at[run] >= len(self.runs[run]):
                return
            yield run, self.at[run]
            self.at[run] += 1
            self._play(run)


def captures(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, sha1, size, refers_to, payload``: every capture, with a payload only where it is a response.

    Which capture of a payload is the response is decided on rows without
    payloads.  Payloads meet by digest once they are one for each map task, so a page
    that a third of all captures share travels once for each task.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").alias("size"), F.sha1("payload").alias("sha1"))
    shared = rows.filter(F.col("size") >= min_bytes) if min_bytes > 0 else rows
    narrow = saved(shared.select("page_id", "url", "sha1", "size"), "warc-captures")
    # written tables: the join reads plain exchanges, which adaptive execution splits at a frequent digest
    latest = saved(narrow.groupBy("sha1").agg(F.max("page_id").alias("latest")), "warc-latest")
    later = F.coalesce(F.col("page_id") != F.col("latest"), F.col("page_id").isNull() & F.col("latest").isNotNull())
    told = saved(narrow.join(latest, "sha1").select("page_id", "url", "sha1", "size", F.when(later, F.col("latest")).alias("refers_to")),
                 "warc-decided")
    payloads = shared.groupBy("sha1").agg(F.first("payload").alias("payload"))
    out = (told.filter("refers_to IS NOT NULL").withColumn("payload", F.lit(None).cast("binary"))
           .unionByName(told.filter("refers_to IS NULL").join(payloads, "sha1")))
    if min_bytes > 0:
        small = rows.filter(F.col("size") < min_bytes)
        out = out.unionByName(small.withColumn("refers_to", F.lit(None).cast("long")))
    return out


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives under ``folder``; the committed index entries, each with its run."""
    told = (captures(pages, min_bytes)
            .select(url_key(F.col("url")).alias("urlkey"),
                    (F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(SPAN)) + EPOCH).alias("ts"), "page_id", "url", "sha1", "size",
                    "payload", "refers_to")
            .sortWithinPartitions("urlkey", "ts", "page_id"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, offset, seq, files = None, "", 0, 0, 0
        for b in batches(rows):
            entries = []
            for r in b.to_pylist():
                if out is None:
                    name = f"captures-{task.partitionId():06d}-{task.taskAttemptId()}-{files:04d}.warc.gz"
                    out, offset, files = store.open_output_stream(f"{base}/{name}", compression=None), 0, files + 1
                data = gzip.compress(record(r["page_id"], r["url"], r["ts"], r["sha1"], r["size"], r["payload"],
                                            r["refers_to"]), mtime=0)
                out.write(data)
                entries.append({"urlkey": r["urlkey"], "ts": r["ts"], "page_id": r["page_id"], "run": task.partitionId(),
                                "seq": seq, "file": name, "offset": offset, "length": len(data)})
                offset, seq = offset + len(data), seq + 1
                if offset >= file_bytes:
                    out.close()
                    out = None
            yield pa.RecordBatch.from_pylist(entries, schema=INDEX_ARROW)
        if out is not None:
            out.close()

    return saved(told.mapInArrow(run, INDEX), "warc-index")


def merge_index(index: DataFrame, ranges: int) -> DataFrame:
    """The index in global order: its columns and ``position``, from 0 in order of URL key, timestamp and page id."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(rows), INDEX_ARROW)      # one range of index entries
        if not table.num_rows:
            return
        of_run = table.column("run").to_pylist()
        keys = list(zip(table.column("urlkey").to_pylist(), table.column("ts").to_pylist(),
                        (-1 << 63 if x is None else x for x in table.column("page_id").to_pylist()), strict=True))
        starts = [i for i in range(len(keys)) if not i or of_run[i] != of_run[i - 1]]
        fragments = [keys[a:b] for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
        order = [starts[k] + i for k, i in LoserTree(fragments)]
        merged = table.take(pa.array(order, pa.int64()))
        merged = merged.append_column("part", pa.array([TaskContext.get().partitionId()] * len(order), pa.int32()))
        merged = merged.append_column("place", pa.array(range(len(order)), pa.int64()))
        yield from merged.to_batches()

    by_range = (index.repartitionByRange(ranges, F.col("urlkey"), F.col("ts"), F.col("page_id"))
                .sortWithinPartitions("run", "seq"))                    # each run's fragment, in the run's own order
    merged = saved(by_range.mapInArrow(run, INDEX + ", part int, place long"), "warc-merged")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row for each range
    starts = (merged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    return (merged.join(starts, "part").withColumn("position", F.col("start") + F.col("place"))
            .drop("part", "place", "start"))


def read_archives(index: DataFrame, folder: str, tasks: int) -> DataFrame:
    """Every record that the index names, read and parsed in ``tasks`` tasks: its fields, URL key, timestamp and position.

    The number is explicit, as the index is small where the archives are not.
    """
    files = index.repartition(tasks, "file").groupBy("file").agg(F.collect_list(F.struct("offset", "length", "urlkey", "ts", "position")).alias("entries"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for b in batches(rows, 16):
            for row in range(b.num_rows):
                out = []
                entries = sorted(b.column("entries")[row].as_py(), key=lambda x: x["offset"])
                with store.open_input_file(f"{base}/{b.column('file')[row].as_py()}") as f:
                    for x in entries:
                        f.seek(x["offset"])
                        data = zlib.decompress(f.read(x["length"]), 31)
                        out.append(parse(data) | {"urlkey": x["urlkey"], "captured": x["ts"], "position": x["position"]})
                yield pa.RecordBatch.from_pylist(out, schema=RECORDS)

    return files.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                 "refers_to long, urlkey string, captured long, position long")


RECORDS = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                     ("record_type", pa.string()), ("refers_to", pa.int64()), ("urlkey", pa.string()),
                     ("captured", pa.int64()), ("position", pa.int64())])


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes ``pages (page_id, url, html)`` to WARC files, merges their index and reads them back."""
    spark = pages.sparkSession
    folder = work_path(spark, "llm-warc")
    index = write_archives(pages, folder, min_bytes, file_bytes)
    entries, files, held = index.agg(F.count(F.lit(1)), F.countDistinct("file"), F.coalesce(F.sum("length"), F.lit(0))).first()
    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = merge_index(index, max(few, -(-entries // RANGE_ENTRIES)))
    return read_archives(merged, folder, max(1, min(files, few), -(-held // READ_BYTES)))
