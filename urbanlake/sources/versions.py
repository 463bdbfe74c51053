"""Named tables with versions: immutable data folders, a manifest for each version, one atomic pointer.

A table is a folder with ``_data/<unique>`` (Parquet) and ``_versions/<number>.json``.
A manifest names the folders that make a version, one for each part (the
values of a part expression, e.g. a day) or one for all; the version with the
highest number is the current one.  A commit writes its data aside, then puts its
manifest in place by a rename that fails if the number is taken, so there is
always a table, a failed job changes nothing, and of two writers one gets an
error.  Readers resolve a manifest once and stay on its version.  Folders that no
kept manifest names go with ``vacuum``.

The manifest is read by the driver; it has an entry for each part, not for each
row or file.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = "part_key"
#: Part of rows whose part expression is null, and of tables without parts.
NONE, WHOLE = "none", "all"


class ConcurrentCommit(RuntimeError):
    """Another writer committed the version that this one was about to."""


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    parts: dict[str, str]
    note: dict = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.json(), "parts": self.parts, "note": self.note})

    @classmethod
    def parse(cls, text: str) -> Manifest:
        j = json.loads(text)
        return cls(j["version"], T.StructType.fromJson(json.loads(j["schema"])), j["parts"], j["note"])


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = spark.sparkContext._jvm.org.apache.hadoop.fs

    # ------------------------------------------------------------- the store
    def _place(self, name: str):
        return self._fs.Path(f"{self.path}/{name}")

    def _store(self):
        return self._place("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place, store = self._place(folder), self._store()
        return [s.getPath().getName() for s in store.listStatus(place)] if store.exists(place) else []

    def _read_text(self, name: str) -> str:
        stream = self._store().open(self._place(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _put(self, manifest: Manifest) -> None:
        """The pointer's move: a complete manifest gets its number, or the number is taken."""
        store, aside = self._store(), self._place(f"_versions/.{uuid.uuid4().hex}")
        out = store.create(aside, False)
        try:
            out.write(bytearray(manifest.text().encode()))
        finally:
            out.close()
        gateway = self.spark.sparkContext._gateway
        rename = self._fs.Options.Rename
        how = gateway.new_array(rename, 1)
        how[0] = rename.NONE
        try:
            context = self._fs.FileContext.getFileContext(self._place("").toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
            context.rename(aside, self._place(f"_versions/{manifest.version:08d}.json"), how)
        except Exception as e:
            store.delete(aside, False)
            if "FileAlreadyExists" in str(e):
                raise ConcurrentCommit(f"version {manifest.version} of {self.path} was committed by another writer") from e
            raise

    # -------------------------------------------------------------- versions
    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_versions") if re.fullmatch(r"\d{8}\.json", n))

    def exists(self) -> bool:
        return bool(self.versions())

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The manifest of a version, by default the current one; None while there is none."""
        have = self.versions()
        if version is None:
            version = have[-1] if have else None
        elif version not in have:
            raise ValueError(f"{self.path} has no version {version}, only {have}")
        return None if version is None else Manifest.parse(self._read_text(f"_versions/{version:08d}.json"))

    def read(self, version: int | None = None, parts: list[str] | None = None) -> DataFrame:
        """The rows of a version (by default the current one), or of some of its parts, whatever is committed later."""
        m = self.manifest(version)
        if m is None:
            raise ValueError(f"there is no table at {self.path}")
        return self.read_manifest(m, parts)

    def read_manifest(self, m: Manifest, parts: list[str] | None = None) -> DataFrame:
        folders = sorted({f for p, f in m.parts.items() if parts is None or p in parts})
        if not folders:
            return self.spark.createDataFrame([], m.schema)
        return (self.spark.read.schema(m.schema).option("recursiveFileLookup", "true")
                .parquet(*[f"{self.path}/{f}" for f in folders]))

    def commit(self, rows: DataFrame, part: Column | None = None, replace: str = "all", gone: list[str] | None = None,
               note: dict | None = None, base: Manifest | None = None) -> Manifest:
        """Write ``rows`` and make them the next version.

        With ``replace="touched"`` only the parts that ``rows`` have (and those
        ``gone``) change, the others are taken over from ``base``, the
        version this one was worked out from (by default the current one).
        """
        base = base or self.manifest()
        if replace not in ("all", "touched"):
            raise ValueError("replace must be 'all' or 'touched'")
        if replace == "touched" and part is None:
            raise ValueError("parts are only replaced in a table that has parts")
        if replace == "touched" and base is not None and _types(base.schema) != _types(rows.schema):
            raise ValueError(f"columns differ from those of {self.path}: replace all of it")
        folder = f"_data/{uuid.uuid4().hex}"
        if part is None:
            rows.write.parquet(f"{self.path}/{folder}")
            written = {WHOLE: folder}
        else:
            key = F.coalesce(part.cast("string"), F.lit(NONE))
            rows.withColumn(PART, key).write.partitionBy(PART).parquet(f"{self.path}/{folder}")
            unescape = self.spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
            written = {unescape(n.split("=", 1)[1]): f"{folder}/{n}" for n in self._names(folder) if n.startswith(f"{PART}=")}
        kept = dict(base.parts) if replace == "touched" and base is not None else {}
        for p in gone or []:
            kept.pop(p, None)
        m = Manifest((base.version if base else 0) + 1, rows.schema, kept | written, note or {})
        self._put(m)
        return m

    # ------------------------------------------------------------- clearing
    def vacuum(self, keep: int = 2, min_age_s: float = 3600.0) -> list[str]:
        """Forget all but the last ``keep`` versions and delete folders that no kept one names.

        Folders younger than ``min_age_s`` stay: a writer may be about to commit them.
        """
        if keep < 1:
            raise ValueError("at least the current version is kept")
        have, store = self.versions(), self._store()
        named = {f.split("/")[1] for v in have[-keep:] for f in self.manifest(v).parts.values()}
        for v in have[:-keep]:
            store.delete(self._place(f"_versions/{v:08d}.json"), False)
        deleted = []
        for name in self._names("_data"):
            place = self._place(f"_data/{name}")
            if name not in named and time.time() - store.getFileStatus(place).getModificationTime() / 1000 >= min_age_s:
                store.delete(place, True)
                deleted.append(name)
        return deleted

    def drop(self, if_exists: bool = True) -> bool:
        """Remove the table: first its versions, so that no reader finds it half deleted, then its data."""
        if not self.exists():
            if not if_exists:
                raise ValueError(f"there is no table at {self.path}")
            return False
        self._store().delete(self._place("_versions"), True)
        self._store().delete(self._place(""), True)
        return True


def _types(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


class TableStore:
    """Versioned tables by name under one folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def table(self, name: str) -> VersionedTable:
        if not re.fullmatch(r"[A-Za-z][A-Za-z0-9_]*", name):
            raise ValueError(f"not a table name: {name!r}")
        return VersionedTable(self.spark, f"{self.base}/{name}")

    def save(self, name: str, rows: DataFrame, part: Column | None = None, note: dict | None = None) -> int:
        """Overwrite a table; its new version."""
        return self.table(name).commit(rows, part, note=note).version

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.table(name).read(version)

    def drop(self, name: str, if_exists: bool = True) -> bool:
        return self.table(name).drop(if_exists)

    def register(self, names: list[str]) -> None:
        """Session views of the tables' current versions, for ``spark.sql``."""
        for name in names:
            self.read(name).createOrReplaceTempView(name)


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a versioned table, or a plain Parquet folder."""
    table = VersionedTable(spark, path)
    return table.read() if table.exists() else spark.read.parquet(path)


def stored_version(spark: SparkSession, path: str) -> int | None:
    """The current version's number; None for a plain folder."""
    have = VersionedTable(spark, path).versions()
    return have[-1] if have else None
