"""Tables that are merged into copy-on-write: only the buckets that incoming rows touch are written anew."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import delete_path, materialize
from .upsert import merged_rows, upsert_edges, upsert_nodes

_BUCKET = "_bucket"
_VERSION = re.compile(r"(\d{10})\.json$")


class VersionConflict(RuntimeError):
    """Another writer has made this version in the meantime; nothing was changed."""


class VersionedTable:
    """A Parquet table in hash buckets of its key, with a manifest for each version.

    ``<path>/data/<write>/_bucket=<n>/`` holds the files, which are never changed; ``<path>/versions/<number>.json`` lists the files of every
    bucket in that version, with the schema. A version exists from the moment its manifest does, and that is created in one step
    that fails if it is there already. So a write that fails, or loses against another one, leaves the old version as it was, and
    readers keep the files they have begun to read. ``buckets`` should give buckets of some hundred MB. The driver holds the list of
    files, as it does for any scan.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        found = self._versions()
        if not found:
            raise FileNotFoundError(f"no version of a table at {path}")
        self.version = found[-1]
        self.manifest = json.loads(self._read(self._name(self.version)))

    @classmethod
    def create(cls, df: DataFrame, path: str, key: tuple[str, ...], buckets: int, files_per_bucket: int = 1) -> VersionedTable:
        """Write the first version. Rows without a key are left out, as merges leave them out."""
        table = cls.__new__(cls)
        table.spark, table.path, table.version = df.sparkSession, path.rstrip("/"), 0
        table.manifest = {"key": list(key), "buckets": buckets, "files_per_bucket": files_per_bucket, "files": {}}
        if table._versions():
            raise VersionConflict(f"there is a table at {path}")
        table._commit(df.dropna(subset=list(key)), {})
        return table

    @property
    def schema(self) -> StructType:
        return StructType.fromJson(self.manifest["schema"])

    def bucket_of(self) -> Column:
        """The bucket of a row; keys are hashed as text, so that it does not depend on their types."""
        key = F.xxhash64(*[F.col(name).cast("string") for name in self.manifest["key"]])
        return F.pmod(key, F.lit(self.manifest["buckets"])).cast("int")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows of this version, or those of some of its buckets."""
        chosen = self.manifest["files"] if buckets is None else {str(b): self.manifest["files"].get(str(b), []) for b in buckets}
        files = [f"{self.path}/{name}" for names in chosen.values() for name in names]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def merge(self, incoming: DataFrame, merged: Callable[[DataFrame, DataFrame], DataFrame]) -> VersionedTable:
        """The next version: ``merged(current, incoming)`` of the buckets that have incoming rows, all others as they are.

        ``merged`` must decide key by key. The incoming rows are written first, since they are read for their buckets and for
        the merge. Columns that it adds are null in the buckets that stay.
        """
        rows = materialize(incoming.dropna(subset=self.manifest["key"]), "incoming")
        touched = sorted(r[0] for r in rows.select(self.bucket_of()).distinct().collect())
        if not touched:
            return self
        new = VersionedTable.__new__(VersionedTable)
        new.spark, new.path, new.version = self.spark, self.path, self.version
        new.manifest = {**self.manifest, "files": {b: f for b, f in self.manifest["files"].items() if int(b) not in touched}}
        new._commit(merged(self.read(touched), rows), self.manifest)
        return new

    def vacuum(self) -> int:
        """Delete older versions and the files that this one does not list; the number of data folders deleted.

        Not while others read an older version or write a new one.
        """
        used = {name.split("/")[1] for names in self.manifest["files"].values() for name in names}
        gone = [name for name in self._list(f"{self.path}/data") if name not in used]
        for name in gone:
            delete_path(self.spark, f"{self.path}/data/{name}")
        for version in self._versions():
            if version < self.version:
                delete_path(self.spark, self._name(version))
        return len(gone)

    def _commit(self, rows: DataFrame, before: dict) -> None:
        write = f"data/{uuid.uuid4().hex}"
        count = self.manifest["files_per_bucket"]
        part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(count))
        placed = rows.withColumn(_BUCKET, self.bucket_of())
        placed.repartition(F.col(_BUCKET), part).write.partitionBy(_BUCKET).parquet(f"{self.path}/{write}")
        files = {b: list(names) for b, names in self.manifest["files"].items()}
        for bucket in self._list(f"{self.path}/{write}"):
            if bucket.startswith(f"{_BUCKET}="):
                names = [n for n in self._list(f"{self.path}/{write}/{bucket}") if not n.startswith(("_", "."))]
                files[bucket.split("=")[1]] = [f"{write}/{bucket}/{n}" for n in names]
        schema = rows.schema.jsonValue()
        lacking = [f for f in before.get("schema", {}).get("fields", []) if f["name"] not in rows.columns]
        schema["fields"] = [*schema["fields"], *lacking]
        manifest = {**self.manifest, "files": files, "schema": schema}
        self._create(self._name(self.version + 1), json.dumps(manifest))
        self.manifest, self.version = manifest, self.version + 1

    def _name(self, version: int) -> str:
        return f"{self.path}/versions/{version:010d}.json"

    def _file(self, path: str):
        jvm = self.spark.sparkContext._jvm
        file = jvm.org.apache.hadoop.fs.Path(path)
        return file, file.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _list(self, path: str) -> list[str]:
        file, system = self._file(path)
        return [s.getPath().getName() for s in system.listStatus(file)] if system.exists(file) else []

    def _versions(self) -> list[int]:
        return sorted(int(m[1]) for name in self._list(f"{self.path}/versions") if (m := _VERSION.match(name)))

    def _read(self, path: str) -> str:
        file, system = self._file(path)
        stream = system.open(file)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _create(self, path: str, text: str) -> None:
        """A file that comes into being whole: written under another name and renamed, which fails if it is there."""
        draft, system = self._file(f"{self.path}/versions/.{uuid.uuid4().hex}")
        stream = system.create(draft)
        stream.write(bytearray(text.encode()))
        stream.close()
        target, _ = self._file(path)
        if system.exists(target) or not system.rename(draft, target):
            system.delete(draft, False)
            raise VersionConflict(f"{path} exists")


def merge_nodes(table: VersionedTable, incoming: DataFrame, version: str | None = None) -> VersionedTable:
    """:func:`upsert_nodes` into a versioned table of nodes."""
    (key,) = table.manifest["key"]
    return table.merge(incoming, lambda current, rows: upsert_nodes(current, rows, key, version))


def merge_edges(
    table: VersionedTable, incoming: DataFrame, sources: DataFrame, targets: DataFrame, identity: tuple[str, ...] = ()
) -> VersionedTable:
    """:func:`upsert_edges` into a versioned table of edges with the key (src, dst). Endpoints are looked up for incoming rows only."""
    rows = merged_rows(incoming, identity)
    return table.merge(rows, lambda current, fresh: upsert_edges(current, fresh, sources, targets, identity))
