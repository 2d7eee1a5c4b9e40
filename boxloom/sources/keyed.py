"""A keyed store that is rewritten bucket by bucket: a write replaces the buckets it touches and commits by one small file.

Rows are dealt to a fixed number of buckets by their key's hash. A version's commit file names the folder that holds each
bucket; a write puts new folders beside the old ones and then creates the next commit file, which fails if another
writer was first. Readers follow the newest commit file, so a write that dies before it changes nothing.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"


class Conflict(RuntimeError):
    """Another write committed first; read again and repeat."""


@dataclass(frozen=True)
class Version:
    """Number (0: empty store), number of buckets, folder of each bucket that has rows, and the schema as JSON."""

    number: int
    buckets: int
    folders: dict[int, str]
    schema: str | None


class KeyedStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 256, key: str = "sample_id"):
        self.spark, self.path, self.buckets, self.key = spark, path.rstrip("/"), buckets, key

    def _system(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{COMMITS}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def version(self) -> Version:
        """The newest committed version."""
        system, path_of = self._system()
        folder = path_of(f"{self.path}/{COMMITS}")
        names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
        numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
        if not numbers:
            return Version(0, self.buckets, {}, None)
        newest = f"{self.path}/{COMMITS}/{max(numbers):020d}.json"
        text = "\n".join(r.value for r in self.spark.read.text(newest, wholetext=True).collect())  # one entry per bucket
        held = json.loads(text)
        return Version(max(numbers), held["buckets"], {int(b): f for b, f in held["folders"].items()}, held["schema"])

    def bucket(self, buckets: int):
        return F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int")

    def _rows(self, version: Version, only: list[int] | None = None) -> DataFrame | None:
        folders = [f"{self.path}/{f}" for b, f in sorted(version.folders.items()) if only is None or b in only]
        if not folders:
            return None
        from pyspark.sql.types import StructType

        return self.spark.read.schema(StructType.fromJson(json.loads(version.schema))).parquet(*folders)

    def read(self) -> DataFrame:
        """The rows of the newest version; an empty store has no columns yet and raises."""
        version = self.version()
        rows = self._rows(version)
        if rows is None:
            if version.schema is None:
                raise ValueError(f"nothing was written to {self.path}")
            from pyspark.sql.types import StructType

            return self.spark.createDataFrame([], StructType.fromJson(json.loads(version.schema)))
        return rows

    def write(self, rows: DataFrame, removed: DataFrame | None = None) -> Version:
        """Put in `rows` (one per key; they replace the key's old row) and take out the keys of `removed`; commits or raises.

        Only buckets with a written or removed key are read and written. Rows must have the store's columns and a key.
        """
        before = self.version()
        rows = rows.withColumn("_bucket", self.bucket(before.buckets))
        out = None if removed is None else removed.select(self.key).withColumn("_bucket", self.bucket(before.buckets))
        both = rows.select(self.key, "_bucket") if out is None else rows.select(self.key, "_bucket").unionByName(out.select(self.key, "_bucket"))
        counted = both.groupBy("_bucket").agg(F.count_if(F.col(self.key).isNull()).alias("n_null")).collect()  # at most `buckets` rows
        if any(r.n_null for r in counted):
            raise ValueError(f"rows without {self.key} cannot be stored")
        touched = sorted(r["_bucket"] for r in counted)
        names = [c for c in rows.columns if c != "_bucket"]
        schema = rows.select(names).schema
        if before.schema is not None:
            held = json.loads(before.schema)
            if sorted((f["name"], str(f["type"])) for f in held["fields"]) != sorted((f["name"], str(f["type"])) for f in json.loads(schema.json())["fields"]):
                raise ValueError("rows have other columns than the store")
        old = self._rows(before, touched)
        after = rows
        if old is not None:
            gone = both.select(self.key).distinct()
            kept = old.join(gone, self.key, "left_anti").withColumn("_bucket", self.bucket(before.buckets))
            after = kept.unionByName(rows)
        if not touched:
            return before
        folder = f"v{before.number + 1:08d}-{uuid.uuid4().hex}"
        parts = min(len(touched), 10_000)
        after.repartition(parts, "_bucket").sortWithinPartitions("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
        return self._commit(before, folder, touched, schema.json())

    def _commit(self, before: Version, folder: str, touched: list[int], schema: str) -> Version:
        system, path_of = self._system()
        written = {int(s.getPath().getName().split("=")[1]) for s in system.listStatus(path_of(f"{self.path}/{folder}")) if s.getPath().getName().startswith("_bucket=")}
        folders = {b: f for b, f in before.folders.items() if b not in touched}
        folders |= {b: posixpath.join(folder, f"_bucket={b}") for b in touched if b in written}
        after = Version(before.number + 1, before.buckets, folders, before.schema or schema)
        text = json.dumps({"buckets": after.buckets, "folders": {str(b): f for b, f in sorted(folders.items())}, "schema": after.schema})
        # a finished file appears under the version's name at once, and only if there is none yet
        own = path_of(f"{self.path}/{COMMITS}/.{uuid.uuid4().hex}")
        out = system.create(own, False)
        out.write(bytearray(text.encode()))
        out.close()
        name = path_of(f"{self.path}/{COMMITS}/{after.number:020d}.json")
        if system.exists(name) or not system.rename(own, name):
            system.delete(own, False)
            raise Conflict(f"version {after.number} of {self.path} was written by another")
        return after

    def vacuum(self) -> int:
        """Remove folders that the newest version does not use; readers of older versions must be done. Returns how many."""
        version, n = self.version(), 0
        system, path_of = self._system()
        used = set(version.folders.values())
        for top in system.listStatus(path_of(self.path)):
            name = top.getPath().getName()
            if not name.startswith("v"):
                continue
            parts = [s.getPath().getName() for s in system.listStatus(top.getPath()) if s.getPath().getName().startswith("_bucket=")]
            for part in parts:
                if f"{name}/{part}" not in used:
                    system.delete(path_of(f"{self.path}/{name}/{part}"), True)
                    n += 1
        return n
