"""Line dedup: sharded cuckoo filters backed by exact reference counts, with insertion and deletion.

A text is split at line feeds; a line's key is the line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z in
lower case. Keys of at least `min_chars` code points that at least `min_docs` documents hold lose all their lines
except in the largest doc_id that holds them.

State is a `LineIndex` in the shared folder, of three tables that a batch rewrites only where it touches them:
references (which document holds which key, dealt by document), exact counts (n_docs and last_doc of every key, dealt by
key) and a cuckoo filter for each shard of keys over those that reach `min_docs`. `update` puts documents in and takes
others out, so every step can be reversed: keys that reach `min_docs` are inserted into their shard's filter, keys that
fall below are deleted from it. A filter without room is rebuilt from its shard's counts. References pass their shard's
filter first, only those that pass meet the exact counts, so a false positive costs a row and changes nothing. A
shard's references are split over salts, so a line that a third of all documents hold is never gathered in one task.
An update that dies half way leaves a mark; the next one then rebuilds counts and filters from the references.

Null or empty text: one empty line. Rows that repeat a doc_id are one document, and all of them keep or lose a line
alike; rows with a null doc_id are together one document, which loses nothing. Putting in a doc_id that is held
replaces it. Other columns are ignored. An empty table gives an empty result. Keys are told apart by 128-bit digests.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from boxloom.llm.common import Sink, packed, rows_of, shared_dir, store, unpacker
from boxloom.sources.keyed import KeyedStore

KEYS_PER_SHARD = 200_000
#: Shards are folders; beyond this many they grow, and only filters and counts of a shard with them, not tasks that probe.
MOST_SHARDS = 20_000
REFERENCES_PER_TASK = 400_000


class CuckooFilter:
    """Buckets of four 16-bit fingerprints (0: free) over 64-bit hashes; exact deletions of what was inserted."""

    SLOTS = 4

    def __init__(self, capacity: int):
        size = 1
        while size * self.SLOTS * 0.85 < capacity:
            size *= 2
        self.table = np.zeros((size, self.SLOTS), np.uint16)
        self.stash: list[int] = []  # hashes for which no free slot was found

    def _places(self, hashes: np.ndarray):
        mask = np.uint64(len(self.table) - 1)
        mark = ((hashes >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        first = (hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & mask
        return mark, first.astype(np.int64), self._other(first, mark)

    def _other(self, place, mark):
        mask = np.uint64(len(self.table) - 1)
        return ((np.asarray(place, np.uint64) ^ (np.asarray(mark, np.uint64) * np.uint64(0x5BD1E995))) & mask).astype(np.int64)

    def insert(self, hashes: np.ndarray) -> None:
        marks, first, second = self._places(hashes)
        table = self.table
        for h, mark, a, b in zip(hashes.tolist(), marks.tolist(), first.tolist(), second.tolist(), strict=True):
            for place in (a, b):
                free = np.flatnonzero(table[place] == 0)
                if len(free):
                    table[place, free[0]] = mark
                    break
            else:
                # move others on; if that fails, undo it and remember the hash itself
                place, moved, path = b, mark, []
                for step in range(200):
                    slot = (h + step) % self.SLOTS
                    path.append((place, slot, int(table[place, slot])))
                    table[place, slot], moved = moved, int(table[place, slot])
                    place = int(self._other(place, moved))
                    free = np.flatnonzero(table[place] == 0)
                    if len(free):
                        table[place, free[0]] = moved
                        break
                else:
                    for place, slot, was in reversed(path):
                        table[place, slot] = was
                    self.stash.append(h)

    def delete(self, hashes: np.ndarray) -> None:
        marks, first, second = self._places(hashes)
        for h, mark, a, b in zip(hashes.tolist(), marks.tolist(), first.tolist(), second.tolist(), strict=True):
            if h in self.stash:
                self.stash.remove(h)
                continue
            for place in (a, b):
                held = np.flatnonzero(self.table[place] == mark)
                if len(held):
                    self.table[place, held[0]] = 0
                    break

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        marks, first, second = self._places(hashes)
        found = (self.table[first] == marks[:, None]).any(axis=1) | (self.table[second] == marks[:, None]).any(axis=1)
        return found | np.isin(hashes, np.array(self.stash, np.uint64)) if self.stash else found

    def dump(self) -> bytes:
        return np.uint64(len(self.stash)).tobytes() + np.array(self.stash, np.uint64).tobytes() + self.table.tobytes()

    @classmethod
    def load(cls, data: bytes) -> CuckooFilter:
        self, n = cls(1), int(np.frombuffer(data, np.uint64, 1)[0])
        self.stash = np.frombuffer(data, np.uint64, n, 8).tolist()
        self.table = np.frombuffer(data, np.uint16, -1, 8 + 8 * n).reshape(-1, cls.SLOTS).copy()
        return self


def _key(line: bytes, min_chars: int) -> bytes | None:
    """The digest of a line's key, None if the key is too short."""
    from xxhash import xxh3_128_digest

    key = line.strip().lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxh3_128_digest(key)


REFERENCES = "owner string, key binary, doc_id long"
COUNTS = "key binary, n_docs long, last_doc long"
FILTERS = "shard int, n_held long, capacity long, filter binary"


def _owner(doc_id: str = "doc_id"):
    return F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("null")).alias("owner")


def references(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """owner, key, doc_id: which document holds which key, once each."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64())])

    def scan(batches):
        out = Sink(schema, 100_000)
        for doc_id, text in rows_of(batches, "doc_id", "text"):
            keys = {_key(line, min_chars) for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")}
            for key in keys - {None}:
                out.add(key, doc_id)
            if out.full():
                yield out.take()
        yield out.take()

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = chosen.mapInArrow(scan, "key binary, doc_id long").select(_owner(), "key", "doc_id")
    return found.repartition("owner").dropDuplicates(["owner", "key"])


def _counts(refs: DataFrame) -> DataFrame:
    return refs.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))


def _hash64(keys: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(keys.to_pylist()), np.uint64)[::2].copy()


def _filter_rows(shard: int, n_held: int, capacity: int, made: CuckooFilter | None) -> pa.Table:
    kinds = {"shard": pa.int32(), "n_held": pa.int64(), "capacity": pa.int64(), "filter": pa.binary()}
    values = (shard, n_held, capacity, None if made is None else made.dump())
    return pa.table({name: pa.array([value], kind) for (name, kind), value in zip(kinds.items(), values, strict=True)})


def filters(keys: DataFrame) -> DataFrame:
    """A cuckoo filter over the keys (shard, key) of each shard, with room for half as many more."""

    def build(table: pa.Table) -> pa.Table:
        hashes = _hash64(table["key"])
        capacity = max(64, len(hashes) * 3 // 2)
        made = CuckooFilter(capacity)
        made.insert(hashes)
        return _filter_rows(table["shard"][0].as_py(), len(hashes), capacity, made)

    return keys.select("shard", "key").groupBy("shard").applyInArrow(build, FILTERS)


def _changed_filters(held: DataFrame, changes: DataFrame) -> DataFrame:
    """The filters of all shards with `changes` (shard, key, now); null where there is no room."""

    def change(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return _filter_rows(0, 0, 0, None).slice(0, 0)
        shard, now = right["shard"][0].as_py(), right["now"].to_numpy(zero_copy_only=False).astype(bool)
        hashes = _hash64(right["key"])
        n_held = (left["n_held"][0].as_py() if left.num_rows else 0) + int(now.sum()) - int((~now).sum())
        if not left.num_rows or n_held > left["capacity"][0].as_py():
            return _filter_rows(shard, n_held, 0, None)
        made = CuckooFilter.load(left["filter"][0].as_py())
        made.delete(hashes[~now])
        made.insert(hashes[now])
        return _filter_rows(shard, n_held, left["capacity"][0].as_py(), made)

    return held.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(change, FILTERS)


class LineIndex:
    """References, counts and filters of the lines of documents under `path`, a folder all executors share.

    `shards` is fixed with the first update; a shard's filter is one value, so choose about one for 200,000 keys.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int = 256, min_docs: int = 3, min_chars: int = 20):
        self.spark, self.path, self.shards, self.min_docs, self.min_chars = spark, path.rstrip("/"), shards, min_docs, min_chars
        self.stores = {
            "references": (KeyedStore(spark, f"{self.path}/references", shards, "owner"), REFERENCES),
            "counts": (KeyedStore(spark, f"{self.path}/counts", shards, "key"), COUNTS),
            "filters": (KeyedStore(spark, f"{self.path}/filters", shards, "shard"), FILTERS),
        }

    def read(self, name: str) -> DataFrame:
        """The newest `references`, `counts` or `filters`."""
        kept, schema = self.stores[name]
        names = [part.split()[0] for part in schema.split(", ")]
        return (kept.read() if kept.version().number else self.spark.createDataFrame([], schema)).select(names)

    def _shard(self):
        return F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int").alias("shard")

    def _mark(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_updating")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def insert(self, docs: DataFrame) -> None:
        """Put in the documents of `docs`."""
        self.update(store(references(docs, self.min_chars), "references"), docs.select(_owner()).distinct())

    def delete(self, doc_ids: DataFrame) -> None:
        """Take out the documents of `doc_ids`; those that are not held change nothing."""
        self.update(None, doc_ids.select(_owner()).distinct())

    def update(self, came: DataFrame | None, owners: DataFrame) -> None:
        """Replace the references of `owners` by those of `came`, a stored table; only touched shards are written."""
        system, mark = self._mark()
        if system.exists(mark):
            self.repair()
        before = self.read("references")
        empty = self.spark.createDataFrame([], REFERENCES)
        came = empty if came is None else came
        fresh = self.stores["references"][0].version().number == 0
        gone = empty if fresh else store(before.join(owners.hint("merge"), "owner", "left_semi"), "gone")
        signed = came.withColumn("sign", F.lit(1)).unionByName(gone.withColumn("sign", F.lit(-1)))
        delta = signed.groupBy("key").agg(
            F.sum("sign").alias("more"),
            F.max(F.when(F.col("sign") > 0, F.col("doc_id"))).alias("newest"),
            F.max(F.when(F.col("sign") < 0, F.col("doc_id"))).alias("leaving"),
        )
        old = self.read("counts").withColumnsRenamed({"n_docs": "n_old", "last_doc": "last_old"})
        now = F.coalesce("n_old", F.lit(0)) + F.col("more")
        joined = delta.join(old.hint("merge"), "key", "left").select(
            "key",
            now.alias("n_docs"),
            F.greatest("last_old", "newest").alias("last_doc"),
            (F.col("leaving") == F.col("last_old")).alias("lost"),
            (F.coalesce("n_old", F.lit(0)) >= self.min_docs).alias("was"),
            (now >= self.min_docs).alias("now"),
        )
        changed = store(joined, "changed")
        system.create(mark, True).close()
        self.stores["references"][0].write(came, None if fresh else gone.select("owner").distinct())
        lost = changed.where("lost AND n_docs > 0").select("key")
        if not fresh and lost.take(1):
            # the largest holder of these keys went out: find the next one
            again = self.read("references").join(lost.hint("merge"), "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("next"))
            known = changed.join(again.hint("merge"), "key", "left").withColumn("last_doc", F.when(F.col("lost"), F.col("next")).otherwise(F.col("last_doc")))
        else:
            known = changed
        counts = known.where("n_docs > 0").select("key", "n_docs", "last_doc")
        self.stores["counts"][0].write(counts, None if fresh else changed.where("n_docs = 0").select("key"))
        changes = changed.where("was <> now").select(self._shard(), "key", "now")
        made = store(_changed_filters(self.read("filters"), changes), "filters")
        full = made.where("filter IS NULL").select("shard")
        built = filters(self.often().select(self._shard(), "key").join(full.hint("merge"), "shard", "left_semi"))
        after = store(made.where("filter IS NOT NULL").unionByName(built), "filters")
        self.stores["filters"][0].write(after)
        system.delete(mark, False)

    def repair(self) -> None:
        """Build counts and filters from the references anew."""
        counts = store(_counts(self.read("references")), "counts")
        out = self.read("counts").join(counts.hint("merge"), "key", "left_anti").select("key")
        self.stores["counts"][0].write(counts, store(out, "out"))
        built = store(filters(self.often().select(self._shard(), "key")), "filters")
        self.stores["filters"][0].write(built, store(self.read("filters").select("shard"), "out"))
        system, mark = self._mark()
        system.delete(mark, False)

    def often(self) -> DataFrame:
        """key, n_docs, last_doc of the keys held often enough."""
        return self.read("counts").where(F.col("n_docs") >= self.min_docs)

    def droppable(self) -> DataFrame:
        """doc_id, keys: per document the keys whose lines it loses."""
        routed = self.read("references").select("key", "doc_id", self._shard())
        largest = routed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
        salts = max(1, -(-largest // REFERENCES_PER_TASK))
        salted = routed.withColumn("salt", F.pmod(F.xxhash64("doc_id", "key"), F.lit(salts)).cast("int"))
        spread = self.read("filters").select("shard", "filter").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

        def probe(left: pa.Table, right: pa.Table) -> pa.Table:
            rows = right.select(["key", "doc_id"]).combine_chunks()
            if not left.num_rows or not rows.num_rows:
                return rows.slice(0, 0)
            hit = CuckooFilter.load(left["filter"][0].as_py()).contains(_hash64(rows["key"]))
            return rows.filter(pa.array(hit))

        passed = spread.groupBy("shard", "salt").cogroup(salted.groupBy("shard", "salt")).applyInArrow(probe, "key binary, doc_id long")
        return passed.join(self.often(), "key").where("doc_id < last_doc").groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def index_of(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> LineIndex:
    """A new index over all documents of `docs`."""
    spark = docs.sparkSession
    refs = store(references(docs, min_chars), "references")
    index = LineIndex(spark, f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}", min(MOST_SHARDS, max(1, -(-refs.count() // KEYS_PER_SHARD))), min_docs, min_chars)
    index.update(refs, refs.select("owner"))
    return index


def drop_repeated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20, also: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (the lines that stay, joined by line feeds), and the columns of `also`."""
    index = index_of(docs, min_docs, min_chars)
    texts = packed(docs, also)
    long, names = LongType(), ["doc_id", "n_lines", "n_dropped", "kept", *also]
    schema = StructType(
        [StructField("doc_id", long), StructField("n_lines", long), StructField("n_dropped", long), StructField("kept", StringType()), *(texts.schema[c] for c in also)]
    )

    def keep(batches):
        expand = unpacker()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                n_lines, n_dropped, kept = [], [], []
                for data, keys in zip(batch.column("packed"), batch.column("keys").to_pylist(), strict=True):
                    lines = left = expand(data.as_py()).split(b"\n")
                    if keys:
                        gone = set(keys)
                        left = [line for line in lines if _key(line, min_chars) not in gone]
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(left))
                    kept.append(b"\n".join(left).decode("utf-8", "replace"))
                columns = [batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in also)], names=names)

    gone = store(index.droppable(), "droppable")
    return texts.join(gone.hint("merge"), "doc_id", "left").mapInArrow(keep, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_repeated_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH lines AS (
 SELECT doc_id, place, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
 FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), often AS (
 SELECT key, max(doc_id) AS last_doc FROM lines WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
 SELECT l.doc_id, l.place, l.line, o.key IS NOT NULL AND l.doc_id < o.last_doc AS gone FROM lines l LEFT JOIN often o ON l.key = o.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
