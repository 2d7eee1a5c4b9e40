"""Components of texts whose word shingles are alike, for stages that dedup by content similarity.

A text is cut into words as in `op07_simhash` and is the set of its shingles' XXH64 (fewer words than `width`: the whole
sequence; none: the empty set). Texts are linked if the Jaccard similarity of their sets is at least `similarity`.

Rows are told apart by doc_id and a hash of the text, so rows that repeat a doc_id may be in different components. A null
doc_id names no component: such rows get the component of rows with the same set, else null.

Equal sets are collapsed first. Near copies meet as in `op07_simhash`: by SimHash fingerprints at most `RADIUS` bits apart, found
with its vantage-point trees. Four bits are a similarity of about 0.96, and a radius that reaches 0.8 (about 16 of 64 bits) leaves
the trees nothing to cut; so sets also meet through `BANDS` keys, each of `ROWS` of `HASHES` minimum hashes. Sets that fingerprints
or keys connect are a group, found from a star per key, never from pairs. All pairs of a group are compared by their
exact similarity: small groups are packed into tasks, others are cut into blocks, and two blocks are one task. A task
returns a spanning forest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.llm import op07_simhash
from boxloom.llm.common import Sink, packed, rows_of, store, unpacker
from boxloom.llm.components import Forest, components

RADIUS = 4
HASHES = 192
ROWS = 6
BANDS = 48
BLOCK = 512
TASK_SHINGLES = 250_000

_rng = np.random.default_rng(17)
_FACTORS = _rng.integers(0, 2**64, HASHES, dtype=np.uint64) | np.uint64(1)
_OFFSETS = _rng.integers(0, 2**64, HASHES, dtype=np.uint64)
_PICKS = np.array([_rng.permutation(HASHES)[:ROWS] for _ in range(BANDS)])
_MIX = _rng.integers(0, 2**64, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, width: int) -> np.ndarray:
    """The sorted different hashes of a text's shingles."""
    return np.unique(hashes(text, width))


def hashes(text: str | None, width: int) -> np.ndarray:
    """The hashes of a text's shingles, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, n = memoryview(b" ".join(words)), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts, last = np.r_[0, ends[:-1] + 1], min(width, n) - 1
    count = n - last
    return np.fromiter((xxh64_intdigest(joined[a:b], seed=42) for a, b in zip(starts[:count].tolist(), ends[last:].tolist(), strict=True)), np.uint64, count)


def band_keys(found: np.ndarray) -> np.ndarray:
    if not len(found):
        return np.empty(0, np.int64)
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        least = np.minimum(least, ((found[at : at + 2048] ^ _OFFSETS[:, None]) * _FACTORS[:, None]).min(axis=1))
    return (least[_PICKS] * _MIX).sum(axis=1, dtype=np.uint64).view(np.int64)


def _point(data: bytes) -> int:
    from xxhash import xxh64_intdigest

    return int(np.uint64(xxh64_intdigest(data, seed=7)).view(np.int64))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_hash (Spark's `xxhash64` of the text), point (hash of the set), n, fp (fingerprint), keys."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("text_hash", pa.int64()), ("point", pa.int64()), ("n", pa.int64()), ("fp", pa.int64()), ("keys", pa.list_(pa.int64()))]
    )

    def scan(batches):
        sink = Sink(schema)
        for key, text_hash, text in rows_of(batches, "doc_id", "text_hash", "text"):
            every = hashes(text, width)
            found = np.unique(every)
            fp = np.uint64(op07_simhash.fold(every[at : at + 50_000] for at in range(0, len(every), 50_000)))
            sink.add(key, text_hash, _point(found.tobytes()), len(found), int(fp.view(np.int64)), band_keys(found), weight=1 + BANDS)
            if sink.full():
                yield sink.take()
        yield sink.take()

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        scan, "doc_id long, text_hash long, point long, n long, fp long, keys array<long>"
    )


def _with_sets(docs: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """The members with their shingles, 8 bytes each; of repeated doc_ids the text with the member's set."""
    schema = pa.schema([("first", pa.int64()), ("point", pa.int64()), ("group", pa.int64()), ("members", pa.int64()), ("shingles", pa.binary())])

    def scan(batches):
        expand, sink = unpacker(), Sink(schema)
        for first, point, group, many, data in rows_of(batches, "first", "point", "group", "members", "packed"):
            found = shingles(expand(data).decode("utf-8", "surrogatepass"), width).tobytes()
            if _point(found) == point:
                sink.add(first, point, group, many, found, weight=1 + len(found) // 8)
            if sink.full():
                yield sink.take()
        yield sink.take()

    held = packed(docs).join(members, F.col("doc_id") == F.col("first")).select("first", "point", "group", "members", "packed")
    return held.mapInArrow(scan, "first long, point long, group long, members long, shingles binary")


def link(held: list[np.ndarray], side: np.ndarray | None, ids: list[int], similarity: float, forest: Forest) -> None:
    """Link the alike pairs of a group, or of its two sides, that are not connected yet."""
    sizes = np.array([len(x) for x in held])
    codes = np.unique(np.concatenate(held), return_inverse=True)[1]
    starts = np.r_[0, np.cumsum(sizes)]
    mark, label = np.zeros(int(codes.max(initial=-1)) + 1, bool), np.arange(len(held))
    for a in range(len(held)):
        if side is not None and side[a]:
            continue
        other = label != label[a]
        other &= np.arange(len(held)) > a if side is None else side
        other &= (np.minimum(sizes, sizes[a]) >= similarity * np.maximum(sizes, sizes[a])) & (sizes > 0)
        rows = np.flatnonzero(other)
        if not len(rows):
            continue
        mine = codes[starts[a] : starts[a + 1]]
        mark[mine] = True
        ends = np.cumsum(sizes[rows])
        flat = np.arange(ends[-1]) + np.repeat(starts[rows] - (ends - sizes[rows]), sizes[rows])
        both = np.add.reduceat(mark[codes[flat]].astype(np.int64), ends - sizes[rows])
        mark[mine] = False
        for b in rows[both / (sizes[a] + sizes[rows] - both) >= similarity].tolist():
            if label[b] != label[a]:
                label[label == label[b]] = label[a]
                forest.union(ids[a], ids[b])


def similar(docs: DataFrame, width: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, text_hash, component_id (the smallest doc_id reachable) of every row."""
    held = store(sketches(docs, width), "sketches")
    points = store(held.groupBy("point").agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.min("fp").alias("fp"), F.first("keys").alias("keys")), "points")
    prints = store(points.groupBy("fp").agg(F.min("point").alias("first")), "prints")
    near = points.join(store(op07_simhash.classes(prints, RADIUS), "near"), "fp").select("point", F.xxhash64(F.lit("fp"), "component_id").alias("key"))
    keys = points.select("point", F.explode("keys").alias("key")).unionByName(near)
    heads = keys.groupBy("key").agg(F.min("point").alias("head"), F.count("*").alias("n")).where("n > 1").select("key", "head")
    groups = store(components(keys.join(store(heads, "heads"), "key").where("point <> head").select(F.col("point").alias("a"), F.col("head").alias("b"))), "groups")
    sizes = store(groups.groupBy("component").agg(F.count("*").alias("members")), "sizes")
    chosen = points.join(groups.join(sizes, "component"), F.col("point") == F.col("node"))
    chosen = store(chosen.select("first", "point", "n", F.col("component").alias("group"), "members"), "chosen")
    tasks = 1 + (chosen.where(F.col("members") <= BLOCK).agg(F.sum("n")).first()[0] or 0) // TASK_SHINGLES
    members = store(_with_sets(docs, chosen.drop("n"), width), "members")
    few = members.where(F.col("members") <= BLOCK).select(
        F.pmod(F.xxhash64("group"), F.lit(tasks)).alias("task"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), "group", F.lit(False).alias("side"), "first", "shingles"
    )
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    many = members.where(F.col("members") > BLOCK).withColumn("block", F.pmod(F.xxhash64("point"), blocks).cast("int"))
    many = many.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        F.col("group").alias("task"), F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "group", (F.col("block") > F.col("with")).alias("side"), "first", "shingles"
    )

    def connect(table: pa.Table) -> pa.Table:
        forest, by_group = Forest(), {}
        group, side, ids = table["group"].to_numpy(), table["side"].to_numpy(), table["first"].to_pylist()
        for at, g in enumerate(group.tolist()):
            by_group.setdefault(g, []).append(at)
        column, whole = table["shingles"], table["i"][0].as_py() == table["j"][0].as_py()
        for rows in by_group.values():
            link([np.frombuffer(column[r].as_py(), np.uint64) for r in rows], None if whole else side[rows], [ids[r] for r in rows], similarity, forest)
        a, b = forest.edges()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    edges = few.unionByName(many).groupBy("task", "i", "j").applyInArrow(connect, "a long, b long")
    labels = components(edges)
    classes = points.join(labels, points["first"] == labels["node"], "left").select("point", F.coalesce("component", "first").alias("component_id"))
    return held.select("doc_id", "text_hash", "point").join(store(classes, "classes"), "point").select("doc_id", "text_hash", "component_id")
