"""SimHash near-dedup with vantage-point trees over Hamming distance.

A text is put in lower case (A-Z), cut into words and into shingles of `width` consecutive words (fewer words: the
whole sequence; none: fingerprint zero). A fingerprint bit is 1 if it is set in over half of the shingles' XXH64
(seed 42). Fingerprints with at most `radius` differing bits are linked; components are the closure.

Equal fingerprints are collapsed first, so copies of any number are one point. Points are dealt into shards by blocks of
bits: of `radius` + 1 blocks two points within `radius` have one in common at least (of more blocks, several), so
with a copy of each point for every choice of blocks each pair meets in one shard. That number of copies is fixed by the
radius and the number of points (5, from 8 million points on 15), where cuts by distance overlap more the deeper they go. A shard is
searched by a vantage-point tree: a point goes to the inner side if its distance to the vantage
point is at most r + radius, and to the outer side if it is more than r. By the triangle inequality each
pair within `radius` shares a side, at every level. Splitting goes on down to small leaves, which are compared exactly; a leaf that
no vantage point splits (a tight cloud of near copies) is covered by balls of half the radius, whose members are
linked by the triangle inequality, and only balls of different components are compared. A shard returns a spanning
forest, never all pairs.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows are copies. Other columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import rows_of, store
from boxloom.llm.components import Forest, components

#: Points of a shard, by the mean: a tree over points without near ones costs in proportion to their square.
SHARD_POINTS = 2048
#: Copies of a point over all shards at most.
COPIES = 64
LEAF = 384


def fingerprint(text: str | None, width: int) -> int:
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = memoryview(b" ".join(words)), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if n <= width:
        return xxh64_intdigest(joined, seed=42)
    count = n - width + 1
    starts, ends = starts[:count].tolist(), ends[width - 1 :].tolist()
    pieces = (zip(starts[at : at + 50_000], ends[at : at + 50_000], strict=True) for at in range(0, count, 50_000))
    return fold(np.array([xxh64_intdigest(joined[a:b], seed=42) for a, b in piece], np.uint64) for piece in pieces)


def fold(parts: Iterable[np.ndarray]) -> int:
    """The fingerprint of hashes that come in parts; zero without any."""
    total, count = np.zeros(64, np.int64), 0
    for part in parts:
        total += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        count += len(part)
    return int.from_bytes(np.packbits(2 * total > count).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """doc_id, fp: the fingerprint as a signed 64-bit integer."""

    def scan(batches):
        for batch in batches:
            ids, prints = [], []
            for key, text in rows_of([batch], "doc_id", "text"):
                ids.append(key)
                prints.append(fingerprint(text, width))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.array(prints, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(scan, "doc_id long, fp long")


def _threshold(distances: np.ndarray, radius: int) -> tuple[int, float]:
    """The cut that makes the larger side smallest, and that side's share."""
    counts = np.bincount(distances, minlength=65)
    below = np.cumsum(counts)
    inner = below[np.minimum(np.arange(65) + radius, 64)]
    outer = below[-1] - below
    r = int(np.argmin(np.maximum(inner, outer)))
    return r, max(inner[r], outer[r]) / len(distances)


def _vantage(points: np.ndarray, radius: int, rng) -> tuple[np.uint64, int, float]:
    """Of a few points the one whose cut is best."""
    best = None
    for point in points[rng.integers(0, len(points), 4)]:
        r, share = _threshold(np.bitwise_count(points ^ point), radius)
        if best is None or share < best[2]:
            best = (point, r, share)
    return best


def layout(total: int, radius: int) -> tuple[int, int, int]:
    """How `total` points are dealt: number of blocks, blocks two points must share, bits looked at in each.

    Of `radius` + n blocks points within `radius` share n. More blocks are taken only where the shards of fewer would grow.
    """
    need, best = math.ceil(math.log2(max(1, total / SHARD_POINTS))), (1, 1, 0)
    for shared in range(1, 65 - radius):
        blocks = radius + shared
        if need <= best[1] * best[2] or math.comb(blocks, shared) > COPIES:
            break
        best = (blocks, shared, min(64 // blocks, math.ceil(need / shared)))
    return best


def shards(prints: np.ndarray, blocks: int, shared: int, bits: int) -> Iterator[np.ndarray]:
    """The shard of every point, once for each choice of blocks."""
    parts = [prints >> np.uint64(64 // blocks * b) & np.uint64((1 << bits) - 1) for b in range(blocks)]
    for number, chosen in enumerate(combinations(range(blocks), shared)):
        shard = np.full(len(prints), number, np.uint64)
        for b in chosen:
            shard = shard << np.uint64(bits) | parts[b]
        yield shard.view(np.int64)


def _link_leaf(points: np.ndarray, ids: np.ndarray, radius: int, forest: Forest) -> None:
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= radius
    linked = np.flatnonzero(near.sum(axis=1) > 1)
    if not len(linked):
        return
    near = near[np.ix_(linked, linked)]
    label = np.arange(len(linked))
    while True:
        lower = np.where(near, label[None, :], len(linked)).min(axis=1)
        if (lower == label).all():
            break
        label = lower
    for x, y in zip(ids[linked].tolist(), ids[linked[label]].tolist(), strict=True):
        if x != y:
            forest.union(x, y)


def _link_cloud(points: np.ndarray, ids: np.ndarray, radius: int, forest: Forest) -> None:
    left = np.arange(len(points))
    balls = []
    while len(left):
        d = np.bitwise_count(points[left] ^ points[left[0]])
        members = left[d <= radius // 2]
        balls.append(members)
        for x in ids[members[1:]].tolist():
            forest.union(x, int(ids[members[0]]))
        left = left[d > radius // 2]
    centres = points[[b[0] for b in balls]]
    for i, ball in enumerate(balls):
        d = np.bitwise_count(centres[i + 1 :] ^ centres[i])
        for j in (np.flatnonzero(d <= radius) + i + 1).tolist():
            forest.union(int(ids[ball[0]]), int(ids[balls[j][0]]))
    for i, ball in enumerate(balls):
        d = np.bitwise_count(centres[i + 1 :] ^ centres[i])
        for j in (np.flatnonzero((d > radius) & (d <= radius + 2 * (radius // 2))) + i + 1).tolist():
            other, me = balls[j], int(ids[ball[0]])
            if forest.find(me) == forest.find(int(ids[other[0]])):
                continue
            step = max(1, 4_000_000 // len(other))
            if any((np.bitwise_count(points[ball[at : at + step], None] ^ points[None, other]) <= radius).any() for at in range(0, len(ball), step)):
                forest.union(me, int(ids[other[0]]))


def link(points: np.ndarray, ids: np.ndarray, radius: int) -> Forest:
    """Spanning forest of the links among different points, by a vantage-point tree."""
    forest, rng, todo = Forest(), np.random.default_rng(5), [(points, ids)]
    while todo:
        points, ids = todo.pop()
        if len(points) <= LEAF:
            _link_leaf(points, ids, radius, forest)
            continue
        vantage, r, share = _vantage(points, radius, rng)
        if share > 0.9:
            _link_cloud(points, ids, radius, forest)
            continue
        d = np.bitwise_count(points ^ vantage)
        todo += [(points[m], ids[m]) for m in (d <= r + radius, d > r)]
    return forest


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable)."""
    prints = store(fingerprints(docs, width), "fingerprints")
    points = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "points")
    return prints.join(store(classes(points, radius), "classes"), "fp").select("doc_id", "fp", "component_id")


def classes(points: DataFrame, radius: int = 4) -> DataFrame:
    """fp, component_id (the smallest `first` reachable) of points (fp, first: long; stored, each fp once)."""
    dealt = layout(points.count(), radius)

    def route(batches):
        for batch in batches:
            for shard in shards(np.asarray(batch.column(0)).view(np.uint64), *dealt):
                yield pa.RecordBatch.from_arrays([pa.array(shard), batch.column(0), batch.column(1)], names=["shard", "fp", "first"])

    def connect(table: pa.Table) -> pa.Table:
        a, b = link(table["fp"].to_numpy().view(np.uint64), table["first"].to_numpy(), radius).edges()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    edges = points.select("fp", "first").mapInArrow(route, "shard long, fp long, first long").groupBy("shard").applyInArrow(connect, "a long, b long")
    labels = components(edges)
    return points.join(labels, points["first"] == labels["node"], "left").select("fp", F.coalesce("component", "first").alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
