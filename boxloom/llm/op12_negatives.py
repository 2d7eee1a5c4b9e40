"""Hard-negative mining by threshold joins over inverted lists, as all-pairs similarity joins do it.

Rows are dealt to shards, every anchor asks every shard, and a task holds one shard and a wave of anchors. A shard lists
its rows by dimension, most energetic dimensions first. At a threshold of `theta` times the anchor's norm a row's last
dimensions whose norm is under `theta` stay out of the lists: what they add cannot reach the threshold alone. Partial scores
are accumulated list by list; a pair goes when its partial score and the product of what remains of both norms cannot
reach the threshold; pairs that are left get their whole inner product. The threshold is lowered until an
anchor's windows are full or end above it, at last to none at all, so nothing is missed.

There are two joins. The first finds `positives` rows of the anchor's label per shard, of which the best of all shards stay.
The second finds, for each of their scores p, the `negatives` best rows of other labels in the window [least * p, p].

Components are floor(256 * x), so scores are whole numbers and exact in doubles while the sums of absolute products stay under
2**53. Higher scores come first, ties by smaller vec_id. Rows with a null vec_id, label or vector, or with a null
or non-finite component, take no part; vectors meet those of their own dimension (an empty vector scores 0). Of rows
that repeat a vec_id the one with the smallest label, then vector takes part. Other columns are ignored. An empty
table, or one without anchors, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boxloom.llm.common import store

SHARD_ROWS = 64_000
#: Small tables are cut finer, down to this size, while there are free cores.
LEAST_ROWS = 8_000
WAVE = 2048
BATCH = 32
BLOCK = 8
PAIRS = 20_000
#: Pairs are completed one by one once at most this share of a batch is left.
SPARSE = 0.05
LOWER = 0.8

SQL = """
WITH numbered AS (
 SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
 FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
 SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike, CAST(list_inner_product(a.vector, r.vector) AS BIGINT) AS score
 FROM numbered a JOIN numbered r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
 SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
 QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
 CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
 s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id
WHERE NOT s.alike AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""


class Lists:
    """One shard's rows by dimension; the lists are made anew for every threshold."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.order = np.argsort(-np.square(vectors).sum(axis=0), kind="stable")
        self.vectors = np.ascontiguousarray(vectors[:, self.order])
        self.left = self.norms_left(self.vectors)
        self.largest = float(self.left[:, 0].max(initial=0))
        self.theta: float | None = None

    @staticmethod
    def norms_left(vectors: np.ndarray) -> np.ndarray:
        """Norms of the dimensions from each on; a column more than there are dimensions."""
        squares = np.square(vectors)[:, ::-1].cumsum(axis=1)[:, ::-1]
        return np.sqrt(np.c_[squares, np.zeros(len(vectors))])

    def thetas(self) -> Iterator[float]:
        theta = self.largest * LOWER
        while theta > 0.02 * self.largest:
            yield theta
            theta *= LOWER
        yield -np.inf

    def lower(self, theta: float) -> None:
        """List rows for thresholds of at least `theta` times the anchor's norm."""
        if theta == self.theta:
            return
        size = self.vectors.shape[1]
        listed = np.minimum((self.left >= theta).sum(axis=1), size)
        self.rows = np.argsort(-listed, kind="stable")
        self.listed, self.theta = listed[self.rows], theta
        self.table = np.where(np.arange(size) < self.listed[:, None], self.vectors[self.rows], 0.0)

    def above(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs (anchor, row, score) with a score of at least the anchor's threshold."""
        size = self.vectors.shape[1]
        # without a threshold even rows without a listed dimension count
        many = len(self.rows) if self.theta == -np.inf else int((self.listed > 0).sum())
        rows, listed = self.rows[:many], self.listed[:many]
        partial, ends = np.zeros((len(anchors), many)), self.norms_left(anchors)
        slack = 0.5 + 1e-9 * ends[:, :1] * self.largest
        live = np.ones(partial.shape, bool)
        for at in range(0, size, BLOCK):
            n = int(np.searchsorted(-listed, -at))  # rows with a list for this dimension
            partial[:, :n] += anchors[:, at : at + BLOCK] @ self.table[:n, at : at + BLOCK].T
            seen = np.minimum(listed, min(at + BLOCK, size))
            live = partial + ends[:, seen] * self.left[rows, seen] >= least[:, None] - slack
            if live.sum() <= SPARSE * live.size:
                break
        a, r = np.nonzero(live)
        r = rows[r]
        score = np.empty(len(a))
        for at in range(0, len(a), PAIRS):
            part = slice(at, at + PAIRS)
            score[part] = np.einsum("nd,nd->n", anchors[a[part]], self.vectors[r[part]])
        enough = score >= least[a]
        return a[enough], r[enough], score[enough]


def _best(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:most]


def positives_of(lists: Lists, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, _, most: int) -> Iterator[tuple]:
    """Of each anchor the best rows of its label in this shard: (anchor, 0, row, score)."""
    vectors = vectors[:, lists.order]
    norms, todo = np.sqrt(np.square(vectors).sum(axis=1)), np.arange(len(ids))
    for theta in lists.thetas():
        lists.lower(theta)
        short = []
        for at in range(0, len(todo), BATCH):
            part = todo[at : at + BATCH]
            least = theta * norms[part] if theta > 0 else np.full(len(part), -np.inf)
            a, r, score = lists.above(vectors[part], least)
            fit = (lists.labels[r] == labels[part][a]) & (lists.ids[r] != ids[part][a])
            a, r, score = a[fit], r[fit], score[fit]
            ends = np.searchsorted(a, np.arange(len(part) + 1))
            for k, q in enumerate(part.tolist()):
                mine = slice(ends[k], ends[k + 1])
                if theta > 0 and (ends[k + 1] - ends[k] < most or norms[q] == 0):
                    short.append(q)
                    continue
                found = lists.ids[r[mine]]
                for b in _best(score[mine], found, most).tolist():
                    yield int(ids[q]), 0, int(found[b]), int(score[mine][b])
        todo = np.array(short, int)


def negatives_of(lists: Lists, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, tops: list[list[int]], most: int, share: tuple[int, int]) -> Iterator[tuple]:
    """Of each window of an anchor the best rows of other labels in this shard: (anchor, window, row, score)."""
    low, high = share
    vectors = vectors[:, lists.order]
    norms, todo = np.sqrt(np.square(vectors).sum(axis=1)), np.arange(len(ids))
    ends_at = np.array([min((low * t / high for t in w if t >= 0), default=np.inf) for w in tops])
    begins = np.array([max((t for t in w if t >= 0), default=-np.inf) for w in tops])
    todo = todo[begins >= 0]
    for theta in lists.thetas():
        if not len(todo):
            break
        lists.lower(theta)
        # rows above the highest window are not wanted: such anchors wait for a lower threshold, those without a norm for none
        asked = (theta * norms[todo] <= begins[todo]) & (norms[todo] > 0) if theta > 0 else np.ones(len(todo), bool)
        short, todo = [*todo[~asked].tolist()], todo[asked]
        for at in range(0, len(todo), BATCH):
            part = todo[at : at + BATCH]
            least = np.maximum(theta * norms[part], ends_at[part]) if theta > 0 else ends_at[part]
            a, r, score = lists.above(vectors[part], least)
            fit = (lists.labels[r] != labels[part][a]) & (score <= begins[part][a])
            a, r, score = a[fit], r[fit], score[fit]
            ends = np.searchsorted(a, np.arange(len(part) + 1))
            for k, q in enumerate(part.tolist()):
                mine = slice(ends[k], ends[k + 1])
                near, value = lists.ids[r[mine]], score[mine]
                inside = [(low * t <= high * value) & (value <= t) for t in tops[q]]
                full = all(t < 0 or low * t >= high * least[k] or here.sum() >= most for t, here in zip(tops[q], inside, strict=True))
                if not full and least[k] > ends_at[q]:
                    short.append(q)
                    continue
                for w, here in enumerate(inside):
                    for b in _best(value[here], near[here], most).tolist():
                        yield int(ids[q]), w, int(near[here][b]), int(value[here][b])
        todo = np.array(sorted(short), int)


def _join(rows: DataFrame, anchors: DataFrame, shards: int, answer: Callable) -> DataFrame:
    """anchor_id, place, vec_id, score: what `answer` finds of every anchor (with its tops) in every shard."""
    schema = pa.schema([("anchor_id", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    held = rows.select(F.size("vector").alias("size"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("role"), "vec_id", "label", "vector", F.lit(None).cast("array<long>").alias("tops"))
    asked = anchors.select(F.size("vector").alias("size"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("role"), "vec_id", "label", "vector", "tops")
    key = ["size", "shard", "role"]

    def runs(batches) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a < b:
                    yield tuple(keys[a].tolist()), batch.slice(a, b - a)

    def arrays(parts: list[pa.RecordBatch], size: int):
        whole = pa.Table.from_batches(parts).combine_chunks()
        flat = whole["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return whole["vec_id"].to_numpy(), whole["label"].to_numpy(), flat.reshape(whole.num_rows, size), whole["tops"].to_pylist()

    def scan(batches):
        place, lists, waiting = None, None, []

        def answers():
            found = list(answer(lists, *arrays(waiting, place[0])))
            waiting.clear()
            columns = list(zip(*found, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        building: list[pa.RecordBatch] = []
        for (size, shard, role), part in runs(batches):
            if (size, shard) != place:
                if waiting and lists is not None:
                    yield answers()
                place, lists, building = (size, shard), None, []
                waiting.clear()
            if role == 0:
                building.append(part)
                continue
            if building:
                lists = Lists(*arrays(building, size)[:3])
                building = []
            if lists is not None:
                waiting.append(part)
                if sum(p.num_rows for p in waiting) >= WAVE:
                    yield answers()
        if waiting and lists is not None:
            yield answers()

    dealt = held.unionByName(asked).repartitionById(shards, F.pmod(F.col("shard") + F.col("size"), F.lit(shards)))
    return dealt.sortWithinPartitions(*key).mapInArrow(scan, "anchor_id long, place int, vec_id long, score long")


def usable_rows(embeddings: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, vector (whole numbers as doubles) of the rows that take part."""
    vector = F.col("embedding").cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x).cast("double"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("vector"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.label", "row.vector")


def hard_negatives(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; `rows` as of `usable_rows`."""
    context = rows.sparkSession.sparkContext
    rows = store(rows, "vectors")
    total = rows.count()
    shards = max(1, -(-total // SHARD_ROWS), min(context.defaultParallelism, -(-total // LEAST_ROWS)))
    anchors = rows.where(anchor)
    near = _join(rows, anchors.withColumn("tops", F.lit(None).cast("array<long>")), shards, lambda lists, *asked: positives_of(lists, *asked, positives))
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    chosen = store(near.withColumn("k", F.row_number().over(best)).where(F.col("k") <= positives), "positives")
    # the place of a window is the place of its positive
    tops = chosen.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("k", "score"))).alias("tops"))
    asked = anchors.join(tops, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "vector", F.col("tops.score").alias("tops"))
    far = _join(rows, asked, shards, lambda lists, *asked: negatives_of(lists, *asked, negatives, share))
    best = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "vec_id")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    kept = chosen.select("anchor_id", (F.col("k") - 1).alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return kept.join(far.select("anchor_id", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(usable_rows(table, label), F.col("vec_id") % 100 == 0)
