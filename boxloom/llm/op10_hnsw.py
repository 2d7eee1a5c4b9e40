"""Embedding near-dedup by hierarchical navigable small-world graphs, one per shard.

Vectors are dealt to shards; each shard builds a graph and keeps it as one row of a table. Every vector is a query to every
shard: queries move to the shards, of which each task opens one graph, once, and answers its queries as they
stream by. A shard that all queries would keep busy for too long is copied to several tasks, one per
`TASK_QUERIES` queries, so shuffled bytes follow vectors times shards.

A shard's beam is chosen by an audit: stored vectors, turned by random directions to a cosine between the threshold and
half way to 1, are asked, and the beam is doubled until the mean recall of what the graph itself finds reaches `AUDIT`
against brute force over the shard. So recall is measured whatever links a table has. If no beam reaches it, the
shard is searched exactly; the beam and the recall of each shard are columns of `graphs`. A query whose whole
beam is linked is asked again with a wider beam and, as the widest beam, the whole shard. Found pairs are verified by their
cosine in double precision. A block of queries returns counts and a spanning forest, not pairs, so a cloud of thousands of near copies
stays small.

Equal vectors are collapsed into one row with a count before anything else: copies are links of each other.
Vectors that are null, zero or hold null or non-finite components link with nothing; vectors are compared
with those of their own dimension. Repeated rows are
copies (a repeated vec_id counts as another vector). Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm.common import store
from boxloom.llm.components import Forest, components

#: Components of one shard: 64,000 vectors of 64 dimensions.
SHARD_CELLS = 64_000 * 64
#: Small tables are cut finer, down to this many vectors, while there are free cores.
LEAST_VECTORS = 8_000
TASK_QUERIES = 250_000
QUERY_BLOCK = 5_000
AUDIT_QUERIES = 200
AUDIT = 0.98
BACK_LINKS = 64
NEIGHBOURS = 12
EXPAND = 4


def _spread(ids: np.ndarray, sims: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """For each row choose up to `most` candidates, each nearer to the row than to those chosen before; -1 fills up."""
    order = np.argsort(-sims, axis=1, kind="stable")
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    held = vectors[np.maximum(ids, 0)]
    among = np.matmul(held, held.transpose(0, 2, 1))
    rows, width = ids.shape
    chosen, closest = np.zeros((rows, width), bool), np.full((rows, width), -2.0, np.float32)
    count = np.zeros(rows, int)
    for k in range(width):
        take = (ids[:, k] >= 0) & (count < most) & (closest[:, k] < sims[:, k])
        chosen[:, k] = take
        count += take
        closest = np.where(take[:, None], np.maximum(closest, among[:, k, :]), closest)
    # places left go to the nearest of the others
    rank = np.where(chosen, 0, width) + np.arange(width)
    rank = np.where(ids >= 0, rank, 4 * width)
    best = np.argsort(rank, axis=1)[:, :most]
    return np.take_along_axis(np.where(ids >= 0, ids, -1), best, 1)


class Graph:
    """Layers of neighbour lists (-1: none) over unit vectors; searches enter at a node of the top layer."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray], entry: int):
        self.vectors, self.layers, self.entry = vectors, layers, entry

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 1, beam: int = 48) -> Graph:
        n, rng = len(vectors), np.random.default_rng(seed)
        level = np.minimum((-np.log(1 - rng.random(n)) / np.log(NEIGHBOURS)).astype(int), 6)
        order = np.argsort(-level, kind="stable")
        layers = [np.full((n, 2 * NEIGHBOURS if k == 0 else NEIGHBOURS), -1, np.int32) for k in range(level.max() + 1)]
        graph, done = cls(vectors, layers, int(order[0])), 1
        while done < n:
            batch = order[done : done + max(1, min(done, 500))]
            # nodes come by falling level: a batch is split where the level changes
            batch = batch[level[batch] == level[batch[0]]]
            graph._insert(batch, int(level[batch[0]]), beam)
            done += len(batch)
        return graph

    def _insert(self, batch: np.ndarray, level: int, beam: int) -> None:
        queries = self.vectors[batch]
        entry = np.full((len(batch), 1), self.entry)
        mutual = queries @ queries.T
        np.fill_diagonal(mutual, -2)
        near = np.argsort(-mutual, axis=1)[:, : min(16, len(batch) - 1)]
        found = []
        for k in range(len(self.layers) - 1, -1, -1):
            ids, sims = self._beam(k, queries, entry, beam if k <= level else 1)
            entry = ids[:, :1] if k > level else ids
            if k <= level:
                ids = np.c_[ids, batch[near]]
                sims = np.c_[sims, np.take_along_axis(mutual, near, 1)]
                found.append((k, _spread(ids, sims.astype(np.float32), self.vectors, NEIGHBOURS)))
        for k, chosen in found:
            table = self.layers[k]
            table[batch, : chosen.shape[1]] = chosen
            source, target = np.repeat(batch, chosen.shape[1]), chosen.ravel()
            self._back(k, source[target >= 0], target[target >= 0])

    def _back(self, k: int, source: np.ndarray, target: np.ndarray) -> None:
        """Link back from targets; a list that overflows is spread again."""
        table = self.layers[k]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        place = np.arange(len(target)) - np.searchsorted(target, target)
        # a node with very many new links gets them in rounds, so that each is weighed against those it has
        for round_no in range(int(place.max(initial=-1)) // BACK_LINKS + 1):
            here = place // BACK_LINKS == round_no
            self._add_back(table, source[here], target[here], place[here] % BACK_LINKS)

    def _add_back(self, table: np.ndarray, source: np.ndarray, target: np.ndarray, place: np.ndarray) -> None:
        nodes, which = np.unique(target, return_inverse=True)
        more = np.full((len(nodes), int(place.max()) + 1), -1, np.int32)
        more[which.ravel(), place] = source
        for at in range(0, len(nodes), 2000):
            rows = nodes[at : at + 2000]
            ids = np.c_[table[rows], more[at : at + 2000]]
            ids.sort(axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.einsum("rd,rkd->rk", self.vectors[rows], self.vectors[np.maximum(ids, 0)])
            sims[ids < 0] = -3
            table[rows] = _spread(ids, sims, self.vectors, table.shape[1])[:, : table.shape[1]]

    def _beam(self, k: int, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """All queries step together: each opens the best nodes of its beam that it has not opened yet."""
        n, table = len(queries), self.layers[k]
        seen = np.zeros((n, len(self.vectors) + 1), bool)
        rows = np.arange(n)[:, None]
        seen[:, -1] = True
        ids = entry.astype(np.int64)
        seen[rows, ids] = True
        sims = np.einsum("nd,nkd->nk", queries, self.vectors[np.maximum(ids, 0)])
        sims[ids < 0] = -3
        opened = ids < 0
        while True:
            step = min(EXPAND, ids.shape[1])
            waiting = np.where(opened, -4, sims)
            best = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            fresh = ~np.take_along_axis(opened, best, 1)
            active = np.flatnonzero(fresh.any(axis=1))
            if not len(active):
                break
            np.put_along_axis(opened, best, True, 1)
            best, fresh = best[active], fresh[active]
            from_ids = np.take_along_axis(ids[active], best, 1)
            next_ids = np.where(fresh[:, :, None], table[from_ids], -1).reshape(len(active), -1)
            new = ~seen[active[:, None], next_ids]
            # two of the opened nodes may name one neighbour: mark by the first place that stays
            next_ids = np.where(new, next_ids, -1)
            next_ids.sort(axis=1)
            next_ids[:, 1:][next_ids[:, 1:] == next_ids[:, :-1]] = -1
            seen[active[:, None], next_ids] = True
            got = np.einsum("nd,nkd->nk", queries[active], self.vectors[np.maximum(next_ids, 0)])
            got[next_ids < 0] = -3
            width = next_ids.shape[1]
            all_ids = np.full((n, ids.shape[1] + width), -1)
            all_sims, all_opened = np.full(all_ids.shape, -3.0, np.float32), np.ones(all_ids.shape, bool)
            all_ids[:, : ids.shape[1]], all_sims[:, : ids.shape[1]], all_opened[:, : ids.shape[1]] = ids, sims, opened
            all_ids[active, ids.shape[1] :], all_sims[active, ids.shape[1] :], all_opened[active, ids.shape[1] :] = next_ids, got, next_ids < 0
            keep = np.argsort(-all_sims, axis=1)[:, :beam]
            ids, sims, opened = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_sims, all_opened))
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.full((len(queries), 1), self.entry)
        for k in range(len(self.layers) - 1, 0, -1):
            entry = self._beam(k, queries, entry, 1)[0]
        return self._beam(0, queries, entry, beam)

    def linked(self, queries: np.ndarray, beam: int, cut: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at least `cut` alike; beams that are linked to the last place are widened."""
        return self._answers(queries, beam, cut)[:2]

    def _answers(self, queries: np.ndarray, beam: int, cut: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs of `linked`, and which queries the whole shard answered."""
        pairs, whole = [], np.zeros(len(queries), bool)
        for at in range(0, len(queries), 500):
            todo, wide = np.arange(at, min(at + 500, len(queries))), beam
            while len(todo):
                if wide >= min(1000, len(self.vectors)):  # the widest beam: the whole shard
                    q, v = np.nonzero(queries[todo] @ self.vectors.T >= cut)
                    pairs.append((todo[q], v))
                    whole[todo] = True
                    break
                ids, sims = self.search(queries[todo], wide)
                over = (sims[:, -1] >= cut) & (ids[:, -1] >= 0) & (ids.shape[1] >= wide)
                q, c = np.nonzero((sims >= cut) & (ids >= 0) & ~over[:, None])
                pairs.append((todo[q], ids[q, c]))
                todo, wide = todo[over], wide * 4
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs]), whole

    def planted(self, cut: float) -> np.ndarray:
        """Stored vectors turned by random directions, to cosines between `cut` and half way to 1."""
        rng = np.random.default_rng(3)
        chosen = self.vectors[rng.permutation(len(self.vectors))[:AUDIT_QUERIES]].astype(np.float64)
        away = rng.normal(size=chosen.shape)
        away -= (away * chosen).sum(axis=1, keepdims=True) * chosen
        length = np.linalg.norm(away, axis=1, keepdims=True)
        away /= np.where(length > 1e-9, length, 1)  # in one dimension there is no other direction
        cosine = rng.uniform(cut, (1 + cut) / 2, (len(chosen), 1))
        turned = cosine * chosen + np.sqrt(1 - cosine**2) * away
        return (turned / np.linalg.norm(turned, axis=1, keepdims=True)).astype(np.float32)

    def audited(self, cut: float) -> tuple[int, float]:
        """The narrowest beam, doubling from 32, whose mean recall on planted queries reaches AUDIT, and that recall; else the whole shard.

        Queries that the whole shard answers do not count.
        """
        n, queries = len(self.vectors), self.planted(cut)
        q, v = np.nonzero(queries @ self.vectors.T >= cut)
        keys, counts, beam = q * n + v, np.bincount(q, minlength=len(queries)), 32
        while beam < min(1000, n):
            found, near, whole = self._answers(queries, beam, cut)
            hits = np.bincount(found[np.isin(found * n + near, keys)], minlength=len(queries))
            judged = ~whole & (counts > 0)
            recall = float((hits[judged] / counts[judged]).mean()) if judged.any() else 1.0
            if recall >= AUDIT:
                return beam, recall
            beam *= 2
        return n, 1.0

    def dump(self) -> bytes:
        import pickle

        return pickle.dumps((self.layers, self.entry), protocol=5)

    @classmethod
    def load(cls, data: bytes, vectors: np.ndarray) -> Graph:
        import pickle

        return cls(vectors, *pickle.loads(data))


def _unit(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    scale = np.abs(flat).max(axis=1, keepdims=True)
    flat = flat / scale
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _graphs(members: DataFrame, cut: float) -> DataFrame:
    def build(table: pa.Table) -> pa.Table:
        size = table["size"][0].as_py()
        exact = _unit(table["vector"], size)
        graph = Graph.build(exact.astype(np.float32))
        beam, recall = graph.audited(cut)
        return pa.table({
            "size": pa.array([size], pa.int32()), "shard": pa.array([table["shard"][0].as_py()], pa.int32()), "beam": pa.array([beam], pa.int32()), "recall": pa.array([recall], pa.float64()),
            "graph": pa.array([graph.dump()], pa.binary()), "firsts": pa.array([table["first"].to_pylist()], pa.list_(pa.int64())),
            "copies": pa.array([table["copies"].to_pylist()], pa.list_(pa.int64())), "exact": pa.array([exact.tobytes()], pa.binary()),
        })

    return members.groupBy("size", "shard").applyInArrow(
        build, "size int, shard int, beam int, recall double, graph binary, firsts array<long>, copies array<long>, exact binary"
    )


def _ask(cosine: float):
    """Answers to the queries that follow their shard's graph in a partition: links, and a forest, per block of queries."""
    schema = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def answer(graph: Graph, there: np.ndarray, held: dict, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        exact, mine = _unit(table["vector"], held["size"]), table["first"].to_numpy()
        q, v = graph.linked(exact.astype(np.float32), held["beam"], cosine - 1e-4)
        sure = np.zeros(len(q), bool)
        for at in range(0, len(q), 100_000):
            part = slice(at, at + 100_000)
            sure[part] = np.einsum("nd,nd->n", exact[q[part]], there[v[part]]) >= cosine
        q, v = q[sure], v[sure]
        other = held["firsts"][v] != mine[q]
        q, v = q[other], v[other]
        links = np.bincount(q, weights=held["copies"][v], minlength=len(mine)).astype(np.int64)
        forest = Forest()
        for x, y in zip(mine[q].tolist(), held["firsts"][v].tolist(), strict=True):
            forest.union(x, y)
        a, b = forest.edges()
        some = np.flatnonzero(links)
        columns = [*a, *mine[some].tolist()], [*b, *[None] * len(some)], [*[0] * len(a), *links[some].tolist()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)

    def scan(batches):
        place, graph, there, held, waiting = None, None, None, {}, []
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                rows, (*here, role) = batch.slice(a, b - a), keys[a].tolist()
                if here != place:
                    if waiting:
                        yield answer(graph, there, held, waiting)
                    place, graph, waiting = here, None, []
                if role == 0:
                    row = rows.select(["beam", "graph", "exact"]).to_pylist()[0]
                    held = {"size": here[0], "beam": row["beam"]}
                    held |= {c: np.asarray(rows.column(rows.schema.get_field_index(c))[0].values) for c in ("firsts", "copies")}
                    there = np.frombuffer(row["exact"], np.float64).reshape(-1, here[0])
                    graph = Graph.load(row["graph"], there.astype(np.float32))
                elif graph is not None:
                    waiting.append(rows)
                    if sum(r.num_rows for r in waiting) >= QUERY_BLOCK:
                        yield answer(graph, there, held, waiting)
                        waiting = []
        if waiting:
            yield answer(graph, there, held, waiting)

    return scan


def _points(good: DataFrame) -> DataFrame:
    """Different vectors with their smallest id and how many there are."""
    return store(good.groupBy("vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")).withColumn("size", F.size("vector")), "points")


def graphs(points: DataFrame, cosine: float) -> tuple[DataFrame, int]:
    """size, shard, beam, recall (as audited), graph and its vectors, per shard; and the number of shards."""
    total, cells = points.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    cores = points.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-cells // SHARD_CELLS), min(cores, -(-total // LEAST_VECTORS)))
    members = points.withColumn("shard", F.pmod(F.hash("first"), F.lit(shards)).cast("int"))
    return store(_graphs(members, cosine), "graphs"), shards


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = (
        F.col("vector").isNotNull() & F.exists("vector", lambda x: x != 0) & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    good = rows.where("usable")
    points = _points(good)
    built, shards = graphs(points, cosine)
    cores, total = good.sparkSession.sparkContext.defaultParallelism, points.count()
    # tasks per shard
    copies = max(1, -(-total // TASK_QUERIES), min(-(-total // QUERY_BLOCK), -(-cores // shards)))
    salt = F.pmod(F.xxhash64("first"), F.lit(copies)).cast("int")
    kinds = {"first": "bigint", "vector": "array<double>", "beam": "int", "graph": "binary", "exact": "binary", "firsts": "array<bigint>", "copies": "array<bigint>"}
    each = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    none = lambda *names: [F.lit(None).cast(kinds[n]).alias(n) for n in names]
    there = built.select("size", "shard", each(copies, "salt"), F.lit(0).alias("role"), *none("first", "vector"), "beam", "graph", "exact", "firsts", "copies")
    asked = points.select("size", each(shards, "shard"), salt.alias("salt"), F.lit(1).alias("role"), "first", "vector", *none("beam", "graph", "exact", "firsts", "copies"))
    tasks = shards * copies
    dealt = there.unionByName(asked).repartitionById(tasks, F.pmod(F.col("shard") * copies + F.col("salt") + F.col("size"), F.lit(tasks)))
    answers = store(dealt.sortWithinPartitions("size", "shard", "salt", "role").mapInArrow(_ask(cosine), "node long, root long, links long"), "answers")
    labels = components(answers.where("root IS NOT NULL").selectExpr("node AS a", "root AS b"))
    counts = answers.where("root IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    classes = (
        points.select("first", "copies")
        .join(labels, F.col("first") == F.col("node"), "left")
        .drop("node")
        .join(counts, F.col("first") == F.col("node"), "left")
        .select("first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    )
    owner = good.join(points.select("vector", "first"), "vector").select("vec_id", "first")
    found = owner.join(store(classes, "classes"), "first").select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return found.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
