import random

import numpy as np
import pytest
import xxhash

from boxloom.llm import op07_simhash as simhash
from boxloom.llm import op10_hnsw as hnsw
from boxloom.llm.components import components
from llm_cases import corpus, frame, tables


def classes(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(140)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 2000 + i) for i in range(50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = classes({x for p in pairs for x in p}, pairs)
    assert got == {k: v for k, v in want.items() if any(k in p and p[0] != p[1] for p in pairs)}


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_against_brute_force(spark, tmp_path):
    rows = corpus(9, 90)
    got = simhash.query(spark, tables(tmp_path, documents=frame(spark, rows))).collect()
    prints = {i: brute_print(t) for i, t in rows}
    ids = list(prints)
    linked = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = classes(ids, linked)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}


@pytest.mark.parametrize("shape", ["random", "cloud"])
def test_vantage_points_find_every_pair(shape):
    rng = np.random.default_rng(3)
    points = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    base = points[:300] if shape == "random" else points[:2]
    flips = [np.bitwise_xor.reduce(np.uint64(1) << rng.integers(0, 64, 3).astype(np.uint64)) for _ in range(1500)]
    points = np.unique(np.r_[points, base[rng.integers(0, len(base), 1500)] ^ np.array(flips)])
    ids = np.arange(len(points))
    forest = simhash.link(points, ids, 4)
    near = np.argwhere(np.triu(np.bitwise_count(points[:, None] ^ points[None]) <= 4, 1))
    want = classes(ids.tolist(), near.tolist())
    assert {i: forest.find(i) for i in ids.tolist()} == want


def test_shards_find_every_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_POINTS", 60)
    rng = np.random.default_rng(4)
    points = rng.integers(0, 2**64, 900, dtype=np.uint64)
    points = np.r_[points, points[:300] ^ np.uint64(0b1011)].view(np.int64)
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, width: spark.createDataFrame([(i, int(p)) for i, p in enumerate(points)], "doc_id long, fp long"))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(None).collect()}
    assert got == {i: i - 900 if i >= 900 else i for i in range(1200)}


@pytest.mark.parametrize("points, radius", [(900, 4), (60 << 12, 4), (60 << 20, 4), (60 << 27, 4), (5000, 0), (10**6, 13), (10**6, 64)])
def test_pairs_share_a_shard_and_copies_do_not_grow(monkeypatch, points, radius):
    """Dealt for any number of points, a pair within the radius meets; a point has few copies and its shards are small."""
    monkeypatch.setattr(simhash, "SHARD_POINTS", 60)
    rng = np.random.default_rng(8)
    here = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    flipped = np.array([sum(1 << int(b) for b in rng.choice(64, radius, replace=False)) for _ in here], np.uint64)
    blocks, shared, bits = simhash.layout(points, radius)
    mine, theirs = ([*simhash.shards(p, blocks, shared, bits)] for p in (here, here ^ flipped))
    assert np.logical_or.reduce([a == b for a, b in zip(mine, theirs, strict=True)]).all()
    assert len(mine) <= simhash.COPIES and len({*np.concatenate(mine).tolist()}) <= len(mine) << shared * bits
    if radius < 5:
        assert len(mine) <= 35 and points >> shared * bits <= 60


def test_shards_by_several_blocks_find_every_pair(spark, monkeypatch):
    """So many shards that two points must share two blocks."""
    monkeypatch.setattr(simhash, "SHARD_POINTS", 0.1)
    rng = np.random.default_rng(6)
    points = rng.integers(0, 2**64, 900, dtype=np.uint64)
    points = np.r_[points, points[:300] ^ np.array([sum(1 << int(b) for b in rng.choice(64, 4, replace=False)) for _ in range(300)], np.uint64)].view(np.int64)
    assert simhash.layout(len(points), 4)[1] > 1
    found = simhash.classes(spark.createDataFrame([(int(p), i) for i, p in enumerate(points)], "fp long, first long")).collect()
    ids = {int(p): i for i, p in enumerate(points)}
    assert {ids[r.fp]: r.component_id for r in found} == {i: i - 900 if i >= 900 else i for i in range(1200)}


def test_simhash_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [(1, "a")]).where("false")).count() == 0


def test_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_CELLS", 400 * 16)
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 150)
    monkeypatch.setattr(hnsw, "TASK_QUERIES", 400)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(700, 16))
    near = base[rng.integers(0, 40, 400)] + rng.normal(size=(400, 16)) * 0.12
    vectors = [v.tolist() for v in np.r_[base, near, base[:30], base[:5] * 3e200]]
    odd = [None, [], [0.0] * 16, [1.0] * 15 + [None], [1.0] * 15 + [float("nan")], [1.0] * 15 + [float("inf")], [1.0, 0.0], [1.0, 0.01]]
    rows = list(enumerate(vectors + odd, 5))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = np.array(vectors) / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    pairs = np.argwhere(np.triu(unit @ unit.T >= 0.9, 1)) + 5
    n = len(vectors)
    linked = [*pairs.tolist(), (n + 11, n + 12)]
    want = classes([i for i, _ in rows], linked)
    links = dict.fromkeys(want, 0)
    for a, b in linked:
        links[a] += 1
        links[b] += 1
    assert len(got) == len(rows)
    # recall of a query, over all that have links
    assert np.mean([got[i][0] / links[i] for i in links if links[i]]) >= 0.97 and sum(g[0] for g in got.values()) >= 0.97 * sum(links.values())
    assert all(got[i][0] <= links[i] for i in links)
    assert np.mean([got[i][1] == want[i] for i in want]) > 0.97
    assert all(g[2] == (i == g[1]) for i, g in got.items())
    assert all(got[n + 5 + k] == (0, n + 5 + k, True) for k in range(6))


def test_vectors_empty_table_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0], 0)] * 2 + [(2, [1.0, 2.0], 0)], "vec_id long, embedding array<float>, first int")
    assert hnsw.near_duplicates(rows.where("false")).count() == 0
    assert sorted(tuple(r) for r in hnsw.near_duplicates(rows).collect()) == [(1, 2, 1, True)] * 2 + [(2, 2, 1, False)]


def test_graphs_answer_on_the_given_vectors(spark):
    """Sparse real tables: beams are narrow, recall is measured, no shard is searched exactly."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").selectExpr("vec_id", "CAST(embedding AS array<double>) AS vector")
    built, shards = hnsw.graphs(hnsw._points(rows), 0.9)
    found = built.selectExpr("beam", "recall", "size(firsts) AS n").collect()
    assert len(found) == shards and sum(r.n for r in found) == 2000
    assert all(r.beam < r.n / 2 and r.recall >= hnsw.AUDIT for r in found)


def test_vectors_with_clashing_names(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.1])], "vec_id long, embedding array<float>")
    names = [f"'x' AS {name}" for name in ("vector", "size", "shard", "salt", "role", "copies", "node", "links", "usable")]
    got = hnsw.near_duplicates(rows.selectExpr("*", *names)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_simhash_odd_rows(spark):
    """Nulls, ties and repeated rows, long and empty texts, and names that the operator uses itself."""
    rows = [(3, None), (1, ""), (2, " \n"), (7, "a b"), (7, "a b"), (5, "A  B"), (9, "x " * 40_000), (8, "other words here")]
    want = {3: 1, 1: 1, 2: 1, 7: 5, 5: 5, 9: 9, 8: 8}
    names = [f"doc_id AS {name}" for name in ("fp", "first", "point", "shard", "component", "node")]
    got = simhash.near_duplicates(frame(spark, rows).selectExpr("*", *names)).collect()
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == want
