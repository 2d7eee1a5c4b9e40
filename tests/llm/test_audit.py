import numpy as np
import pytest
from boxloom.llm import op10_hnsw as hnsw


def unit(x):
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def table(shape, n, size=64, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, size))
    if shape == "sparse":  # a few pairs
        base[-20:] = base[:20] + rng.normal(size=(20, size)) * 0.2
    elif shape == "clouded":  # a third of all vectors in one cloud, small groups beside it
        base[: n // 3] = base[0] + rng.normal(size=(n // 3, size)) * 0.15
        base[-n // 10 :] = base[n // 3 : n // 3 + n // 10] + rng.normal(size=(n // 10, size)) * 0.3
    return unit(base)


def mean_recall(graph, beam, queries, cut=0.9):
    """Over queries with links: the share of them that the graph finds."""
    q, v = graph.linked(queries, beam, cut)
    want = queries @ graph.vectors.T >= cut
    found = np.zeros_like(want)
    found[q, v] = True
    some = want.any(axis=1)
    assert not (found & ~want).any()
    return ((found & want).sum(axis=1)[some] / want.sum(axis=1)[some]).mean()


@pytest.mark.parametrize("shape", ["none", "sparse", "clouded"])
def test_graph_answers_with_measured_recall(shape):
    vectors = table(shape, 3000)
    graph = hnsw.Graph.build(vectors)
    beam, recall = graph.audited(0.9)
    assert beam < 1000 and recall >= hnsw.AUDIT  # not the whole shard
    assert mean_recall(graph, beam, vectors) >= 0.98
    rng = np.random.default_rng(9)
    others = unit(vectors[rng.permutation(len(vectors))[:500]] + rng.normal(size=(500, 64)) * 0.05)
    assert mean_recall(graph, beam, others) >= 0.9


def test_planted_queries_are_linked():
    vectors = table("none", 500)
    graph = hnsw.Graph.build(vectors)
    queries = graph.planted(0.9)
    best = (queries @ vectors.T).max(axis=1)
    assert len(queries) == hnsw.AUDIT_QUERIES and best.min() >= 0.899 and np.median(best) < 0.96


def test_audit_notices_lost_nodes():
    vectors = table("none", 1200)
    graph = hnsw.Graph.build(vectors)
    assert graph.audited(0.9)[0] < len(vectors)
    for layer in graph.layers:  # nothing leads to half of the nodes any more
        layer[layer < 600] = -1
    graph.entry = 900
    assert graph.audited(0.9) == (len(vectors), 1.0)


def test_back_links_of_a_hub_come_in_rounds(monkeypatch):
    monkeypatch.setattr(hnsw, "BACK_LINKS", 4)
    rng = np.random.default_rng(2)
    vectors = unit(np.r_[np.ones((1, 8)), rng.normal(size=(60, 8))])
    order = np.argsort(-(vectors[1:] @ vectors[0])) + 1
    layers = [np.full((61, 24), -1, np.int32)]
    graph = hnsw.Graph(vectors, layers, 0)
    source = order[::-1].copy()  # the nearest come last
    graph._back(0, source, np.zeros(60, int))
    assert int(order[0]) in layers[0][0]


def test_one_dimension_and_tiny_shards():
    for vectors in (np.ones((1, 3), np.float32) / np.sqrt(3), np.array([[1.0], [-1.0]], np.float32), unit(np.random.default_rng(1).normal(size=(40, 1)))):
        graph = hnsw.Graph.build(vectors.astype(np.float32))
        beam, recall = graph.audited(0.9)
        assert mean_recall(graph, beam, vectors) == 1.0
