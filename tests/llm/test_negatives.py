import math

import numpy as np
import pytest
from boxloom.llm import op12_negatives as mining
from llm_cases import tables
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    good = {}
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i % 7 == 0 else y
        here = (y, [float(math.floor(256 * x)) for x in v])
        good[i] = min(good.get(i, here), here)
    out = set()
    for a, (y, v) in good.items():
        if a % 100:
            continue
        scored = sorted((-int(sum(p * q for p, q in zip(v, w))), i, z) for i, (z, w) in good.items() if i != a and len(w) == len(v))
        for p, pid, _ in [s for s in scored if s[2] == y][:5]:
            inside = [(i, -s) for s, i, z in scored if z != y and 80 * -p <= 100 * -s <= 100 * -p]
            out |= {(a, pid, k, i, -p, s) for k, (i, s) in enumerate(inside[:5], 1)}
    return out


def table(shape, n=900, size=12, seed=3):
    rng = np.random.default_rng(seed)
    if shape == "gauss":
        vectors = rng.normal(size=(n, size)) / 3
    elif shape == "copies":  # a third of all rows is one vector
        vectors = rng.normal(size=(n, size)) / 3
        vectors[rng.random(n) < 0.34] = vectors[0]
    elif shape == "ties":
        vectors = rng.integers(-1, 2, (n, size)) / 4
    elif shape == "lowlabel":  # positives are far below the best negatives
        vectors = np.abs(rng.normal(size=(n, size)))
    else:  # few dimensions hold the energy
        vectors = rng.normal(size=(n, size)) * np.geomspace(1, 0.01, size)
    labels = rng.integers(0, 10, n)
    if shape == "lowlabel":
        labels[labels == 3] = 4
        labels[100], labels[5], labels[8] = 3, 3, 3
    return [(int(i), v.tolist(), int(y)) for i, (v, y) in enumerate(zip(vectors, labels))]


ODD = [
    (None, [1.0] * 12, 1), (2000, None, 1), (2100, [1.0] * 12, None), (2200, [1.0] * 11 + [None], 1), (2300, [1.0] * 11 + [float("nan")], 1),
    (2400, [1.0] * 11 + [float("inf")], 1), (2500, [0.0] * 12, 2), (2600, [], 2), (2601, [], 2), (2602, [], 3), (2700, [0.5, 0.5], 4), (2701, [0.5, 0.4], 4),
    (2702, [0.5, 0.39], 5), (2701, [0.5, 0.4], 4), (2702, [0.5, 0.38], 5), (2800, [9.0] * 12, 77), (-100, [0.3] * 12, 5),
]


@pytest.mark.parametrize("shape", ["gauss", "copies", "ties", "lowlabel", "skewed"])
@pytest.mark.parametrize("shard", [64_000, 90])
def test_negatives_against_brute_force(spark, tmp_path, monkeypatch, shape, shard):
    monkeypatch.setattr(mining, "SHARD_ROWS", shard)
    rows = table(shape) + ODD
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "vec_id AS size", "label AS tops", "label AS shard")
    got = [tuple(r) for r in mining.query(spark, tables(tmp_path, embeddings=frame)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_lists_omit_and_find_every_pair():
    rng = np.random.default_rng(1)
    vectors = np.floor(256 * rng.normal(size=(500, 32)) * np.geomspace(1, 0.05, 32))
    lists = mining.Lists(np.arange(500), np.zeros(500), vectors)
    anchors = vectors[:40][:, lists.order]
    norms = np.linalg.norm(anchors, axis=1)
    for theta in lists.thetas():
        lists.lower(theta)
        least = theta * norms if theta > 0 else np.full(40, -np.inf)
        a, r, score = lists.above(anchors, least)
        exact = vectors[:40] @ vectors.T
        assert set(zip(a.tolist(), r.tolist())) == set(map(tuple, np.argwhere(exact >= least[:, None]).tolist()))
        assert (score == exact[a, r]).all()
        assert theta < 0 or lists.listed.sum() < lists.vectors.size


def test_negatives_empty_table(spark):
    frame = spark.createDataFrame([(1, [1.0], 1)], SCHEMA)
    for rows in (frame.where("false"), frame):
        assert mining.hard_negatives(mining.usable_rows(rows, F.col("label")), F.col("vec_id") % 100 == 0).count() == 0
