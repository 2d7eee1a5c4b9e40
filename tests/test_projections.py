"""Run-length masks, COCO tables and the taxonomy, against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.functions import masks
from boxloom.operators import coco, taxonomy
from boxloom.operators.ranking import dense_ids, numbered


def encode(runs):
    """The public text form, one number at a time."""
    out = []
    for k, x in enumerate(runs):
        if k > 2:
            x -= runs[k - 2]
        more = True
        while more:
            code = x & 31
            x >>= 5
            more = x != -1 if code & 16 else x != 0
            out.append(chr((code | 32 if more else code) + 48))
    return "".join(out)


def many_runs(seed, n=300):
    rng = random.Random(seed)
    return [[rng.choice([0, 1, rng.randrange(40), rng.randrange(10**6), rng.randrange(2**40)]) for _ in range(rng.randrange(12))] for _ in range(n)] + [[], [0], [7] * 9]


@pytest.mark.parametrize("seed", range(3))
def test_text_runs(seed):
    runs = many_runs(seed)
    texts = masks.encode_runs([None, *runs])
    assert texts == [None, *map(encode, runs)]
    broken = ["o", "52X13\x1f", "~", "é", "P" * 40]
    mixed = [*texts[:5], *broken, *texts[5:]]
    got = masks.decode_texts(mixed)
    want = [None, *runs[:4], *[None] * 4, got[9], *runs[4:]]
    assert [None if g is None else g.tolist() for g in got[:9] + got[10:]] == want[:9] + want[10:]
    assert masks.decode_texts([]) == [] and masks.decode_texts([None]) == [None] and masks.encode_runs([]) == []


def test_mask_stats_against_pixels(spark):
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for k in range(120):
        h, w = rng.integers(1, 9, 2).tolist()
        pixels = (rng.random(h * w) < rng.choice([0, 0.1, 0.5, 1])).astype(int)
        cuts = [0, *(np.flatnonzero(np.diff(pixels)) + 1).tolist(), h * w]
        runs = np.diff(cuts).tolist()
        runs = runs if pixels[0] == 0 else [0, *runs]
        on = np.flatnonzero(pixels)
        x, y = on // h, on % h
        want[k] = (len(on), *((int(x.min()), int(y.min()), int(x.max() - x.min() + 1), int(y.max() - y.min() + 1)) if len(on) else (None,) * 4))
        rows.append((k, runs, h, w))
    bad = [(200, [3, 3], 2, 2), (201, [5, -1], 2, 2), (202, None, 2, 2), (203, [4, None], 2, 2), (204, [4], None, 2), (205, [], 0, 0)]
    frame = spark.createDataFrame(rows + bad, "k int, runs array<long>, h int, w int")
    got = {r.k: r.m for r in frame.select("k", masks.mask_stats(F.col("runs"), F.col("h"), F.col("w")).alias("m")).collect()}
    assert {k: tuple(m) for k, m in got.items() if m is not None} == want


def test_formats_of_masks(spark):
    rows = [("a", "rle", "[1, 2, 1]", 2, 2), ("a", "rle", "[4]", 2, 2), ("b", "coco_rle", encode([1, 2, 1]), 2, 2), ("c", "png", "x", 2, 2), ("d", "rle", "oops", 2, 2), ("e", "coco_rle", "~~", 2, 2), ("f", None, None, 2, 2)]
    frame = spark.createDataFrame(rows, "mask_uri string, mask_format string, counts string, height int, width int")
    assert {(r.mask_uri, r.mask["area"], tuple(r.runs)) for r in coco.masks(frame).collect()} == {("a", 2, (1, 2, 1)), ("b", 2, (1, 2, 1))}


@pytest.mark.parametrize(
    "points, area",
    [([[0, 0], [4, 0], [4, 3]], 6.0), ([[0, 0], [0, 2], [2, 2], [2, 0]], 4.0), ([[1, 1], [5, 1], [5, 4], [3, 2], [1, 4]], 8.0), ([[0, 0], [1, 1]], None), ([], None), (None, None), ([[0, 0], [4], [4, 3]], None)],
)
def test_polygon_area(spark, points, area):
    frame = spark.createDataFrame([(points,)], "p array<array<double>>") if points is None else spark.createDataFrame([([[float(v) for v in p] for p in points],)], "p array<array<double>>")
    assert frame.select(masks.polygon_area(F.col("p"))).first()[0] == area


def test_dense_ids(spark):
    rng = random.Random(2)
    keys = rng.sample(range(10**6), 5000)
    frame = spark.createDataFrame([(k, f"v{k}") for k in keys], "k long, v string").repartition(13)
    got = [(r.k, r.v, r.id) for r in dense_ids(frame, ["k"], "id").collect()]
    assert sorted(got) == [(k, f"v{k}", n) for n, k in enumerate(sorted(keys), 1)]
    assert dense_ids(frame.filter("false"), ["k"], "id").count() == 0


SAMPLE = """sample_id string, image_asset struct<image_uri:string,width:int,height:int>, workflow struct<workflow_status:string>,
 objects array<struct<object_type:string, box:struct<x1:int,y1:int,x2:int,y2:int>, geometry_detail:struct<polygon:array<array<double>>,mask_uri:string>,
 classification:struct<multi_labels:array<struct<label_key:string,label_value:string>>>>>"""


def sample(name, objects, status="boxed"):
    return (name, ("raw\\a.jpg", 10, 20), (status,), objects)


def thing(kind, box=(1, 2, 5, 9), polygon=None, mask=None, labels=None):
    return (kind, box, (polygon, mask), (labels,))


def test_coco_tables(spark):
    rows = [
        sample("b", [thing("pipe"), thing(None, polygon=[[0.0, 0.0], [4.0, 0.0], [4.0, 3.0]]), thing("cable", box=None)]),
        sample("a", [thing("person", mask="m1"), thing("person", box=None, mask="m1"), thing("person", mask="gone")]),
        sample("c", None),
        sample("d", [thing("late")], "discarded"),
        sample(None, [thing("nobody")]),
    ]
    masks_in = spark.createDataFrame([("m1", "rle", "[3, 2, 1]", 3, 2)], "mask_uri string, mask_format string, counts string, height int, width int")
    images, categories, annotations = coco.project(spark.createDataFrame(rows, SAMPLE), masks_in)
    assert sorted(map(tuple, images.collect())) == [(1, "a", "raw/a.jpg", 10, 20), (2, "b", "raw/a.jpg", 10, 20), (3, "c", "raw/a.jpg", 10, 20)]
    assert sorted(map(tuple, categories.collect())) == [(1, "cable"), (2, "object"), (3, "person"), (4, "pipe")]
    got = sorted((r.id, r.image_id, r.category_id, r.x, r.y, r.width, r.height, r.area, r.iscrowd, r.runs) for r in annotations.collect())
    assert got == [
        (1, 1, 3, 1, 0, 1, 2, 2.0, 1, [3, 2, 1]),
        (2, 1, 3, 1, 0, 1, 2, 2.0, 1, [3, 2, 1]),
        (3, 1, 3, 1, 2, 4, 7, 28.0, 0, None),
        (4, 2, 4, 1, 2, 4, 7, 28.0, 0, None),
        (5, 2, 2, 1, 2, 4, 7, 6.0, 0, None),
    ]


def test_taxonomy(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"object_types": ["person"],\n "label_dimensions": {"helmet": ["on", "off"], "mood": []}}', encoding="utf-8")
    rows = [
        sample("ok", [thing("person", labels=[("helmet", "on"), ("helmet", "off")])]),
        sample("bad", [thing("robot", labels=[("helmet", "torn"), ("hat", "on"), ("mood", "gay"), (None, "x"), ("helmet", None)]), thing(None, labels=None)]),
        sample("none", []), sample("null", None),
    ]
    allowed = taxonomy.constraints(taxonomy.read_taxonomy(spark, str(tmp_path / "t.json")))
    found = taxonomy.violations(spark.createDataFrame(rows, SAMPLE), allowed)
    assert {tuple(r) for r in found.collect()} == {
        ("bad", 0, "object_type", None, "robot"), ("bad", 1, "object_type", None, None), ("bad", 0, "label_key", "hat", None), ("bad", 0, "label_key", None, None),
        ("bad", 0, "label", "helmet", "torn"), ("bad", 0, "label", "helmet", None), ("bad", 0, "label", "mood", "gay"),
    }
    counted = taxonomy.conformance(spark.createDataFrame(rows + rows, SAMPLE), allowed)
    assert {r.n_objects for r in counted.collect()} == {2}
    nothing = taxonomy.constraints(spark.createDataFrame([("oops",), (None,)], "text string"))
    assert nothing.count() == 0


def test_numbered_over_partitions(spark):
    """Keys that span partitions, nulls, batches that end inside a run, and no key at all."""
    rng = random.Random(4)
    rows = [(rng.choice([None, "a", "a", "a", "b", "c"]), rng.choice([None, 1, 2]), k) for k in rng.sample(range(10**6), 3000)]
    frame = spark.createDataFrame(rows, "s string, g int, k long").repartition(5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for keys in (["s"], ["s", "g"], []):
            got = {r.k: r.n for r in numbered(frame, keys, ["k"], "n").collect()}
            groups = {}
            for s, g, k in rows:
                groups.setdefault(tuple({"s": s, "g": g}[c] for c in keys), []).append(k)
            assert got == {k: n for ks in groups.values() for n, k in enumerate(sorted(ks), 1)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert numbered(frame.filter("false"), ["s"], ["k"], "n").count() == 0
    nested = frame.selectExpr("named_struct('s', s, 'g', g) AS key", "k")
    first = numbered(nested, ["key"], ["k"], "n").groupBy("key").agg(F.max("n").alias("n"), F.count("*").alias("c")).collect()
    assert len(first) > 5 and all(r.n == r.c for r in first)
