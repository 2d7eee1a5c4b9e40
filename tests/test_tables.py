import dataclasses
import json
import os

import pytest
from pyspark.sql import functions as F

from boxloom.functions.geometry import make_box
from boxloom.operators import boxes, contract, export, objects, pixels, ranking, routing, samples
from boxloom.params import BoxFilter, BoxService, DirectPlan, ReviewPolicy, Run
from boxloom.plans.direct import annotate_directly
from boxloom.plans.generated import generation_tasks, ingest_generated
from boxloom.sources import assets, documents, manifest

RUN = Run(now="2026-05-08T10:00:00+08:00", now_utc="2026-05-08T02:00:00Z", pipeline_id="p", pipeline_version="test")


# --- sources ----------------------------------------------------------------------------------------


def test_listing_and_sizes(spark, tmp_path, write_png):
    root = tmp_path / "raw" / "deep"
    root.mkdir(parents=True)
    write_png(root / "A b.PNG", 12, 5)
    write_png(root / "two.png", 3, 4)
    (root / "broken.webp").write_bytes(b"junk")
    (root / "clip.MP4").write_bytes(b"v")
    (root / ".jpg").write_bytes(b"x")
    (root / "notes.txt").write_text("x")
    names = sorted(r.path.rsplit("/", 1)[1] for r in assets.list_assets(spark, str(tmp_path), "image").collect())
    assert [n.replace("%20", " ") for n in names] == ["A b.PNG", "broken.webp", "two.png"]
    assert assets.list_assets(spark, str(tmp_path), "video").count() == 1
    assert assets.list_assets(spark, str(tmp_path / "missing"), "image").count() == 0
    sizes = {r.image_uri.rsplit("/", 1)[1]: (r.width, r.height) for r in assets.image_sizes(spark, str(root)).collect()}
    assert sizes["two.png"] == (3, 4) and sizes["broken.webp"] == (None, None)


def test_frames(spark):
    rows = [("v/a b.mp4", 3000), ("c.mp4", 2500), ("d.mp4", 0), ("e.mp4", 1)]
    videos = spark.createDataFrame(rows, "path string, total_frames int")
    assert [r[0] for r in videos.select(assets.frame_count(F.col("total_frames"), 30)).collect()] == [100, 84, 0, 1]
    assert [r[0] for r in videos.select(assets.frame_count(F.col("total_frames"), 30, 10)).collect()] == [10, 10, 0, 1]
    assert assets.sample_frames(videos, 30, 0).count() == 0
    frames = assets.sample_frames(videos, 30, 10).withColumns({"width": F.lit(8), "height": F.lit(9)})
    first = assets.frame_manifest(frames, "out").orderBy("sample_id").collect()[0]
    assert (first.sample_id, first.image_uri) == ("sample_a_b_frame_000000", "out/a_b/a_b_frame_000000.jpg")
    with pytest.raises(ValueError):
        assets.frame_count(F.lit(1), 0)


def test_manifest_csv(spark, tmp_path):
    text = '﻿sample_id,image_uri,task_mode,note\n s1 , a.jpg ,generation,"two\nlines, ""q"""\ns2,b.jpg\n'
    (tmp_path / "m.csv").write_text(text, encoding="utf-8")
    rows = manifest.read_manifest(spark, str(tmp_path / "m.csv"))
    first, second = rows.collect()
    assert first.asDict() == {"sample_id": "s1", "image_uri": "a.jpg", "task_mode": "generation", "note": 'two\nlines, "q"'}
    assert second.task_mode == "" and second.note == ""
    assert [r.sample_id for r in routing.direct_rows(rows).collect()] == ["s2"]
    assert [r.sample_id for r in generation_tasks(rows).collect()] == ["s1"]
    assert generation_tasks(rows.drop("task_mode")).count() == 2
    assert generation_tasks(rows.filter("sample_id = 's2'")).isEmpty()
    manifest.write_generation_tasks(rows, str(tmp_path / "tasks"))
    assert spark.read.csv(str(tmp_path / "tasks"), header=True).columns[:4] == ["sample_id", "image_id", "image_uri", "anomaly_type"]


def test_document_files(spark, tmp_path):
    for name in ("b", "a"):
        (tmp_path / f"{name}.json").write_text(json.dumps({"sample_id": name}, indent=2))
    (tmp_path / "skip.txt").write_text("{}")
    rows = documents.read_raw_documents(spark, str(tmp_path)).orderBy("document").collect()
    assert [json.loads(r.raw_json)["sample_id"] for r in rows] == ["a", "b"]


# --- groups of any size -----------------------------------------------------------------------------


def test_positions_in_a_hot_key(spark):
    """Two thirds of all rows share one key; brute force agrees."""
    rows = [("hot" if i % 3 else f"k{i % 7}", (i * 7919) % 5003, i) for i in range(5003)]
    frame = spark.createDataFrame(rows, "key string, place int, i int").repartition(8)
    found = {(r.key, r.place): r.position for r in ranking.numbered(frame, ["key"], ["place"], "position").collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        for n, place in enumerate(sorted(r[1] for r in rows if r[0] == key), 1):
            expected[key, place] = n
    assert found == expected
    overall = ranking.numbered(frame.drop("key"), [], ["place"], "position").collect()
    assert all(r.position == r.place + 1 for r in overall)


def manifest_rows(spark, *ids, **more):
    rows = [(i, f"img_{i}", f"{i}.jpg", "cctv", 100, 80) for i in ids]
    return spark.createDataFrame(rows, "sample_id string, image_id string, image_uri string, source_type string, width int, height int")


def test_a_hot_sample_is_nested_in_parts(spark):
    flat = spark.range(25).selectExpr("'hot' AS sample_id", "CAST(id AS INT) AS pos", "concat('t', id) AS kind")
    flat = flat.union(spark.createDataFrame([("s", 1, "b"), ("s", 0, "a"), ("s", 0, "z")], flat.schema))

    def build(row):
        return objects.make_object(row["pos"], row["kind"], row["kind"], make_box(*map(F.lit, (0, 0, 9, 9))), F.lit("detector"))

    base = samples.base_samples(manifest_rows(spark, "hot", "s", "none"), RUN)
    nested = objects.nest_objects(base, flat, build, part_size=10).collect()
    found = {(r.sample_id, r.part_no): [o.object_id for o in r.objects] for r in nested}
    assert found.pop(("none", 0)) == [] and found.pop(("s", 0)) == ["a", "b"]
    assert {k: len(v) for k, v in found.items()} == {("hot", 0): 10, ("hot", 1): 10, ("hot", 2): 5}
    assert found[("hot", 2)][0] == "t20"
    whole = objects.nest_objects(base, flat, build, part_size=100)
    parts = objects.split_parts(whole, 10).collect()
    assert {(r.sample_id, r.part_no): len(r.objects) for r in parts} == {
        ("hot", 0): 10, ("hot", 1): 10, ("hot", 2): 5, ("s", 0): 2, ("none", 0): 0,
    }


def test_last_write_and_replacement(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "sample_id string, seq int, v string")
    latest = samples.last_write_wins(rows, ["sample_id"], [F.col("seq")])
    assert {r.sample_id: r.v for r in latest.collect()} == {"a": "z", "b": "q"}
    assert [tuple(r) for r in samples.duplicate_ids(rows).collect()] == [("a", 3)]
    new = spark.createDataFrame([("a", 9, "n")], rows.schema)
    kept = samples.replace_samples(latest, new, rows.filter("sample_id = 'b'").select("sample_id"))
    assert [tuple(r) for r in kept.collect()] == [("a", 9, "n")]


# --- box filter -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "corners, confidence, rules, expected",
    [
        ((1, 1, 2, 2), 0.9, BoxFilter(0, 4, 4, 16, 10), "tiny_box"),
        ((10, 10, 40, 70), 0.9, BoxFilter(0, 4, 4, 16, 10), None),
        ((50, 1, 54, 79), 0.9, BoxFilter(0, 4, 4, 16, 10), "extreme_aspect_ratio"),
        ((10, 10, 10, 50), None, BoxFilter(0, 0, 0, 0, 20), "invalid_box"),
        ((20, 10, 40, 70), None, BoxFilter(0.5, 0, 0, 0, 20), None),
        ((20, 10, 40, 70), 0.4, BoxFilter(0.5, 0, 0, 0, 20), "low_confidence"),
        ((0, 0, 2_000_000_000, 2_000_000_000), 1.0, BoxFilter(), None),
    ],
)
def test_drop_reasons(one, corners, confidence, rules, expected):
    box = make_box(*map(F.lit, corners))
    assert one(boxes.drop_reason(F.lit(confidence).cast("double"), box, rules))[0] == expected


# --- the direct branch ------------------------------------------------------------------------------


REPLY = json.dumps(
    {
        "boxes": [
            {"object_id": "tiny", "label": "person", "bbox": [1, 1, 2, 2], "score": 0.9},
            {"object_id": "valid", "label": "person", "bbox": [10, 10, 40, 70], "score": 0.9},
            {"object_id": "thin", "label": "person", "bbox": [50, 1, 54, 79], "score": 0.9},
        ]
    }
)
PLAN = DirectPlan(
    services={"ppe_person": BoxService()}, default_task_key="ppe_person", boxes=BoxFilter(0, 4, 4, 16, 10), crop_dir="crops"
)
REPLY_SCHEMA = "sample_id string, attempt int, raw_text string, request_width int, request_height int"


def test_direct_branch(spark):
    rows = manifest_rows(spark, "good", "late", "bad", "silent", "").withColumn("task_mode", F.lit(""))
    replies = [("good", 1, REPLY), ("late", 1, "no"), ("late", 2, REPLY), ("bad", 1, "{"), ("bad", 2, "["), ("bad", 3, "")]
    table = spark.createDataFrame([(*r, None, None) for r in replies], REPLY_SCHEMA)
    result = annotate_directly(rows, table, PLAN, RUN, classify=False)
    written = {r.sample_id: r for r in result.samples.collect()}
    assert sorted(written) == ["good", "late"]
    assert [o.object_id for o in written["late"].objects] == ["valid"]
    assert written["good"].objects[0].crop.crop_uri == "crops/good_valid.jpg"
    assert written["good"].workflow.workflow_status == "classified" and "pos" not in written["good"].objects[0]
    assert [r.sample_id for r in result.exhausted.collect()] == ["bad"]
    assert [r.sample_id for r in result.unanswered.collect()] == ["silent"]
    assert result.unreadable.count() == 0
    assert [r.error for r in result.rejected.collect()] == ["manifest row is missing required field: sample_id"]
    assert result.quarantined.count() == 0
    store = spark.createDataFrame([("bad",), ("other",)], "sample_id string")
    left = samples.replace_samples(store, result.samples.select("sample_id"), result.exhausted)
    assert sorted(r.sample_id for r in left.collect()) == ["good", "late", "other"]


def test_direct_outcomes_are_a_partition(spark):
    rows = manifest_rows(spark, "a", "b", "c").withColumn("task_mode", F.when(F.col("sample_id") == "c", "generation").otherwise(""))
    said = [("a", 2, REPLY), ("c", 1, "{"), ("stranger", 1, "{")]
    table = spark.createDataFrame([(*r, None, None) for r in said], REPLY_SCHEMA)
    verdict = '{"contains_person": true, "is_complete_visible_person": true}'
    reviews = spark.createDataFrame([("a", 1, 1, verdict), ("b", 1, 1, verdict)], "sample_id string, attempt int, pos int, raw_text string")
    plan = dataclasses.replace(PLAN, review=ReviewPolicy(drop_failed=False))
    result = annotate_directly(rows, table, plan, RUN, reviews=reviews, classify=False)
    # attempt 1 of "a" has a review only, so attempt 2 is chosen
    assert [(r.sample_id, len(r.objects)) for r in result.samples.collect()] == [("a", 1)]
    assert [r.sample_id for r in result.unanswered.collect()] == ["b"]
    assert result.exhausted.count() == 0 and result.rejected.count() == 0 and result.quarantined.count() == 0
    with pytest.raises(ValueError, match="needs answers"):
        annotate_directly(rows, table, plan, RUN)


def test_replies_nobody_asked_for_fail_no_attempt(spark):
    """Objects 0 and 2 fall to the box filter; "c" is generated; review drops the object of "d" before it is classified."""
    two = json.dumps({"boxes": [json.loads(REPLY)["boxes"][1] | {"label": kind, "bbox": [10, 10, 40, 70]} for kind in ("person", "pipe")]})
    ids = ["a", "b", "c", "d", "e", "f", "g"]
    rows = manifest_rows(spark, *ids).withColumn("source_type", F.when(F.col("sample_id") == "c", "generated").otherwise(F.col("source_type")))
    said = [(i, n, two if i == "g" else REPLY) for i in ids for n in (1, 2)]
    table = spark.createDataFrame([(*r, None, None) for r in said], REPLY_SCHEMA)
    good, gone, bad = '{"contains_person": true, "is_complete_visible_person": true}', '{"contains_person": false}', "busy {"
    reviews = [("a", 1, 1, good), ("a", 1, 0, bad), ("a", 1, 2, bad), ("b", 1, 1, bad), ("b", 2, 1, good), ("c", 1, 1, good), ("d", 1, 1, gone), ("e", 1, 1, good), ("e", 2, 1, good), ("f", 1, 1, bad), ("f", 2, 1, bad), ("g", 1, 0, good), ("g", 1, 1, bad), ("g", 1, None, bad)]
    answer = '{"hard_hat": true}'
    answers = [("a", 1, 1, answer), ("a", 1, 0, bad), ("b", 1, 1, answer), ("b", 2, 1, answer), ("c", 1, 1, bad), ("d", 1, 1, bad), ("e", 1, 1, bad), ("e", 2, 1, answer), ("f", 1, 1, answer), ("g", 1, 0, answer), ("g", 1, 1, answer)]
    kind = "sample_id string, attempt int, pos int, raw_text string"
    plan = dataclasses.replace(PLAN, services={"ppe_person": BoxService(object_type_map={"person": "person", "pipe": "pipe"})}, review=ReviewPolicy(drop_failed=True), max_attempts=2)
    frames = spark.createDataFrame(reviews, kind), spark.createDataFrame(answers, kind)
    result = annotate_directly(rows, table, plan, RUN, reviews=frames[0], answers=frames[1])
    written = {r.sample_id: len(r.objects) for r in result.samples.collect()}
    assert written == {"a": 1, "b": 1, "c": 1, "d": 0, "e": 1, "g": 2}
    assert [r.sample_id for r in result.exhausted.collect()] == ["f"]
    from boxloom.plans.direct import failed_requests

    failed = failed_requests(rows.withColumn("task_key", F.lit("ppe_person")), table, *frames, plan, RUN)
    assert sorted(map(tuple, failed.collect())) == [("b", 1, False), ("e", 1, False), ("f", 1, False), ("f", 2, False)]
    fine = [f.filter("raw_text <> 'busy {'") for f in frames]
    assert failed_requests(rows.withColumn("task_key", F.lit("ppe_person")), table, *fine, plan, RUN) is None


def test_later_attempts_are_worked_out_only_where_the_first_fails(spark, monkeypatch):
    """The first readable detection decides; "c" has none in attempt 1, "d" repeats one that cannot be read."""
    from boxloom.operators import replies
    from boxloom.plans import direct

    rows = manifest_rows(spark, "a", "b", "c", "d")
    said = [(i, n, "{" if (i, n) == ("c", 1) else REPLY) for i in "abcd" for n in (1, 2, 3)] + [("d", 1, "{")]
    table = spark.createDataFrame([(*r, None, None) for r in said], REPLY_SCHEMA)
    good, bad = '{"contains_person": true, "is_complete_visible_person": true}', "busy {"
    # nobody asks about object 0 of "a"; object 1 fails "b" once and "c" in its first two attempts
    reviews = [("a", n, 0, bad) for n in (1, 2, 3)] + [("a", 1, 1, good), ("b", 1, 1, bad), ("b", 2, 0, bad), ("b", 2, 1, good), ("b", 3, 0, bad)]
    reviews += [("c", 1, 1, bad), ("c", 2, 1, bad), ("c", 3, 1, good), ("d", 1, 1, bad), ("d", 2, 0, bad)]
    judged = spark.createDataFrame(reviews, "sample_id string, attempt int, pos int, raw_text string")
    plan = dataclasses.replace(PLAN, review=ReviewPolicy(drop_failed=True))
    worked, real = [], direct._failed
    monkeypatch.setattr(direct, "_failed", lambda bad, *rest: worked.append({(r.sample_id, r.attempt) for r in bad.collect()}) or real(bad, *rest))
    failed = direct.failed_requests(rows.withColumn("task_key", F.lit("ppe_person")), table, judged, None, plan, RUN)
    assert sorted(map(tuple, failed.collect())) == [("b", 1, False), ("c", 2, False)]
    assert worked == [{("a", 1), ("b", 1), ("c", 2), ("d", 2)}, {("b", 2), ("b", 3)}]
    result = direct.annotate_directly(rows, table, plan, RUN, reviews=judged, classify=False)
    assert {r.sample_id for r in result.samples.collect()} == {"a", "b", "c", "d"}
    attempts = replies.choose_attempts([direct.detection_attempts(table, plan), failed], 3)
    assert {r.sample_id: r.attempt for r in attempts.collect()} == {"a": 1, "b": 2, "c": 3, "d": 2}


def test_direct_result_is_the_same_for_any_part_size(spark):
    """One image, one document and one task, with the same objects, order and notes."""
    boxes_said = [{"object_id": f"o{i}", "label": "person", "bbox": [i, 1, i + 10, 20], "score": 0.9} for i in range(7)]
    boxes_said.insert(2, {"label": "person", "bbox": "none"})
    said = [("a", 1, json.dumps({"boxes": boxes_said})), ("b", 1, json.dumps({"boxes": boxes_said[:4]}))]
    table = spark.createDataFrame([(*r, None, None) for r in said], REPLY_SCHEMA)
    reviews = spark.createDataFrame([("a", 1, 0, '{"contains_person": false}')], "sample_id string, attempt int, pos int, raw_text string")
    rows = manifest_rows(spark, "a", "b")
    outcomes = []
    for part_size in (2, 10_000):
        plan = dataclasses.replace(PLAN, part_size=part_size, review=ReviewPolicy(drop_failed=True))
        result = annotate_directly(rows, table, plan, RUN, reviews=reviews, classify=False)
        documents = {r.sample_id: [o.object_id for o in r.objects] for r in result.samples.collect()}
        tasks = export.export_tasks(result.samples).count()
        notes = [sorted(map(tuple, getattr(result, name).collect())) for name in ("unreadable", "review_drops", "unmatched", "dropped_boxes", "repeated")]
        outcomes.append((documents, tasks, notes))
    assert outcomes[0] == outcomes[1]
    assert outcomes[0][0]["a"] == [f"o{i}" for i in range(1, 7)] and outcomes[0][1] == 2
    assert outcomes[0][2][0] == [("a", 1), ("b", 1)] and outcomes[0][2][1] == [("a", 1)]


def test_strict_runs_raise(spark):
    rows = manifest_rows(spark, "a").withColumn("source_type", F.lit("somewhere"))
    table = spark.createDataFrame([("a", 1, REPLY, None, None)], REPLY_SCHEMA)
    assert annotate_directly(rows, table, PLAN, RUN, classify=False).quarantined.count() == 1
    with pytest.raises(contract.ContractError, match="a: .*source_type"):
        annotate_directly(rows, table, dataclasses.replace(PLAN, strict=True), RUN, classify=False)
    foreign = spark.createDataFrame([(json.dumps({"sample_id": "x", "image_asset": {"source_type": "cctv"}}),)], "raw_json string")
    assert ingest_generated(foreign, RUN).rejected.count() == 1
    with pytest.raises(contract.ContractError, match="Expected generated"):
        ingest_generated(foreign, RUN, strict=True)


def test_violations_count_through_parts(spark):
    flat = spark.range(5).selectExpr("'s' AS sample_id", "CAST(id AS INT) AS pos", "concat('t', id) AS kind")

    def build(row):
        source = F.when(row["pos"] == 3, F.lit("elsewhere")).otherwise(F.lit("detector"))
        return objects.make_object(row["pos"], row["kind"], row["kind"], make_box(*map(F.lit, (0, 0, 9, 9))), source)

    base = samples.base_samples(manifest_rows(spark, "s"), RUN)
    for part_size in (2, 100):
        whole = objects.whole_samples(objects.nest_objects(base, flat, build, part_size))
        found = contract.violation_rows(contract.validate(objects.to_documents(boxes.attach_crops(whole, "crops", 0.0))), "sample_id")
        assert [(r.sample_id, r.path) for r in found.collect()] == [("s", "objects[3].geometry_source")]


def test_parts_win_and_count_together(spark):
    rows = [("a", 0, 1), ("a", 1, 1), ("a", 2, 1), ("a", 0, 2), ("a", 1, 2), ("b", 0, 1), (None, 0, 1)]
    table = spark.createDataFrame(rows, "sample_id string, part_no int, seq int")
    left = samples.last_write_wins(table, ["sample_id"], [F.col("seq")])
    assert sorted(map(tuple, left.collect()), key=str) == sorted([("a", 0, 2), ("a", 1, 2), ("b", 0, 1), (None, 0, 1)], key=str)
    assert samples.duplicate_ids(left).count() == 0
    assert [tuple(r) for r in samples.duplicate_ids(table).collect()] == [("a", 2)]


def test_sizes_and_crops_come_from_pixels(spark, tmp_path, write_png):
    path = str(tmp_path / "image.png")
    write_png(path, 123, 95)
    rows = manifest_rows(spark, "s").withColumns({"image_uri": F.lit(path), "width": F.lit("0"), "height": F.lit("0")})
    table = spark.createDataFrame([("s", 1, REPLY, None, None)], REPLY_SCHEMA)
    result = annotate_directly(rows, table, PLAN, RUN, sizes=assets.image_sizes(spark, str(tmp_path)), classify=False)
    sample = result.samples.collect()[0]
    assert (sample.image_asset.width, sample.image_asset.height) == (123, 95)
    cut = pixels.crop_pixels(result.samples, pixels.read_images(spark, str(tmp_path)), "crops", 0.0).collect()
    assert [(c.origin, c.width, c.height, c.nChannels) for c in cut] == [("crops/s_valid.jpg", 30, 60, 3)]
    away = result.samples.withColumn("image_asset", F.col("image_asset").withField("image_uri", F.lit("gone.png")))
    both = result.samples.unionByName(away.withColumn("sample_id", F.lit("t")))
    missed = pixels.crop_pixels(both, pixels.read_images(spark, str(tmp_path)), "crops", 0.0).collect()
    assert sorted((c.sample_id, c.width, c.error) for c in missed) == [("s", 30, None), ("t", None, pixels.UNREADABLE_IMAGE)]
    # Spark keeps channels as blue, green, red
    assert bytes(cut[0].data[:6]) == bytes([7, 10, 10, 7, 10, 11])


def test_parts_are_decided_from_one_reading(spark):
    """The rows, costly where they are whole documents, are read once; what is joined comes from the stored table."""
    rows = spark.range(40).selectExpr("CAST(id % 5 AS STRING) AS sample_id", "CAST(id % 3 AS INT) AS part_no", "id AS seq")
    left = samples.last_write_wins(rows, ["sample_id"], [F.col("seq")])
    assert "Range (" not in left._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, left.collect())) == [(str(i), (35 + i) % 3, 35 + i) for i in range(5)]


def test_parts_are_decided_without_the_driver(spark):
    """Keys are guessed to be few beside wide rows; they must not be sent through the driver, whatever the guess."""
    wide = [f"parse_json('{{}}') AS v{n}" for n in range(9)]
    rows = spark.range(600).selectExpr("CASE WHEN id % 50 > 0 THEN CAST(id % 50 AS STRING) END AS sample_id", "CAST(id % 3 AS INT) AS part_no", "id AS seq", *wide)
    left = samples.last_write_wins(rows, ["sample_id"], [F.col("seq")])
    assert "Broadcast" not in left._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.seq for r in left.collect()) == [*range(550, 600)]


def test_results_are_worked_out_once(spark):
    """Filters that follow from exploding a task's results must not hold the making of the results."""
    from boxloom.operators import export

    table = spark.createDataFrame([("s", 1, REPLY, None, None)], REPLY_SCHEMA)
    result = annotate_directly(manifest_rows(spark, "s"), table, PLAN, RUN, classify=False)
    tasks = export.export_tasks(result.samples)
    assert tasks.columns == ["data", "predictions"]
    rows = tasks.select("data.sample_id", F.explode(F.get("predictions", F.lit(0))["result"]).alias("r"))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "to_variant_object" in line]
    assert [(r.sample_id, r.type) for r in rows.select("sample_id", F.try_variant_get("r", "$.type", "string").alias("type")).collect()] == [("s", "rectanglelabels")]


def test_packed_json_lines(spark, tmp_path):
    rows = spark.range(2000).selectExpr("id", "repeat('same ', 50) AS text", "CAST(NULL AS INT) AS n")
    sizes = {}
    for codec in (None, "gzip"):
        path = f"{tmp_path}/{codec}"
        documents.write_json_lines(rows, path, codec)
        assert spark.read.schema(rows.schema).json(path).orderBy("id").collect() == rows.orderBy("id").collect()
        sizes[codec] = sum(os.path.getsize(f"{path}/{name}") for name in os.listdir(path) if name.startswith("part-"))
    assert sizes["gzip"] < sizes[None] / 10


def test_objects_stay_in_place_when_values_are_aligned(spark):
    """Samples laid out by sample are not shuffled again for their values, nor to be made whole."""
    from boxloom.operators import replies

    rows = [(f"s{n}", part, [{"pos": 2 * part}, {"pos": 2 * part + 1}]) for n in range(20) for part in range(n % 3 + 1)]
    placed = spark.createDataFrame([(None, 0, []), *rows], "sample_id string, part_no int, objects array<struct<pos:int>>").repartition("sample_id")
    values = spark.createDataFrame([(f"s{n}", pos, 10 * n + pos) for n in range(20) for pos in range(0, 6, 2)], "sample_id string, pos int, v int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        aligned = replies.align(placed, values, "v", part_size=2)
        assert aligned.columns == ["sample_id", "part_no", "objects", "v"]
        found = {(r.sample_id, r.part_no): r.v for r in aligned.collect()}
        whole = objects.whole_samples(aligned.drop("v").withColumn("n_parts", F.lit(1)))
        assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {(None, 0): None, **{(f"s{n}", part): {2 * part: 10 * n + 2 * part} for n in range(20) for part in range(n % 3 + 1)}}
