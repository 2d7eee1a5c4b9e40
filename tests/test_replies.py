import json

import pytest
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions import text
from boxloom.functions.columns import truthy
from boxloom.operators import classify, detect, replies, review, scoring
from boxloom.params import BoxService, RectangleService, ReviewPolicy


def parsed(one, rule, value):
    found = one(F.to_json(rule(F.lit(value).cast("string"))))[0]
    return found if found is None else json.loads(found)


@pytest.mark.parametrize(
    "value, any_json, first_object",
    [
        ('结果如下：[{"predictions": [{"result": []}]}]\n说明文字', [{"predictions": [{"result": []}]}], {"predictions": [{"result": []}]}),
        ("plain sentence", None, None),
        ("", None, None),
        (None, None, None),
        ("[1] and {\"a\": 2}", [1], {"a": 2}),
        ('[{"a": 1}, oops', {"a": 1}, {"a": 1}),
        ('{bad {"s": "}{", "n": [1]} tail', {"s": "}{", "n": [1]}, {"s": "}{", "n": [1]}),
        ('{"a": 1, "a": 2}', {"a": 2}, {"a": 2}),
        ('marker  {x {"a": 1}', {"a": 1}, {"a": 1}),
    ],
)
def test_first_json(one, value, any_json, first_object):
    assert parsed(one, text.first_json, value) == any_json
    assert parsed(one, text.first_object, value) == first_object
    assert parsed(one, text.first_object_or_json, value) == (first_object if first_object is not None else any_json)


def test_previews(one):
    shown = one(text.preview(F.lit(" a\n　 b ")), text.preview(F.lit("x" * 400)), text.clean_note(F.lit("**a**: b.")))
    assert shown == ("a b", "x" * 297 + "...", "a : b")


@pytest.mark.parametrize(
    "value, expected",
    [("true", True), ("false", False), ("null", False), ("0", False), ("1.5", True), ('""', False), ('"false"', True),
     ("[]", False), ("[0]", True), ("{}", False), ('{"a":1}', True)],
)
def test_truth(one, value, expected):
    assert one(truthy(F.try_parse_json(F.lit(value))))[0] is expected


def objects_of(one, payload, service, width=1000, height=500):
    args = [F.try_parse_json(F.lit(json.dumps(payload)))]
    if isinstance(service, RectangleService):
        found = detect.rectangle_objects(
            *args, F.lit("image.jpg"), F.lit(width), F.lit(height), service, F.lit(None).cast("int"), F.lit(None).cast("int")
        )
    else:
        found = detect.listed_objects(*args, service)
    result = one(F.to_json(found.getField("objects"), {"ignoreNullFields": "false"}), found.getField("n_bad"))
    return json.loads(result[0]), result[1]


def payload(*results, score=0.95):
    return [{"data": {"image": "image.jpg"}, "predictions": [{"model_version": "v1", "score": score, "result": list(results)}]}]


def rectangle(**more):
    value = {"rotation": 0, "x": 10.0, "y": 20.0, "width": 30.0, "height": 40.0, "rectanglelabels": ["Person"]}
    return {"id": "person_001", "type": "rectanglelabels", "value": value} | more


SERVICE = RectangleService(object_type_map={"Person": "person"}, object_id_prefix="person", model_name="m", model_version="v1")


def test_rectangles(one):
    found, bad = objects_of(one, payload(rectangle(), {"type": "choices"}, rectangle(id="自动生成的唯一ID")), SERVICE)
    assert bad == 0
    assert [o["object_id"] for o in found] == ["person_001", "person_000002"]
    first = found[0]
    assert first["box"] == {"format": "xyxy", "x1": 100, "y1": 100, "x2": 400, "y2": 300}
    assert first["object_type"] == "person" and first["geometry_model"]["confidence"] == 0.95
    params = first["geometry_detail"]["generation_params"]
    assert params["output_contract"] == "AutoLabelSample.objects[]" and params["source_result_id"] == "person_001"
    assert params["converted_xyxy_box"] == first["box"] and params["raw_response"] is None and len(params) == 15
    assert first["crop"]["crop_uri"] == "pending" and first["classification"]["multi_labels"] == []


def test_rectangle_scores_and_shapes(one):
    one_task = payload(rectangle(score=None), rectangle(score=0.5), rectangle(id=7), score=0.9)[0]
    found, _ = objects_of(one, one_task, SERVICE)
    assert [o["geometry_model"]["confidence"] for o in found] == [None, 0.5, 0.9]
    assert found[2]["object_id"] == "person_000003"
    for odd in ([], {}, [3], {"predictions": None}, {"predictions": [{"result": "x"}]}, "text"):
        assert objects_of(one, odd, SERVICE) == ([], 0)
    unlabeled, bad = objects_of(one, payload(rectangle(value={"x": 1, "y": 1, "width": 5, "height": "9"}), rectangle(value={})), SERVICE)
    assert bad == 1 and unlabeled[0]["geometry_detail"]["generation_params"]["target_label"] == "Person"


def test_boxes_and_objects(one):
    boxes = {"boxes": [{"label": "person", "bbox": [320, 180.9, "640", 920], "score": 0.92}, {"label": "", "bbox": [1, 2]}]}
    found, bad = objects_of(one, boxes, BoxService())
    assert bad == 1 and found[0]["object_id"] == "obj_000001" and found[0]["object_type"] == "person"
    assert found[0]["box"] == {"format": "xyxy", "x1": 320, "y1": 180, "x2": 640, "y2": 920}
    areas = {
        "objects": [
            {
                "object_type": "ground_area",
                "box": {"format": "xyxy", "x1": 10, "y1": 20, "x2": 300, "y2": 400},
                "polygon": [[10, 20], [300, 20], [300, 400]],
                "mask_uri": "mask.png",
                "mask_format": "png",
                "confidence": 0.88,
            }
        ]
    }
    found, _ = objects_of(one, areas, BoxService(response_format="objects", geometry_source="segmentation_model"))
    assert found[0]["geometry_detail"]["polygon"][2] == [300.0, 400.0] and found[0]["geometry_model"]["confidence"] == 0.88
    own = {"rows": [{"cls": "a", "xy": [1, 2, 3, 4], "p": 0.1}, {"cls": None, "xy": [1, 2, 3, 4]}]}
    service = BoxService(boxes_field="rows", label_field="cls", bbox_field="xy", confidence_field="p", object_type_map={"a": "b"})
    found, _ = objects_of(one, own, service)
    assert [(o["object_type"], o["geometry_model"]["confidence"]) for o in found] == [("b", 0.1), ("object", None)]


# --- review -----------------------------------------------------------------------------------------


def check(one, reply, policy):
    result = review.verdict(F.try_parse_json(F.lit(json.dumps(reply))))
    return one(review.quality_check(result, policy, "now"), review.drops_object(result, policy))


def test_quality_check(one):
    failed = {"contains_person": True, "is_complete_visible_person": False, "missing_parts": ["feet"], "reason": " cut "}
    quality, drop = check(one, failed, ReviewPolicy(drop_failed=True))
    assert quality["qc_status"] == "failed" and quality["issue_flags"] == ["incomplete_person_crop", "missing_feet"]
    assert quality["comment"] == "crop_full_person_review_v1: cut" and not drop
    assert check(one, failed, ReviewPolicy(drop_failed=True, drop_incomplete_person=True))[1]
    nobody = {"contains_person": False, "missing_parts": "x"}
    assert check(one, nobody, ReviewPolicy(drop_failed=True))[1] and not check(one, nobody, ReviewPolicy())[1]
    passed = {"contains_person": "false", "is_complete_visible_person": 1}
    assert check(one, passed, ReviewPolicy())[0] is None
    assert check(one, passed, ReviewPolicy(record_passed=True))[0]["comment"].endswith("crop review passed")


# --- answers ----------------------------------------------------------------------------------------


def test_labels(one):
    raw = {"hard_hat": True, "reflective_vest": False, "smoking": "true", "notes": {"reflective_vest": "not visible"}}
    labels = one(classify.labels_from_answers(F.try_parse_json(F.lit(json.dumps(raw)))))[0]
    assert [tuple(v) for v in labels] == [
        ("helmet", "wearing_helmet", None, "vlm classification"),
        ("reflective_vest", "no_reflective_vest", None, "not visible"),
    ]
    for useless in ('{"error": "x", "hard_hat": true}', "[1]", "null"):
        assert one(classify.labels_from_answers(F.try_parse_json(F.lit(useless))))[0] == []


def test_evidence_is_text_or_truth(one):
    """Notes of every kind: texts as they are, other values where they are true."""
    keys = ["hard_hat", "reflective_vest", "smoking", "safety_shoes", "fighting"]
    for notes, said in ((["t", "", "false", "0", " "], ["t", None, "false", "0", " "]), ([True, False, 0, 2, None], ["true", None, None, "2", None]), ([[], {}, [1], {"a": 1}, 0.0], [None, None, "[1]", '{"a":1}', None])):
        raw = dict.fromkeys(keys, True) | {"notes": dict(zip(keys, notes, strict=True))}
        labels = one(classify.labels_from_answers(F.try_parse_json(F.lit(json.dumps(raw)))))[0]
        found = {v.label_key: v.evidence for v in labels}
        names = {key: name for key, name, *_ in vocab.BOOLEAN_LABELS}
        assert [found[names[key]] for key in keys] == [x or vocab.DEFAULT_EVIDENCE for x in said]


def answers(one, value, fallback=False):
    read, ok = one(F.to_json(classify.read_answers(F.lit(value), fallback)), classify.answers_readable(F.lit(value), fallback))
    assert ok is (read is not None)
    return read and json.loads(read)


def test_normalized_answers(one):
    found = answers(one, '{"hard_hat": true, "smoking": null, "notes": {"smoking": "own"}, "extra": [1]}')
    assert found["hard_hat"] is True and found["safety_shoes"] is False and found["extra"] == [1]
    assert found["notes"]["smoking"] == "own" and "hard_hat" not in found["notes"] and "safety_shoes" in found["notes"]
    assert answers(one, '{"error": "no", "hard_hat": true}') == {"error": "no", "hard_hat": True}
    assert answers(one, "[1]") == {"error": "classification response is not a JSON object", "raw": [1]}
    assert answers(one, "smoking: true") is None


def test_prose_answers(one):
    prose = """Based on the visual analysis:
    1. **safety_harness**: No visible straps. (false)
    2. **hard_hat**: The person is wearing a hard hat. -> true
    3. **reflective_vest**: none. (false) my_smoking: true hard_hat: false, fighting untrue"""
    found = answers(one, prose, True)
    assert found["safety_harness"] is False and found["hard_hat"] is True and found["reflective_vest"] is True
    assert found["smoking"] is False and found["_parse_mode"] == "text_fallback"
    assert found["notes"]["fighting"] == "fallback parser did not find an explicit value"
    assert answers(one, "true, no key", True) is None and answers(one, "hard_hat untrue", True) is None
    long_text = "smoking " + "word " * 50_000 + "TRUE"
    assert answers(one, long_text, True)["smoking"] is True


def test_only_the_beginning_of_a_long_note_is_cleaned(spark):
    pieces = ["a", " ", "*_`", "#>-", ":;,.", "word: ", "\u3000\n\t", "b.c;", "\U0001f600"]
    texts = ["".join(pieces[(i * j + j // 3) % len(pieces)] for j in range(n)) for i in range(1, 9) for n in (0, 1, 7, 60, 90, 180, 400, 900)]
    texts += ["x" * n for n in (179, 180, 181, 359, 360, 361)] + [" " * 500 + "late", "*" * 900, "a" + "." * 900, "a" + "." * 900 + "z" * 300, "a" + " " * 900 + "z", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    whole = text.shorten(F.btrim(text.collapse(F.regexp_replace("t", "[*_`#>-]+", " ")), F.lit(" :;,.")), 180)
    found = rows.select("n", whole.alias("whole"), text.clean_note(F.col("t")).alias("note"))
    assert [row for row in found.collect() if row.whole != row.note] == []
    assert "substring(t" in found._jdf.queryExecution().optimizedPlan().toString()


# --- retries ----------------------------------------------------------------------------------------


def test_scoring_retries_only_failures(spark):
    requests = spark.range(20).withColumnRenamed("id", "sample_id")

    def make_model():
        def model(batch):
            ok = (batch["sample_id"] % 4 < batch["attempt"]) & (batch["sample_id"] % 4 != 3)
            return ok.map({True: '{"n": 1}', False: "sorry"})

        return model

    done, failed = scoring.score_with_retry(requests, make_model, "review", 3, partitions=3)
    assert {r.sample_id: r.attempt for r in done.collect()} == {i: i % 4 + 1 for i in range(20) if i % 4 < 3}
    assert sorted(r.sample_id for r in failed.collect()) == [3, 7, 11, 15, 19]


def test_a_model_that_raises_is_a_failed_attempt(spark):
    """One poisoned row fails alone; a flaky call succeeds when it is asked again."""
    requests = spark.range(20).withColumnRenamed("id", "sample_id")

    def make_model():
        def model(batch):
            if (batch["sample_id"] == 7).any():
                raise ConnectionError("no route " + "x" * 1000)
            if ((batch["sample_id"] == 3) & (batch["attempt"] < 3)).any():
                raise TimeoutError("late")
            if (batch["sample_id"] == 9).any():
                return ['{"n": 1}'] * (len(batch) + 1)
            return batch["sample_id"].map(lambda i: "sorry" if i == 11 else '{"n": 1}')

        return model

    once = {r.sample_id: r for r in scoring.score(requests.selectExpr("*", "1 AS attempt"), make_model, 2).collect()}
    assert len(once) == 20 and {i for i, r in once.items() if r.call_error} == {3, 7, 9} and once[3].raw_text is None
    assert len(once[7].call_error) == scoring.ERROR_CHARS and once[9].call_error.startswith("ValueError: 2 replies")
    done, failed = scoring.score_with_retry(requests, make_model, "review", 3, partitions=3)
    assert {r.sample_id: r.attempt for r in done.collect()} == {i: 3 if i == 3 else 1 for i in range(20) if i not in (7, 9, 11)}
    errors = {r.sample_id: (r.error_class, r.error_preview.split(":")[0]) for r in failed.collect()}
    assert errors[7] == (scoring.CALL_ERROR, "ConnectionError") and errors[9] == (scoring.CALL_ERROR, "ValueError") and errors[11][1] == "sorry" and len(errors) == 3


def test_first_parseable_and_attempts(spark):
    rows = [("a", 1, "x"), ("a", 2, '{"v": 2}'), ("a", 3, '{"v": 3}'), ("b", 4, '{"v": 4}'), ("b", 1, "x"), ("c", 1, '{"v": 1}')]
    table = replies.parse_replies(spark.createDataFrame(rows, "sample_id string, attempt int, raw_text string"), "detection")
    best = replies.first_parseable(table, ["sample_id"], 3)
    assert {r.sample_id: r.attempt for r in best.collect()} == {"a": 2, "b": None, "c": 1}
    stage = table.select("sample_id", "attempt", (F.col("parse_status") == "ok").alias("ok"))
    other = spark.createDataFrame([("a", 2, False), ("c", 1, True)], "sample_id string, attempt int, ok boolean")
    chosen = replies.choose_attempts([stage, other], 3)
    assert {r.sample_id: r.attempt for r in chosen.collect()} == {"a": 3, "b": None, "c": 1}


def test_attempts_of_any_stage(spark):
    """Without `first_needed`, samples that only later stages answered are decided too."""
    kind = "sample_id string, attempt int, ok boolean"
    first = spark.createDataFrame([("a", 1, False), ("b", 2, True)], kind)
    other = spark.createDataFrame([("a", 2, True), ("b", 1, True), ("c", 1, True), ("d", 1, False), ("e", 4, True)], kind)
    chosen = replies.choose_attempts([first, other], 3, first_needed=False)
    assert {r.sample_id: r.attempt for r in chosen.collect()} == {"a": 2, "b": 1, "c": 1, "d": None, "e": None}


def test_answers_are_normalized_once(spark):
    """Answers from prose are normal as they are, and the kind of a value is asked in one place for all keys."""
    texts = [
        "smoking: none (false). **Hard_Hat** -> true", "fighting true true hard_hat: FALSE hard_hat true", "smoking", "",
        '{"hard_hat": "true", "smoking": true, "extra": [1], "notes": {"hard_hat": 7, "other": null}}', '{"notes": 3, "fighting": null}',
        '{"error": "busy", "hard_hat": true}', "[1, true]", None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    prose = classify.prose_answers(F.col("t"))
    both = rows.select(F.to_json(prose).alias("a"), F.to_json(classify.normalize_answers(prose)).alias("b")).collect()
    assert all(r.a == r.b for r in both) and sum(r.a is not None for r in both) > 1
    read = rows.select(classify.read_answers(F.col("t"), True).alias("a"))
    found = [r.a and json.loads(r.a) for r in read.select(F.to_json("a").alias("a")).collect()]
    assert [f and (f.get("hard_hat"), f.get("smoking"), f.get("fighting")) for f in found] == [
        (True, False, False), (False, False, True), None, None, (False, True, False), (False, False, False), (True, None, None), (None, None, None), None
    ]
    assert found[4]["extra"] == [1] and found[4]["notes"]["hard_hat"] == 7 and found[4]["notes"]["other"] is None
    assert found[4]["notes"]["fighting"] == vocab.NOTE_MISSING_KEY and "smoking" not in found[4]["notes"]
    assert found[5]["notes"]["fighting"] == vocab.NOTE_NOT_BOOLEAN and found[5]["notes"]["smoking"] == vocab.NOTE_MISSING_KEY
    assert read._jdf.queryExecution().analyzed().toString().count("schema_of_variant") <= 4  # 16 before
