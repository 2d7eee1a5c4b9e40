"""Scenes: every order is an image with 0 to 3 detected objects, and model replies about them.

`k` is the order key and `p` the object's position. Spark builds the reply texts from these formulas and
runs the operators on the texts; the SQL works on the formulas directly and never parses anything.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.functions.columns import bind
from boxloom.operators import boxes, detect, replies, samples
from boxloom.operators.classify import classify_with_answers, read_answers
from boxloom.operators.review import verdict
from boxloom.operators.objects import PART_SIZE, whole_samples
from boxloom.params import BoxFilter, Classifier, RectangleService, ReviewPolicy, Run
from catalog.geometry import percent_fit
from catalog.inputs import Tables

RUN = Run(now="2026-05-08T10:00:00+08:00", now_utc="2026-05-08T02:00:00Z")
SERVICE = RectangleService(
    object_type_map={"Person": "person", "Vehicle": "vehicle"},
    default_object_type="object",
    object_id_prefix="person",
    model_name="m",
    model_version="v1",
)
SERVICES = {"ppe_person": SERVICE}
RULES = BoxFilter(min_confidence=0.1, min_width=40, min_height=50, min_area=3000, max_aspect_ratio=4.0)
POLICY = ReviewPolicy(drop_failed=True)
CLASSIFIER = Classifier(classifier_name="answers", classifier_version="1", text_fallback=True)
RATIO = 0.05

SCENE = {
    "k": "o_orderkey",
    "n": "CAST(o_orderkey % 4 AS INT)",
    "sample_id": "concat('sample_', o_orderkey)",
    "image_id": "concat('img_', o_orderkey)",
    "image_uri": "concat('raw', chr(92), 'img_', o_orderkey, '.jpg')",
    "source_type": "CASE o_orderkey % 5 WHEN 0 THEN 'generated' WHEN 1 THEN 'human_staged' WHEN 2 THEN 'cctv' WHEN 3 THEN 'robot_dog' ELSE 'manual_upload' END",
    "task_mode": "CASE WHEN o_orderkey % 11 = 0 THEN 'generation' WHEN o_orderkey % 11 = 1 THEN '' ELSE 'direct' END",
    "task_key": "CASE WHEN o_orderkey % 29 = 0 THEN 'elsewhere' ELSE '' END",
    "width": "CAST(640 + 80 * (o_orderkey % 17) AS INT)",
    "height": "CAST(480 + 60 * (o_orderkey % 13) AS INT)",
}
S = "(k * 31 + p * 17)"
OBJECT = {
    "s": S,
    "x": f"CAST({S} % 700 AS DOUBLE) / 10",
    "y": f"CAST({S} * 7 % 600 AS DOUBLE) / 10",
    "bw": f"CAST(5 + {S} % 25 AS DOUBLE)",
    "bh": f"CAST(5 + {S} * 3 % 35 AS DOUBLE)",
    "confidence": f"CASE WHEN {S} % 13 = 0 THEN NULL WHEN {S} % 13 = 1 THEN CAST(0.5 AS DOUBLE) ELSE CAST({S} % 100 AS DOUBLE) / 100 END",
    "label": f"CASE {S} % 4 WHEN 0 THEN 'Vehicle' WHEN 1 THEN 'Cart' ELSE 'Person' END",
    "source_id": f"CASE {S} % 5 WHEN 0 THEN 'unique_id' WHEN 1 THEN concat('r', {S}) END",
    "contains_person": f"{S} % 7 <> 0",
    "is_complete": f"{S} % 5 <> 0",
    "hard_hat": f"CASE WHEN {S} % 3 < 2 THEN {S} % 3 = 0 END",
    "smoking": f"{S} % 4 = 1",
}
# attempts 1..3; the first fails for some scenes, all of them for a few
BAD_DETECTION = "(k % 17 = 0 AND attempt = 1) OR k % 101 = 0"
BAD_REVIEW = f"({S} % 23 = 0 AND attempt < 3)"
BAD_ANSWER = f"({S} % 37 = 0 AND attempt = 2)"

def _of_object(text: str, p: int) -> str:
    """A formula for the object at position `p`; written out for each position, it is compiled, inside a lambda it is not."""
    return re.sub(r"\bp\b", str(p), text)


def _entry(p: int) -> str:
    s, x, y, bw, bh, label, source_id = (_of_object(OBJECT[name], p) for name in ("s", "x", "y", "bw", "bh", "label", "source_id"))
    return f"""concat('{{"id": ', coalesce(concat('"', {source_id}, '"'), '7'), ', "type": "rectanglelabels", ',
  CASE WHEN {s} % 13 = 0 THEN '"score": null, ' WHEN {s} % 13 = 1 THEN ''
    ELSE concat('"score": ', CAST({s} % 100 AS DOUBLE) / 100, ', ') END,
  '"value": {{"x": ', {x}, ', "y": ', {y}, ', "width": ', {bw}, ', "height": ', {bh},
  ', "rectanglelabels": ["', {label}, '"]}}}}')"""


# a choice to ignore in front, an unreadable rectangle in the middle, and two predictions; scenes have 0 to 3 objects
DETECTION_TEXT = f"""concat('Result: [{{"data": {{"image": "a.jpg"}}, "predictions": [{{"score": 0.5, "result": [{{"type": "choices", "id": "c"}}',
  CASE WHEN k % 6 = 0 THEN ', {{"type": "rectanglelabels", "value": {{"x": 1}}}}' ELSE '' END,
  CASE WHEN n > 0 THEN concat(', ', {_entry(0)}) ELSE '' END, CASE WHEN n > 1 THEN concat(', ', {_entry(1)}) ELSE '' END,
  ']}}, {{"score": 0.5, "result": [', CASE WHEN n > 2 THEN {_entry(2)} ELSE '' END, ']}}]}}] end')"""
REVIEW_TEXT = f"""concat('{{"contains_person": ', {S} % 7 <> 0, ', "is_complete_visible_person": ', {S} % 5 <> 0,
  ', "missing_parts": ', CASE WHEN {S} % 2 = 0 THEN '["feet", "hand"]' ELSE '[]' END, ', "reason": " r', {S} % 3, ' "}}')"""
ANSWER_TEXT = f"""CASE WHEN {S} % 3 < 2 THEN concat('{{"hard_hat": ', {S} % 3 = 0, ', "smoking": ', CASE WHEN {S} % 4 = 1
  THEN '"true"' ELSE 'false' END, ', "notes": {{"smoking": "n', {S} % 9, '"}}}}')
  ELSE concat('smoking: (', {S} % 4 = 1, ')') END"""


SCENE_SQL = f"SELECT {', '.join(f'{v} AS {c}' for c, v in SCENE.items())} FROM orders"
OBJECT_SQL = f"""SELECT *, {", ".join(f"{v} AS {c}" for c, v in OBJECT.items())}
  FROM (SELECT *, CAST(unnest(range(n)) AS INT) AS p FROM ({SCENE_SQL}) WHERE n > 0)"""
BOX_SQL = f"SELECT *, {percent_fit()} FROM ({OBJECT_SQL})"
KIND_SQL = "CASE label WHEN 'Person' THEN 'person' WHEN 'Vehicle' THEN 'vehicle' ELSE 'object' END"
ID_SQL = "CASE WHEN source_id LIKE 'r%' THEN source_id ELSE concat('person_', lpad(CAST(p + 1 AS VARCHAR), 6, '0')) END"
REASON_SQL = """CASE WHEN confidence < 0.1 THEN 'low_confidence' WHEN x2 - x1 < 40 OR y2 - y1 < 50
  OR (x2 - x1) * (y2 - y1) < 3000 THEN 'tiny_box' WHEN greatest(CAST(x2 - x1 AS DOUBLE) / (y2 - y1),
  CAST(y2 - y1 AS DOUBLE) / (x2 - x1)) > 4 THEN 'extreme_aspect_ratio' END"""
NAMED_SQL = f"SELECT *, {KIND_SQL} AS object_type, {ID_SQL} AS object_id, {REASON_SQL} AS reason FROM ({BOX_SQL})"
KEPT_SQL = f"SELECT * FROM ({NAMED_SQL}) WHERE reason IS NULL"
# what review leaves of an object: target objects without a person go
REVIEWED_SQL = f"""SELECT *, object_type = 'person' AND NOT contains_person AS gone,
  CASE WHEN object_type = 'person' AND NOT (contains_person AND is_complete) THEN 'failed' END AS qc_status,
  CASE WHEN object_type = 'person' AND NOT (contains_person AND is_complete)
    THEN concat('incomplete_person_crop', CASE WHEN s % 2 = 0 THEN ',missing_feet,missing_hand' ELSE '' END) END AS flags,
  CASE WHEN object_type = 'person' AND NOT (contains_person AND is_complete)
    THEN concat('crop_full_person_review_v1: r', s % 3) END AS comment FROM ({KEPT_SQL})"""


def scenes(t: Tables) -> DataFrame:
    return t.derive("orders", SCENE)


def scene_objects(t: Tables) -> DataFrame:
    rows = scenes(t).filter("n > 0").selectExpr("*", "explode(sequence(0, n - 1)) AS p")
    return rows.selectExpr("*", *[f"{v} AS {c}" for c, v in OBJECT.items()])


def detection_replies(t: Tables, attempts: int = 1) -> DataFrame:
    rows = scenes(t).selectExpr("k", "n", "sample_id", f"explode(sequence(1, {attempts})) AS attempt")
    text = f"CASE WHEN {BAD_DETECTION} THEN 'not now {{' ELSE {DETECTION_TEXT} END" if attempts > 1 else DETECTION_TEXT
    return rows.selectExpr(
        "sample_id", "attempt", f"{text} AS raw_text", "CAST(NULL AS INT) AS request_width", "CAST(NULL AS INT) AS request_height"
    )


def _object_replies(t: Tables, text: str, bad: str, attempts: int) -> DataFrame:
    rows = scene_objects(t).selectExpr("k", "p", "sample_id", f"explode(sequence(1, {attempts})) AS attempt")
    text = f"CASE WHEN {bad} THEN 'not now {{' ELSE {text} END" if attempts > 1 else text
    return rows.selectExpr("sample_id", "p AS pos", "attempt", f"{text} AS raw_text")


def review_replies(t: Tables, attempts: int = 1) -> DataFrame:
    return _object_replies(t, REVIEW_TEXT, BAD_REVIEW, attempts)


def answer_replies(t: Tables, attempts: int = 1) -> DataFrame:
    return _object_replies(t, ANSWER_TEXT, BAD_ANSWER, attempts)


def verdicts(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(review_replies(t), "review")
    return bind(parsed.select("sample_id", "pos", "payload"), {"verdict": verdict(F.col("payload"))}).drop("payload")


def answers(t: Tables) -> DataFrame:
    read = bind(answer_replies(t), {"answers": read_answers(F.col("raw_text"), True)})
    return read.select("sample_id", "pos", "answers")


def detected(t: Tables, part_size: int = PART_SIZE) -> DataFrame:
    """Samples with the objects their detection replies name."""
    rows = scenes(t).withColumn("task_key", F.lit("ppe_person"))
    base = samples.base_samples(rows, RUN, keep=("task_key", "k"))
    payloads = replies.parse_replies(detection_replies(t), "detection")
    return detect.detect(base, payloads, SERVICES, part_size)


def cropped(t: Tables, part_size: int = PART_SIZE) -> DataFrame:
    """Detected samples after the box filter, with crop metadata."""
    kept = boxes.filter_boxes(detected(t, part_size), RULES).drop("task_key", "n_bad")
    return samples.advance(boxes.attach_crops(kept, "crops", RATIO), "cropped", RUN.now)


def classified(t: Tables, part_size: int = PART_SIZE) -> DataFrame:
    """Cropped scenes with answers applied, every 31st sample discarded afterwards."""
    done = classify_with_answers(cropped(t, part_size), answers(t), CLASSIFIER, ("generated",), RUN, part_size)
    discarded = F.col("workflow").withField("workflow_status", F.lit("discarded"))
    return done.withColumn("workflow", F.when(F.col("k") % 31 == 0, discarded).otherwise(F.col("workflow"))).drop("k")


def in_parts(t: Tables) -> DataFrame:
    """The classified scenes, worked on in parts of two objects and joined again."""
    return whole_samples(classified(t, part_size=2))


def object_rows(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select("sample_id", *more, F.explode("objects").alias("o"))

