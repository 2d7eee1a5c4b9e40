"""Detection, box filter, review and classification on scenes and document answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions.columns import bind, lookup
from boxloom.operators import boxes, classify, detect, objects, replies, review, samples, scoring
from boxloom.params import BoxService, CropGuard, Classifier, RectangleService, ReviewPolicy
from catalog import scenes as sc
from catalog.inputs import Tables, with_inputs
from catalog.registry import query
from catalog.replies import ordinal_detections

# --- detection replies ------------------------------------------------------------------------------


@query(
    "d1_rectangle_payload",
    f"""SELECT sample_id, p AS pos, object_id, object_type, confidence, x1, y1, x2, y2,
    'labelstudio_percent_xywh' AS unit, label, image_uri, width AS request_width FROM ({sc.NAMED_SQL})""",
)
def d1(t: Tables) -> DataFrame:
    params = "o.geometry_detail.generation_params"
    return sc.object_rows(sc.detected(t)).select(
        "sample_id",
        "o.pos",
        "o.object_id",
        "o.object_type",
        "o.geometry_model.confidence",
        "o.box.x1",
        "o.box.y1",
        "o.box.x2",
        "o.box.y2",
        F.try_variant_get(params, "$.coordinate_unit", "string").alias("unit"),
        F.try_variant_get(params, "$.target_label", "string").alias("label"),
        F.try_variant_get(params, "$.source_image_uri", "string").alias("image_uri"),
        F.try_variant_get(params, "$.request_image_width", "int").alias("request_width"),
    )


@query(
    "d1_unreadable_results",
    f"SELECT sample_id, n AS n_objects, CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS n_bad FROM ({sc.SCENE_SQL})",
)
def d1_bad(t: Tables) -> DataFrame:
    return sc.detected(t).select("sample_id", F.size("objects").alias("n_objects"), "n_bad")


@query(
    "p7_new_object",
    f"""SELECT sample_id, object_id, concat(object_id, '_crop') AS crop_id, 'pending' AS crop_uri, false AS is_valid_crop,
    'vlm' AS classifier_type, 0 AS n_labels, 'detector' AS geometry_source, 'm' AS model_name FROM ({sc.NAMED_SQL})""",
)
def p7(t: Tables) -> DataFrame:
    return sc.object_rows(sc.detected(t)).select(
        "sample_id",
        "o.object_id",
        "o.crop.crop_id",
        "o.crop.crop_uri",
        "o.crop.is_valid_crop",
        "o.classification.classifier_type",
        F.size("o.classification.multi_labels").alias("n_labels"),
        "o.geometry_source",
        "o.geometry_model.model_name",
    )


@query(
    "p13_rectangle_results",
    f"SELECT sample_id, n + CASE WHEN k % 6 = 0 THEN 1 ELSE 0 END AS n_results FROM ({sc.SCENE_SQL})",
)
def p13(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(sc.detection_replies(t), "detection")
    return parsed.select("sample_id", F.size(detect.rectangle_results(F.col("payload"))).alias("n_results"))


# one boxes reply per line: a list box, a box object with its own type and id, and an unreadable entry
LINE = """concat(CASE WHEN l_linenumber % 2 = 0 THEN '{"boxes": [' ELSE '{"found": [' END,
  '{"label": "', CASE l_returnflag WHEN 'N' THEN 'person' WHEN 'A' THEN 'leak' ELSE '' END, '", "bbox": [', l_quantity, ', ',
  l_suppkey % 50, ', ', l_quantity + 10.75, ', "', l_suppkey % 50 + 7, '"], "score": ', l_discount, '}, ',
  '{"object_type": "pipe", "object_id": "q', l_partkey, '", "box": {"x1": 1, "y1": 2, "x2": ', l_linenumber,
  ', "y2": 9}, "confidence": null, "score": 0.4, "polygon": [[1, 2], [3, ', l_linenumber, ']], "mask_format": "png"}, ',
  '{"label": "x", "bbox": [1, 2, 3]}]}')"""
LINE_INPUT = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "raw_text": LINE,
}
BOXES = BoxService(object_type_map={"leak": "leakage_area"})
FOUND = BoxService(response_format="objects", objects_field="found", object_type_map={"leak": "leakage_area"})


@query(
    "d2_box_payload",
    """SELECT l_orderkey, l_linenumber, l_partkey, 0 AS pos, 'obj_000001' AS object_id,
      CASE l_returnflag WHEN 'N' THEN 'person' WHEN 'A' THEN 'leakage_area' ELSE 'object' END AS object_type,
      CAST(floor(l_quantity) AS INT) AS x1, CAST(l_suppkey % 50 AS INT) AS y1, CAST(floor(l_quantity + 10.75) AS INT) AS x2,
      CAST(l_suppkey % 50 + 7 AS INT) AS y2, l_discount AS confidence, CAST(NULL AS DOUBLE) AS polygon_end,
      CAST(NULL AS VARCHAR) AS mask_format FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, 1, concat('q', l_partkey), 'pipe', 1, 2, l_linenumber, 9,
      CAST(NULL AS DOUBLE), CAST(l_linenumber AS DOUBLE), 'png' FROM lineitem""",
)
def d2(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(t.derive("lineitem", LINE_INPUT), "detection")
    found = F.when(F.col("l_linenumber") % 2 == 0, detect.listed_objects(F.col("payload"), BOXES)).otherwise(
        detect.listed_objects(F.col("payload"), FOUND)
    )
    rows = bind(parsed, {"found": found}).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.explode("found.objects").alias("o")
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "o.pos",
        "o.object_id",
        "o.object_type",
        "o.box.x1",
        "o.box.y1",
        "o.box.x2",
        "o.box.y2",
        F.col("o.geometry_model.confidence").alias("confidence"),
        F.element_at(F.element_at("o.geometry_detail.polygon", 2), 2).alias("polygon_end"),
        F.col("o.geometry_detail.mask_format").alias("mask_format"),
    )


RAW_BOX = """CASE l_linenumber % 4 WHEN 0 THEN concat('[', l_quantity, ', -', l_suppkey, '.9, 30, "', l_partkey, '"]')
  WHEN 1 THEN concat('{"y2": ', l_partkey, ', "x1": ', l_quantity, ', "y1": -', l_suppkey, '.9, "x2": 30}')
  WHEN 2 THEN '[1, 2, 3]' ELSE '{"x1": 1, "y1": 2, "x2": 3}' END"""


@query(
    "g11_box_coercion",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 4 < 2 THEN CAST(floor(l_quantity) AS INT) END AS x1,
    CASE WHEN l_linenumber % 4 < 2 THEN CAST(-l_suppkey AS INT) END AS y1, CASE WHEN l_linenumber % 4 < 2 THEN 30 END AS x2,
    CASE WHEN l_linenumber % 4 < 2 THEN CAST(l_partkey AS INT) END AS y2 FROM lineitem""",
)
def g11(t: Tables) -> DataFrame:
    rows = t.derive("lineitem", LINE_INPUT | {"raw_text": RAW_BOX})
    box = detect.coerce_box(F.try_parse_json("raw_text"))
    return rows.withColumn("b", box).select(
        "l_orderkey", "l_linenumber", "l_partkey", "b.x1", "b.y1", "b.x2", "b.y2"
    )


@query(
    "d3_parse_policy",
    with_inputs(
        """SELECT event_id, event_type <> 'error' AS kept_when_failing, true AS kept_when_emptying FROM fx_responses""",
        "fx_responses",
    ),
)
def d3(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(t.responses, "detection")
    readable = F.col("parse_status") == "ok"
    # under `empty` an unreadable reply is an image without objects, under `fail` a failed attempt
    n = F.size(detect.rectangle_objects(
        F.col("payload"), F.lit("a.jpg"), F.lit(100), F.lit(100), RectangleService(), F.lit(None).cast("int"),
        F.lit(None).cast("int")
    ).getField("objects"))
    return parsed.select(
        "event_id", readable.alias("kept_when_failing"), (F.coalesce(n, F.lit(0)) == 0).alias("kept_when_emptying")
    )


@query(
    "j3_object_types",
    with_inputs(
        """SELECT sample_id, line, label, CASE label WHEN 'Person' THEN 'person' WHEN 'Vehicle' THEN 'car' ELSE 'other' END AS mapped
        FROM fx_boxes""",
        "fx_boxes",
    ),
)
def j3(t: Tables) -> DataFrame:
    mapped = F.coalesce(lookup({"Person": "person", "Vehicle": "car"}, F.col("label")), F.lit("other"))
    return t.boxes.select("sample_id", "line", "label", mapped.alias("mapped"))


# --- samples with flat detections -------------------------------------------------------------------


def nested(t: Tables) -> DataFrame:
    """All manifest samples with all their flat detections."""
    base = samples.base_samples(t.manifest, sc.RUN)

    def build(row) -> object:
        box = F.struct(
            F.lit("xyxy").alias("format"),
            F.floor(row["x"]).cast("int").alias("x1"),
            row["y"].cast("int").alias("y1"),
            (F.floor(row["x"]) + row["bw"]).cast("int").alias("x2"),
            (row["y"] + F.rint(row["bh"])).cast("int").alias("y2"),
        )
        return objects.make_object(
            row["pos"],
            objects.generated_id("person", row["pos"]),
            row["label"],
            box,
            F.lit("detector"),
            confidence=row["confidence"],
        )

    return objects.nest_objects(base, ordinal_detections(t), build)


@query(
    "j2_samples_with_detections",
    with_inputs(
        """SELECT m.sample_id, count(d.pos) AS n_objects, sum(d.pos) AS pos_sum FROM fx_manifest m
        LEFT JOIN fx_detections d ON m.sample_id = d.sample_id GROUP BY m.sample_id""",
        "fx_manifest",
        "fx_detections",
    ).replace("sum(d.pos)", "CAST(sum(d.pos) AS BIGINT)"),
)
def j2(t: Tables) -> DataFrame:
    total = F.aggregate("objects", F.lit(0).cast("bigint"), lambda acc, o: acc + o["pos"])
    return nested(t).select(
        "sample_id",
        F.size("objects").cast("bigint").alias("n_objects"),
        F.when(F.size("objects") > 0, total).alias("pos_sum"),
    )


@query(
    "a6_nested_objects",
    with_inputs(
        """SELECT sample_id, string_agg(concat(pos, ':', label), ',' ORDER BY pos) AS listed FROM fx_detections
        WHERE sample_id IN (SELECT sample_id FROM fx_manifest) GROUP BY sample_id""",
        "fx_manifest",
        "fx_detections",
    ),
)
def a6(t: Tables) -> DataFrame:
    texts = F.transform("objects", lambda o: F.concat(o["pos"], F.lit(":"), o["object_type"]))
    rows = nested(t).filter(F.size("objects") > 0)
    return rows.select("sample_id", F.array_join(texts, ",").alias("listed"))


A1_REASON = """CASE WHEN confidence < 0.05 THEN 'low_confidence' WHEN w <= 0 OR h <= 0 THEN 'invalid_box'
  WHEN w < 12 OR h < 24 OR w * h < 300 THEN 'tiny_box'
  WHEN greatest(CAST(w AS DOUBLE) / h, CAST(h AS DOUBLE) / w) > 8 THEN 'extreme_aspect_ratio' END"""


@query(
    "a1_dropped_boxes",
    with_inputs(
        f"""SELECT sample_id, drop_reason, count(*) AS n FROM (SELECT sample_id, {A1_REASON} AS drop_reason FROM (
        SELECT sample_id, confidence, CAST(bw AS INT) AS w, CAST(round_even(bh, 0) AS INT) AS h FROM fx_detections
        WHERE sample_id IN (SELECT sample_id FROM fx_manifest))) WHERE drop_reason IS NOT NULL GROUP BY ALL""",
        "fx_manifest",
        "fx_detections",
    ),
)
def a1(t: Tables) -> DataFrame:
    from catalog.geometry import SHIPPED

    return boxes.dropped_boxes(nested(t), SHIPPED)


# --- box filter and crops on scenes -----------------------------------------------------------------


@query(
    "p8_filtered_scenes",
    f"SELECT sample_id, p AS pos, object_id, x1, y1, x2, y2 FROM ({sc.KEPT_SQL})",
)
def p8_scenes(t: Tables) -> DataFrame:
    rows = sc.object_rows(boxes.filter_boxes(sc.detected(t), sc.RULES))
    return rows.select("sample_id", "o.pos", "o.object_id", "o.box.x1", "o.box.y1", "o.box.x2", "o.box.y2")


@query(
    "a1_dropped_by_reason",
    f"SELECT reason AS drop_reason, count(*) AS n FROM ({sc.NAMED_SQL}) WHERE reason IS NOT NULL GROUP BY reason",
)
def a1_reasons(t: Tables) -> DataFrame:
    dropped = boxes.dropped_boxes(sc.detected(t), sc.RULES)
    return dropped.groupBy("drop_reason").agg(F.sum("n").alias("n"))


# --- review -----------------------------------------------------------------------------------------

SEEN = """CASE event_type WHEN 'view' THEN value > 20 WHEN 'purchase' THEN false ELSE true END"""
WHOLE = """CASE event_type WHEN 'view' THEN true WHEN 'signup' THEN true ELSE false END"""
REASON = "CASE WHEN event_type = 'click' THEN 'cut' ELSE 'crop review passed' END"


@query(
    "v1_quality_check",
    with_inputs(
        f"""SELECT event_id, CASE WHEN seen AND whole THEN 'passed' ELSE 'failed' END AS qc_status,
        CASE WHEN seen AND whole THEN '' ELSE concat('incomplete_person_crop', CASE WHEN event_type = 'click'
          THEN ',missing_feet' ELSE '' END) END AS flags, concat('crop_full_person_review_v1: ', {REASON}) AS comment,
        CASE WHEN NOT (seen AND whole) THEN 'failed' END AS unrecorded_pass
        FROM (SELECT *, {SEEN} AS seen, {WHOLE} AS whole FROM fx_responses WHERE event_type <> 'error')""",
        "fx_responses",
    ),
)
def v1(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(t.responses, "review").filter("parse_status = 'ok'")
    result = F.col("verdict")
    recorded = review.quality_check(result, ReviewPolicy(record_passed=True), sc.RUN.now)
    return (
        parsed.select("event_id", review.verdict(F.col("payload")).alias("verdict"))
        .select("event_id", recorded.alias("c"), review.quality_check(result, ReviewPolicy(), sc.RUN.now).alias("u"))
        .select(
            "event_id",
            "c.qc_status",
            F.array_join("c.issue_flags", ",").alias("flags"),
            "c.comment",
            F.col("u.qc_status").alias("unrecorded_pass"),
        )
    )


@query(
    "p12_drop_rule",
    with_inputs(
        f"""SELECT event_id, false AS off, NOT seen AS no_person, NOT (seen AND whole) AS or_incomplete
        FROM (SELECT *, {SEEN} AS seen, {WHOLE} AS whole FROM fx_responses WHERE event_type <> 'error')""",
        "fx_responses",
    ),
)
def p12(t: Tables) -> DataFrame:
    parsed = replies.parse_replies(t.responses, "review").filter("parse_status = 'ok'")
    result = F.col("verdict")
    strict = ReviewPolicy(drop_failed=True, drop_incomplete_person=True)
    return parsed.select("event_id", review.verdict(F.col("payload")).alias("verdict")).select(
        "event_id",
        review.drops_object(result, ReviewPolicy()).alias("off"),
        review.drops_object(result, ReviewPolicy(drop_failed=True)).alias("no_person"),
        review.drops_object(result, strict).alias("or_incomplete"),
    )


@query(
    "p11_review_targets",
    f"SELECT sample_id, p AS pos, object_type = 'person' AS is_target FROM ({sc.KEPT_SQL})",
)
def p11(t: Tables) -> DataFrame:
    rows = sc.object_rows(sc.cropped(t))
    return rows.select("sample_id", "o.pos", review.is_review_target(F.col("o"), sc.POLICY).alias("is_target"))


@query(
    "v2_reviewed_objects",
    f"SELECT sample_id, p AS pos, object_id, qc_status, flags, comment FROM ({sc.REVIEWED_SQL}) WHERE NOT gone",
)
def v2(t: Tables) -> DataFrame:
    rows = sc.object_rows(review.review(sc.cropped(t), sc.verdicts(t), sc.POLICY, sc.RUN.now))
    return rows.select(
        "sample_id",
        "o.pos",
        "o.object_id",
        "o.quality_check.qc_status",
        F.array_join("o.quality_check.issue_flags", ",").alias("flags"),
        "o.quality_check.comment",
    )


@query(
    "j6_review_join",
    f"""SELECT sample_id, p AS pos, contains_person, is_complete, concat('r', s % 3) AS reason FROM ({sc.KEPT_SQL})""",
)
def j6(t: Tables) -> DataFrame:
    aligned = replies.align(sc.cropped(t), sc.verdicts(t), "verdict")
    rows = aligned.select(
        "sample_id",
        F.explode(F.transform("objects", lambda o: F.struct(o["pos"].alias("pos"), replies.at_position(F.col("verdict"), o).alias("v")))).alias("r"),
    )
    return rows.select("sample_id", "r.pos", "r.v.contains_person", "r.v.is_complete", "r.v.reason")


@query(
    "a2_review_dropped",
    f"SELECT sample_id, count(*) AS n_dropped FROM ({sc.REVIEWED_SQL}) WHERE gone GROUP BY sample_id",
)
def a2(t: Tables) -> DataFrame:
    reviewed = review.review(sc.cropped(t), sc.verdicts(t), sc.POLICY, sc.RUN.now)
    counts = reviewed.groupBy("sample_id").agg(F.sum("review_dropped").alias("n_dropped"))
    return counts.filter("n_dropped > 0")


# --- answers ----------------------------------------------------------------------------------------

LABELLED = "documents d JOIN labels l ON d.doc_id = l.doc_id"


def json_answers(t: Tables) -> DataFrame:
    """All replies read as JSON; documents without labels reply in prose, which is none (null)."""
    return t.answers.select("doc_id", "raw_text", F.try_parse_json("raw_text").alias("raw"))


@query(
    "k1_boolean_labels",
    f"""SELECT d.doc_id, 'helmet' AS label_key, CASE WHEN l.quality = 1 THEN 'wearing_helmet' ELSE 'no_helmet' END AS label_value,
    'vlm classification' AS evidence FROM {LABELLED}
    UNION ALL SELECT d.doc_id, 'smoking', 'not_smoking', concat('n', d.doc_id % 7) FROM {LABELLED} WHERE l.toxic <> 1""",
)
def k1(t: Tables) -> DataFrame:
    labels = F.explode(classify.labels_from_answers(F.col("raw"))).alias("l")
    return json_answers(t).select("doc_id", labels).select("doc_id", "l.label_key", "l.label_value", "l.evidence")


ANSWER_ROWS = ", ".join(f"('{key}')" for key in vocab.ANSWER_KEYS)
NORMALIZED = f"""SELECT d.doc_id, k.key, CASE WHEN k.key = 'hard_hat' THEN l.quality = 1 ELSE false END AS answer,
  CASE WHEN k.key = 'hard_hat' THEN NULL WHEN k.key = 'smoking' THEN concat('n', d.doc_id % 7)
  ELSE '{vocab.NOTE_MISSING_KEY}' END AS note FROM {LABELLED} CROSS JOIN (VALUES {ANSWER_ROWS}) k(key)"""


@query("k2_normalized_answers", NORMALIZED)
def k2(t: Tables) -> DataFrame:
    """Twelve answers of every reply that is JSON; `k2_replies_without_answers` shows what becomes of others."""
    rows = json_answers(t).filter("raw IS NOT NULL").select("doc_id", classify.normalize_answers(F.col("raw")).alias("a"))
    keys = F.array(*[F.lit(key) for key in vocab.ANSWER_KEYS])
    members = F.try_variant_get("a", "$", "map<string,variant>")
    notes = F.try_variant_get("a", "$.notes", "map<string,string>")
    return rows.select("doc_id", members.alias("m"), notes.alias("n"), F.explode(keys).alias("key")).select(
        "doc_id",
        "key",
        F.try_variant_get(F.try_element_at("m", F.col("key")), "$", "boolean").alias("answer"),
        F.try_element_at("n", F.col("key")).alias("note"),
    )


@query(
    "k2_replies_without_answers",
    f"""SELECT d.doc_id, CASE WHEN d.doc_id % 4 = 1 THEN '{vocab.NOT_AN_OBJECT}' WHEN d.doc_id % 4 = 2 THEN 'busy' END AS error,
    CASE WHEN d.doc_id % 4 = 1 THEN concat('[', d.doc_id, ',true]') END AS raw,
    CASE WHEN d.doc_id % 4 IN (1, 2) THEN 0 WHEN l.doc_id IS NULL THEN NULL ELSE {len(vocab.ANSWER_KEYS)} END AS n_answers
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def k2_others(t: Tables) -> DataFrame:
    """Replies that are no object become an error with the reply, replies with an error stay as they are, prose is null."""
    text = F.expr("CASE doc_id % 4 WHEN 1 THEN concat('[', doc_id, ', true]') WHEN 2 THEN '{\"error\": \"busy\", \"hard_hat\": 1}' ELSE raw_text END")
    rows = t.answers.select("doc_id", classify.normalize_answers(F.try_parse_json(text)).alias("a"))
    members = F.try_variant_get("a", "$", "map<string,variant>")
    keys = F.array(*[F.lit(key) for key in vocab.ANSWER_KEYS])
    booleans = F.size(F.filter(keys, lambda key: F.schema_of_variant(F.try_element_at(members, key)) == "BOOLEAN"))
    return rows.select(
        "doc_id", F.try_variant_get("a", "$.error", "string").alias("error"), F.to_json(F.try_element_at(members, F.lit("raw"))).alias("raw"),
        F.when(members.isNotNull(), booleans).alias("n_answers"),
    )


# whole document texts around the mentions; their own true/false words are blanked out first
QUIET = "regexp_replace(text, '(?i)true|false', '-'{flag})"
PROSE = """concat(quiet, ' **smoking**: none seen (false). Hard_Hat again: true then False ', quiet,
  ' xhard_hat: true; hard_hat: TRUE fighting ', quiet, ' SMOKING true')"""


def prose(flag: str) -> str:
    return f"SELECT doc_id, quiet, {PROSE} AS raw_text FROM (SELECT doc_id, {QUIET.format(flag=flag)} AS quiet FROM documents)"


@query(
    "k3_prose_answers",
    f"""SELECT doc_id, hat.v AS hard_hat, false AS smoking, false AS fighting,
      CASE WHEN length(hat.note) > 180 THEN concat(rtrim(left(hat.note, 177)), '...') ELSE hat.note END AS hat_note,
      'smoking : none seen (false)' AS smoking_note, 'fallback parser did not find an explicit value' AS fighting_note
    FROM (SELECT doc_id, {{'v': true, 'note': trim(regexp_replace(regexp_replace(concat('Hard_Hat again: true then False ',
      quiet, ' xhard_hat: true; '), '[*_`#>-]+', ' ', 'g'), '{r"[\s\x0b\x1c-\x1f\x85\p{Z}]+"}', ' ', 'g'), ' :;,.')}} AS hat
      FROM ({prose(", 'g'")}))""",
)
def k3(t: Tables) -> DataFrame:
    rows = t.read("documents").selectExpr("doc_id", f"{QUIET.format(flag='')} AS quiet")
    read = classify.prose_answers(F.col("raw_text"))
    out = rows.selectExpr("doc_id", f"{PROSE} AS raw_text").select("doc_id", read.alias("a"))
    flags = [F.try_variant_get("a", f"$.{key}", "boolean").alias(key) for key in ("hard_hat", "smoking", "fighting")]
    notes = [
        F.try_variant_get("a", f"$.notes.{key}", "string").alias(name)
        for key, name in (("hard_hat", "hat_note"), ("smoking", "smoking_note"), ("fighting", "fighting_note"))
    ]
    return out.select("doc_id", *flags, *notes)


@query(
    "k4_classification_record",
    f"""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'text_fallback' ELSE 'json' END AS mode, 'vlm' AS classifier_type,
    'm' AS classifier_name, CAST(NULL AS VARCHAR) AS classifier_version, 'crop_industrial_safety_v2' AS prompt_version,
    12 AS n_labels FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def k4(t: Tables) -> DataFrame:
    read = classify.read_answers(F.col("raw_text"), text_fallback=True)
    record = classify.classification_struct(F.col("answers"), Classifier(model="m"))
    return (
        t.answers.select("doc_id", read.alias("answers"))
        .select("doc_id", record.alias("c"))
        .select(
            "doc_id",
            F.coalesce(F.try_variant_get("c.raw_response", "$._parse_mode", "string"), F.lit("json")).alias("mode"),
            "c.classifier_type",
            "c.classifier_name",
            "c.classifier_version",
            "c.prompt_version",
            F.size("c.multi_labels").alias("n_labels"),
        )
    )


@query(
    "j4_answer_labels",
    f"""SELECT d.doc_id, m.label_key, CASE WHEN m.key = 'hard_hat' AND l.quality = 1 THEN m.yes ELSE m.no END AS label_value
    FROM {LABELLED} CROSS JOIN (VALUES {", ".join(str(row) for row in vocab.BOOLEAN_LABELS)}) m(key, label_key, yes, no)""",
)
def j4(t: Tables) -> DataFrame:
    """All twelve answers of a normalized reply through the answer-to-label map."""
    labels = classify.labels_from_answers(classify.normalize_answers(F.col("raw")))
    rows = json_answers(t).select("doc_id", F.explode(labels).alias("l"))
    return rows.select("doc_id", "l.label_key", "l.label_value")


# --- classification on scenes -----------------------------------------------------------------------

# a guard strict enough to reject some of the crops
GUARD = CropGuard(min_width=60, min_height=60, max_aspect_ratio=2.5)
STRICT = Classifier(classifier_name="answers", classifier_version="1", text_fallback=True, crop_guard=GUARD)
CROP_SQL = f"""SELECT *, least(width, x2 + px) - greatest(0, x1 - px) AS cw, least(height, y2 + py) - greatest(0, y1 - py) AS ch
  FROM (SELECT *, CAST(round_even((x2 - x1) * CAST(0.05 AS DOUBLE), 0) AS INT) AS px,
  CAST(round_even((y2 - y1) * CAST(0.05 AS DOUBLE), 0) AS INT) AS py FROM ({sc.KEPT_SQL}))"""
PROBLEM_SQL = f"""SELECT *, source_type IN ('generated', 'cctv') AS skipped, CASE WHEN cw < 60 OR ch < 60 THEN
  '{vocab.CROP_TOO_SMALL}' WHEN greatest(CAST(cw AS DOUBLE) / ch, CAST(ch AS DOUBLE) / cw) > 2.5 THEN
  '{vocab.CROP_BAD_ASPECT}' END AS problem FROM ({CROP_SQL})"""
SKIP = ("generated", "cctv")


@query(
    "j7_classified_objects",
    f"""SELECT sample_id, p AS pos, CASE WHEN skipped THEN 'cropped' ELSE 'classified' END AS status,
    CASE WHEN skipped OR problem IS NOT NULL THEN 0 ELSE 12 END AS n_labels,
    CASE WHEN NOT skipped AND problem IS NULL THEN CASE WHEN hard_hat THEN 'wearing_helmet' ELSE 'no_helmet' END END AS helmet,
    CASE WHEN NOT skipped AND problem IS NULL THEN CASE WHEN smoking AND hard_hat IS NULL THEN 'smoking' ELSE 'not_smoking' END
      END AS smoking, CASE WHEN skipped THEN NULL ELSE 'answers' END AS classifier_name FROM ({PROBLEM_SQL})""",
)
def j7(t: Tables) -> DataFrame:
    done = classify.classify(sc.cropped(t), "external_script", sc.RUN, sc.answers(t), STRICT, SKIP)
    rows = sc.object_rows(done, "workflow")

    def value(key: str):
        hits = F.filter("o.classification.multi_labels", lambda label: label["label_key"] == key)
        return F.get(hits, F.lit(0))["label_value"]

    return rows.select(
        "sample_id",
        "o.pos",
        F.col("workflow.workflow_status").alias("status"),
        F.size("o.classification.multi_labels").alias("n_labels"),
        value("helmet").alias("helmet"),
        value("smoking").alias("smoking"),
        "o.classification.classifier_name",
    )


@query(
    "k5_invalid_crops",
    f"""SELECT sample_id, p AS pos, false AS is_valid_crop, 'failed' AS qc_status, 'invalid_crop_geometry' AS flags,
    'classification_crop_guard' AS reviewer, problem AS comment, cw AS image_width, ch AS image_height
    FROM ({PROBLEM_SQL}) WHERE NOT skipped AND problem IS NOT NULL""",
)
def k5(t: Tables) -> DataFrame:
    done = classify.classify_with_answers(sc.cropped(t), sc.answers(t), STRICT, SKIP, sc.RUN)
    rows = sc.object_rows(done).filter("NOT o.crop.is_valid_crop")
    raw = "o.classification.raw_response"
    return rows.select(
        "sample_id",
        "o.pos",
        "o.crop.is_valid_crop",
        "o.quality_check.qc_status",
        F.array_join("o.quality_check.issue_flags", ",").alias("flags"),
        "o.quality_check.reviewer",
        "o.quality_check.comment",
        F.try_variant_get(raw, "$.image_width", "int").alias("image_width"),
        F.try_variant_get(raw, "$.image_height", "int").alias("image_height"),
    )


@query(
    "k6_missing_crops",
    f"""SELECT sample_id, p AS pos, CASE WHEN p = 0 THEN 'missing crop.crop_uri' END AS error,
    CASE WHEN p = 0 THEN 0 ELSE 12 END AS n_labels FROM ({sc.KEPT_SQL}) WHERE source_type <> 'generated'""",
)
def k6(t: Tables) -> DataFrame:
    def lose(obj):
        uri = F.when(obj["pos"] == 0, F.lit("")).otherwise(obj["crop"]["crop_uri"])
        return obj.withField("crop.crop_uri", uri)

    lost = objects.map_objects(sc.cropped(t), lose)
    done = classify.classify_with_answers(lost, sc.answers(t), sc.CLASSIFIER, (), sc.RUN)
    rows = sc.object_rows(done, "workflow").filter("workflow.workflow_status = 'classified'")
    return rows.select(
        "sample_id",
        "o.pos",
        F.try_variant_get("o.classification.raw_response", "$.error", "string").alias("error"),
        F.size("o.classification.multi_labels").alias("n_labels"),
    )


@query(
    "k7_rule_labels",
    f"""SELECT sample_id, p AS pos, k.label_key, 'unknown' AS label_value, 'rule' AS classifier_type
    FROM ({sc.KEPT_SQL}) CROSS JOIN (VALUES ('helmet'), ('reflective_vest'), ('phone_usage')) k(label_key)
    WHERE source_type <> 'generated'""",
)
def k7(t: Tables) -> DataFrame:
    done = classify.classify(sc.cropped(t), "dry_run_rule", sc.RUN)
    rows = sc.object_rows(done).select("sample_id", "o.pos", "o.classification.classifier_type", F.explode("o.classification.multi_labels").alias("l"))
    return rows.select("sample_id", "pos", "l.label_key", "l.label_value", "classifier_type")


@query(
    "p9_skipped_sources",
    f"""SELECT sample_id, CASE WHEN source_type IN ('generated', 'cctv') THEN 'cropped' ELSE 'classified' END AS status,
    CASE WHEN source_type = 'generated' THEN 'cropped' ELSE 'classified' END AS default_status FROM ({sc.SCENE_SQL})""",
)
def p9(t: Tables) -> DataFrame:
    rows = sc.cropped(t)
    status = F.when(classify.is_skipped(SKIP), "cropped").otherwise("classified")
    default = F.when(classify.is_skipped(()), "cropped").otherwise("classified")
    return rows.select("sample_id", status.alias("status"), default.alias("default_status"))


# --- scoring ----------------------------------------------------------------------------------------


@query(
    "r2_scored_parts",
    """SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 2 ELSE 1 END AS attempt, CAST(p_size * 2 AS INT) AS doubled
    FROM part WHERE p_size % 7 > 0""",
)
def r2(t: Tables) -> DataFrame:
    """A stand-in model over the part table: sizes divisible by five fail once, by seven always."""

    def make_model():
        def model(batch):
            fails = (batch["p_size"] % 7 == 0) | ((batch["p_size"] % 5 == 0) & (batch["attempt"] == 1))
            text = '{"doubled": ' + (batch["p_size"] * 2).astype(str) + "}"
            return text.mask(fails, "busy")

        return model

    done, _ = scoring.score_with_retry(t.read("part").select("p_partkey", "p_size"), make_model, "detection", 3)
    return done.select("p_partkey", "attempt", F.try_variant_get("payload", "$.doubled", "int").alias("doubled"))


@query(
    "r2_failed_requests",
    f"""SELECT p_partkey, CASE WHEN p_size % 11 = 0 THEN '{scoring.CALL_ERROR}' ELSE '{vocab.DETECTION_PARSE_ERROR}' END AS error_class,
    CASE WHEN p_size % 11 = 0 THEN concat('ConnectionError: ', p_size) ELSE 'busy' END AS error_preview
    FROM part WHERE p_size % 11 = 0 OR p_size % 7 = 0""",
)
def r2_failed(t: Tables) -> DataFrame:
    """A model that raises for sizes divisible by eleven and never answers readably for those divisible by seven."""

    def make_model():
        def model(batch):
            dead = batch["p_size"][batch["p_size"] % 11 == 0]
            if len(dead):
                raise ConnectionError(str(dead.iloc[0]))
            return batch["p_size"].map(lambda size: "busy" if size % 7 == 0 else '{"n": 1}')

        return model

    _, failed = scoring.score_with_retry(t.read("part").select("p_partkey", "p_size"), make_model, "detection", 2)
    return failed.select("p_partkey", "error_class", "error_preview")
