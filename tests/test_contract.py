import copy
import json

import pytest
from pyspark.sql import functions as F

from boxloom.operators import classify, contract, export, samples
from boxloom.operators.objects import make_object, to_documents
from boxloom.functions.geometry import make_box
from boxloom.params import ExportDefaults, QcPolicy, Run

RUN = Run(now="2026-05-08T10:00:00+08:00", now_utc="2026-05-08T02:00:00Z", pipeline_id="line", pipeline_version="2")

SAMPLE = {
    "sample_id": "s1",
    "image_asset": {
        "image_id": "i1",
        "image_uri": "dir\\i1.jpg",
        "width": 1920,
        "height": 1080,
        "source_type": "manual_upload",
        "source_context": {"collection_batch": "b1"},
        "scene_context": None,
    },
    "objects": [
        {
            "object_id": "obj_000001",
            "object_type": "person",
            "box": {"format": "xyxy", "x1": 320, "y1": 180, "x2": 640, "y2": 920},
            "geometry_source": "detector",
            "geometry_model": {"model_name": "m", "confidence": 0.92},
            "crop": {
                "crop_id": "s1_obj_000001",
                "crop_uri": "crops/s1_obj_000001.jpg",
                "crop_box": {"format": "xyxy", "x1": 304, "y1": 143, "x2": 656, "y2": 957},
                "crop_expand_ratio": 0.05,
            },
            "classification": {
                "multi_labels": [
                    {"label_key": "helmet", "label_value": "wearing_helmet", "confidence": None, "evidence": "seen"},
                    {"label_key": "custom", "label_value": "a & b", "confidence": 0.5, "evidence": None},
                    {"label_key": "", "label_value": "x"},
                ]
            },
        }
    ],
    "workflow": {"workflow_status": "classified"},
}


def change(*steps):
    """A copy of the sample with (path, value) set; the value ... removes the key."""
    doc = copy.deepcopy(SAMPLE)
    for path, value in steps:
        at = doc
        for key in path[:-1]:
            at = at[key]
        if value is ...:
            del at[path[-1]]
        else:
            at[path[-1]] = copy.deepcopy(value)
    return doc


def normalized(spark, *docs, run=RUN):
    rows = [(i, doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)) for i, doc in enumerate(docs)]
    return contract.normalize_documents(spark.createDataFrame(rows, "n int, raw_json string"), run)


def messages(spark, *docs):
    report = contract.validation_report(contract.validate(normalized(spark, *docs)), "n")
    return [row.message for row in report.orderBy("n").collect()]


OBJ = ("objects", 0)
LABELS = (*OBJ, "classification", "multi_labels")
BLANK_KEY = (LABELS, SAMPLE["objects"][0]["classification"]["multi_labels"][:2])


def test_first_violation(spark):
    cases = [
        ((), "ok"),
        ((("sample_id",), 5), "sample.sample_id is required"),
        ((("image_asset",), ...), "image_asset.image_id is required"),
        ((("image_asset",), "x"), "image_asset is required"),
        ((("image_asset", "width"), "0"), "image_asset.width must be positive"),
        ((("image_asset", "width"), "1920"), "ok"),
        ((("image_asset", "source_type"), "drone"), "image_asset.source_type is invalid: drone"),
        ((("objects",), None), "objects must be a list"),
        ((("objects",), ...), "ok"),
        ((OBJ, 3), "objects[0] must be an object"),
        (((*OBJ, "box"), None), "objects[0].box must be an object"),
        (((*OBJ, "box", "y1"), ...), "objects[0].box.y1 is required"),
        (((*OBJ, "box", "format"), "xywh"), "objects[0].box.format must be xyxy"),
        (
            ((*OBJ, "box", "x2"), 320),
            "objects[0].box has invalid x coordinates: {'format': 'xyxy', 'x1': 320, 'y1': 180, 'x2': 320, 'y2': 920}",
        ),
        (((*OBJ, "geometry_source"), "guess"), "objects[0].geometry_source is invalid: guess"),
        (((*OBJ, "crop"), ...), "objects[0].crop.crop_uri is required"),
        (((*OBJ, "crop", "crop_uri"), "pending"), "objects[0].crop.crop_uri must be a real crop path, not pending"),
        (
            ((*OBJ, "crop", "crop_box", "y2"), 2000),
            "objects[0].crop.crop_box has invalid y coordinates: {'format': 'xyxy', 'x1': 304, 'y1': 143, 'x2': 656, 'y2': 2000}",
        ),
        (((*OBJ, "classification"), []), "objects[0].classification must be an object"),
        ((LABELS, "x"), "objects[0].classification.multi_labels must be a list"),
        (((*LABELS, 1, "confidence"), 1.5), "objects[0].classification.multi_labels[1].confidence must be between 0 and 1"),
        (((*OBJ, "classification", "classifier_type"), "guess"), "objects[0].classification.classifier_type is invalid: guess"),
        ((("workflow", "workflow_status"), "lost"), "workflow.workflow_status is invalid: lost"),
        ((("export",), {"export_format": "pdf"}), "export.export_format is invalid: pdf"),
    ]
    docs = [change(BLANK_KEY, *([step] if step else [])) for step, _ in cases]
    assert messages(spark, *docs) == [expected for _, expected in cases]
    assert messages(spark, SAMPLE, "[1]", "{broken")[0] == "objects[0].classification.multi_labels[2].label_key is required"
    assert messages(spark, "[1]", "{broken") == ["sample must be an object"] * 2


def test_all_violations_are_listed(spark):
    doc = change(BLANK_KEY, (("sample_id",), ""), (("image_asset", "height"), 0), (("export",), {"export_status": "?"}))
    rows = contract.violation_rows(contract.validate(normalized(spark, doc)), "n").orderBy("n").collect()
    assert {r.path for r in rows} == {"sample.sample_id", "image_asset.height", "objects[0].box", "objects[0].crop.crop_box", "export.export_status"}


def test_defaults(spark):
    bare = {"sample_id": "s", "objects": [{"object_id": "o"}, {"crop": {"is_valid_crop": None}}]}
    first, second = normalized(spark, SAMPLE, bare).orderBy("n").collect()
    assert first.image_asset.scene_context is None and first.image_asset.source_context.collection_batch == "b1"
    assert first.objects[0].crop.is_valid_crop is True and first.objects[0].geometry_model.model_version is None
    assert first.workflow.asDict() == {
        "workflow_status": "classified", "pipeline_id": "line", "pipeline_version": "2",
        "created_time": RUN.now, "updated_time": RUN.now,
    }
    assert first.export.export_format == "labelstudio" and first.qc_policy is None
    assert second.image_asset.source_context is not None and second.image_asset.width is None
    assert second.objects[0].crop.crop_id == "o_crop" and second.objects[0].crop.crop_uri == ""
    assert second.objects[1].crop.crop_id == "object_crop" and second.objects[1].crop.is_valid_crop is None
    assert second.objects[0].classification.classifier_type == "vlm"
    run = Run(RUN.now, RUN.now_utc, qc_policy=QcPolicy(sampling_ratio=0.1), export=ExportDefaults(export_format="coco"))
    third = normalized(spark, change((("sample_id",), "x")), run=run).collect()[0]
    assert third.qc_policy.sampling_ratio == 0.1 and third.export.export_format == "coco"


def test_schema_findings(spark):
    doc = change(
        BLANK_KEY,
        (("export",), {"export_format": "labelstudio", "export_status": "not_exported"}),
        (("note",), 1),
        ((*OBJ, "box", "x1"), -1),
        ((*OBJ, "quality_check"), {"qc_status": "odd", "review_time": "yesterday", "reviewed_labels": [{"k": 1}]}),
        ((*OBJ, "geometry_detail"), {"polygon": [[1, 2], [3]], "mask_format": "gif", "generation_params": 3}),
        (("qc_policy",), {"sampling_ratio": 2}),
    )
    rows = spark.createDataFrame([(json.dumps(doc),)], "raw string")
    found = rows.select(F.explode(contract.schema_findings(F.try_parse_json("raw"))).alias("f")).select("f.path", "f.rule")
    assert {tuple(r) for r in found.collect()} == {
        ("note", "additionalProperties"),
        ("objects[0].box.x1", "minimum"),
        ("objects[0].quality_check.qc_status", "enum"),
        ("objects[0].quality_check.review_time", "format"),
        ("objects[0].quality_check.reviewed_labels[0].k", "additionalProperties"),
        ("objects[0].geometry_detail.polygon[1]", "items"),
        ("objects[0].geometry_detail.mask_format", "enum"),
        ("objects[0].geometry_detail.generation_params", "type"),
        ("qc_policy.sampling_ratio", "maximum"),
    }


def test_new_object_is_pending_and_rejected(spark):
    rows = spark.createDataFrame([("s", "i", "a.jpg", "cctv", 100, 100)], "sample_id string, image_id string, image_uri string, source_type string, width int, height int")
    box = make_box(*map(F.lit, (10, 10, 90, 90)))
    one = F.array(make_object(F.lit(0), F.lit("p"), F.lit("person"), box, F.lit("detector")))
    documents = to_documents(samples.base_samples(rows, RUN).withColumn("objects", one))
    valid, quarantined = contract.split_valid(documents)
    assert valid.count() == 0 and "not pending" in quarantined.collect()[0].first_violation


def test_rule_labels_and_unknown_source(spark):
    done = classify.classify(normalized(spark, SAMPLE), "dry_run_rule", RUN).collect()[0]
    record = done.objects[0].classification
    assert record.classifier_name == "dry_run_rule_classifier" and len(record.multi_labels) == 3
    assert record.multi_labels[0].evidence == "dry-run classification placeholder"
    custom = classify.classify(normalized(spark, SAMPLE), "dry_run_rule", RUN, labels=[("a", "b")], skip_source_types=("cctv",))
    assert custom.collect()[0].objects[0].classification.multi_labels[0].label_key == "a"
    with pytest.raises(ValueError):
        classify.classify(normalized(spark, SAMPLE), "other", RUN)


def test_task_and_configuration(spark, tmp_path):
    discarded = change((("workflow", "workflow_status"), "discarded"), (("sample_id",), "gone"))
    rows = normalized(spark, SAMPLE, discarded)
    tasks = [json.loads(v) for v in export.export_tasks(rows).toJSON().collect()]
    assert len(tasks) == 1 and tasks[0]["data"] == {"image": "dir/i1.jpg", "sample_id": "s1"}
    prediction = tasks[0]["predictions"][0]
    assert prediction["model_version"] == "2"
    rect, helmet, custom = prediction["result"]
    assert rect["value"] == {
        "x": 320 / 1920 * 100, "y": 180 / 1080 * 100, "width": 320 / 1920 * 100, "height": 740 / 1080 * 100,
        "rotation": 0, "rectanglelabels": ["Person"],
    }
    assert rect["meta"]["crop"]["crop_box"]["x1"] == 304 and rect["meta"]["quality_check"] is None
    assert "choices" not in rect["value"] and "original_width" not in helmet
    assert (helmet["id"], helmet["from_name"], helmet["value"]) == ("obj_000001", "cls_helmet", {"choices": ["wearing_helmet"]})
    assert custom["meta"]["confidence"] == 0.5 and custom["meta"]["evidence"] is None

    exportable = rows.filter(export.is_exportable())
    lines = export.label_config_lines(
        export.rectangle_labels(exportable), export.label_vocabulary(export.exploded_labels(exportable))
    )
    ordered = [r.line for r in lines.orderBy("section", "key_position", "position").collect()]
    assert ordered[:4] == [
        "<View>",
        '  <Image name="image" value="$image"/>',
        '  <RectangleLabels name="label" toName="image">',
        '    <Label value="Person"/>',
    ]
    assert ordered[-5:] == [
        '  <Choices name="cls_custom" toName="image" perRegion="true" choice="single" showInline="true">',
        '    <Choice value="unknown"/>',
        '    <Choice value="a &amp; b"/>',
        "  </Choices>",
        "</View>",
    ]
    export.write_label_config(lines, str(tmp_path / "config"))
    assert [r.value for r in spark.read.text(str(tmp_path / "config")).collect()] == ordered
    nothing = export.rectangle_labels(rows.filter("n < 0"))
    assert [r.label for r in nothing.collect()] == ["Person"]
