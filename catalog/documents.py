"""Raw sample documents: defaults, contract, schema, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import shared_path
from boxloom.operators import contract, objects, samples
from boxloom.params import QcPolicy, Run
from boxloom.plans.generated import ingest_generated
from boxloom.sources import documents as files
from catalog import scenes as sc
from catalog.inputs import Tables, with_inputs
from catalog.registry import query

RUN = Run(now="2026-05-08T10:00:00+08:00", now_utc="2026-05-08T02:00:00Z", pipeline_id=None, pipeline_version=None)


def normalized(t: Tables) -> DataFrame:
    return contract.normalize_documents(t.documents, RUN)


@query(
    "c1_defaults",
    """SELECT o_orderkey AS sample_no, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE concat('sample_', o_orderkey) END AS sample_id,
    CAST(CASE WHEN o_orderkey % 17 = 0 THEN 0 ELSE 1000 END AS INT) AS width, 'c' AS crop_id,
    CASE WHEN o_orderkey % 29 = 0 THEN 'pending' ELSE 'c.jpg' END AS crop_uri, true AS is_valid_crop,
    'vlm' AS classifier_type, 0 AS n_labels, CASE WHEN o_orderkey % 31 = 0 THEN 'discarded' ELSE 'boxed' END AS status,
    '2026-05-08T10:00:00+08:00' AS created_time, 'labelstudio' AS export_format, 'not_exported' AS export_status,
    true AS no_quality_check, false AS no_source_context FROM orders""",
)
def c1(t: Tables) -> DataFrame:
    first = F.get("objects", F.lit(0))
    return normalized(t).select(
        "sample_no",
        "sample_id",
        F.col("image_asset.width").alias("width"),
        first["crop"]["crop_id"].alias("crop_id"),
        first["crop"]["crop_uri"].alias("crop_uri"),
        first["crop"]["is_valid_crop"].alias("is_valid_crop"),
        first["classification"]["classifier_type"].alias("classifier_type"),
        F.size(first["classification"]["multi_labels"]).alias("n_labels"),
        F.col("workflow.workflow_status").alias("status"),
        F.col("workflow.created_time").alias("created_time"),
        F.col("export.export_format").alias("export_format"),
        F.col("export.export_status").alias("export_status"),
        first["quality_check"].isNull().alias("no_quality_check"),
        F.col("image_asset.source_context").isNull().alias("no_source_context"),
    )


@query(
    "t11_merged_defaults",
    """SELECT o_orderkey AS sample_no, o_orderkey % 3 = 0 AS stays_null, CASE WHEN o_orderkey % 3 = 1 THEN 'A' END AS site
    FROM orders""",
)
def t11(t: Tables) -> DataFrame:
    scene = F.col("image_asset.scene_context")
    return normalized(t).select("sample_no", scene.isNull().alias("stays_null"), scene["site"].alias("site"))


POLICY_TEXT = """CASE sample_no % 3 WHEN 0 THEN replace(raw_json, '"workflow"', '"qc_policy": {"qc_mode": "none"}, "workflow"')
  WHEN 1 THEN replace(raw_json, '"workflow"', '"qc_policy": null, "workflow"') ELSE raw_json END"""


@query(
    "c2_qc_policy",
    """SELECT o_orderkey AS sample_no, CASE WHEN o_orderkey % 3 = 0 THEN 'none' END AS own_mode,
    'sampling' AS run_mode, CAST(0.08 AS DOUBLE) AS run_ratio, 'random' AS run_method FROM orders""",
)
def c2(t: Tables) -> DataFrame:
    rows = t.documents.selectExpr("sample_no", f"{POLICY_TEXT} AS raw_json")
    run = Run(RUN.now, RUN.now_utc, qc_policy=QcPolicy(sampling_ratio=0.08))
    own = contract.normalize_documents(rows, RUN).selectExpr("sample_no", "qc_policy.qc_mode AS own_mode")
    overridden = contract.normalize_documents(rows, run).selectExpr(
        "sample_no",
        "qc_policy.qc_mode AS run_mode",
        "qc_policy.sampling_ratio AS run_ratio",
        "qc_policy.sampling_method AS run_method",
    )
    return own.join(overridden, "sample_no")


SHOWN = "{'format': 'xyxy', 'x1': 10, 'y1': 10, 'x2': "
VIOLATIONS = f"""SELECT * FROM (
  SELECT o_orderkey AS sample_no, 1 AS rule_order, 'sample.sample_id' AS path, 'sample.sample_id is required' AS message
    FROM orders WHERE o_orderkey % 13 = 0
  UNION ALL SELECT o_orderkey, 5, 'image_asset.width', 'image_asset.width must be positive' FROM orders WHERE o_orderkey % 17 = 0
  UNION ALL SELECT o_orderkey, 8, 'image_asset.source_type', 'image_asset.source_type is invalid: drone' FROM orders
    WHERE o_orderkey % 19 = 0
  UNION ALL SELECT o_orderkey, 17, 'objects[0].box', concat('objects[0].box has invalid x coordinates: ',
    '{SHOWN.replace("'", "''")}', CASE WHEN o_orderkey % 23 = 0 THEN '5' ELSE '90' END, ', ''y2'': 90}}') FROM orders
    WHERE o_orderkey % 23 = 0 OR o_orderkey % 17 = 0
  UNION ALL SELECT o_orderkey, 28, 'objects[0].crop.crop_uri',
    'objects[0].crop.crop_uri must be a real crop path, not pending' FROM orders WHERE o_orderkey % 29 = 0)"""


@query(
    "c3_paths_in_parts",
    f"""SELECT sample_id, concat('objects[', place, '].geometry_source') AS path FROM (SELECT *,
    row_number() OVER (PARTITION BY sample_id ORDER BY p) - 1 AS place FROM ({sc.KEPT_SQL})) WHERE object_type = 'person'""",
)
def c3_in_parts(t: Tables) -> DataFrame:
    """Paths count through the parts of an image."""
    rows = objects.map_objects(
        sc.classified(t, part_size=2),
        lambda o: o.withField("geometry_source", F.when(o["object_type"] == "person", F.lit("elsewhere")).otherwise(o["geometry_source"])),
    )
    checked = contract.validate(objects.to_documents(objects.whole_samples(rows)))
    return contract.violation_rows(checked, "sample_id").select("sample_id", "path")


@query("c3_violations", VIOLATIONS)
def c3(t: Tables) -> DataFrame:
    rows = contract.violation_rows(contract.validate(normalized(t)), "sample_no")
    return rows.select("sample_no", "rule_order", "path", "message")


@query(
    "c3_first_violation",
    f"""SELECT o_orderkey AS sample_no, message FROM orders LEFT JOIN (SELECT sample_no, arg_min(message, rule_order) AS message
    FROM ({VIOLATIONS}) GROUP BY sample_no) v ON o_orderkey = v.sample_no""",
)
def c3_first(t: Tables) -> DataFrame:
    return contract.validate(normalized(t)).select("sample_no", F.col("first_violation").alias("message"))


ODD_TEXT = """CASE WHEN sample_no % 37 = 0 THEN replace(raw_json, '"height": 500', '"height": 500.5, "note": 1')
  WHEN sample_no % 41 = 0 THEN replace(raw_json, '"multi_labels": []',
    '"multi_labels": [{"label_key": "a", "label_value": "b", "confidence": 1.5, "why": ""}]') ELSE raw_json END"""


@query(
    "c4_schema_findings",
    """SELECT * FROM (SELECT o_orderkey AS sample_no, 'export' AS path, 'required' AS rule, CAST(NULL AS VARCHAR) AS detail FROM orders
    UNION ALL SELECT o_orderkey, 'sample_id', 'minLength', '' FROM orders WHERE o_orderkey % 13 = 0
    UNION ALL SELECT o_orderkey, 'image_asset.width', 'minimum', '0' FROM orders WHERE o_orderkey % 17 = 0
    UNION ALL SELECT o_orderkey, 'image_asset.source_type', 'enum', 'drone' FROM orders WHERE o_orderkey % 19 = 0
    UNION ALL SELECT o_orderkey, 'image_asset.height', 'type', 'DECIMAL(4,1)' FROM orders WHERE o_orderkey % 37 = 0
    UNION ALL SELECT o_orderkey, 'image_asset.note', 'additionalProperties', NULL FROM orders WHERE o_orderkey % 37 = 0
    UNION ALL SELECT o_orderkey, 'objects[0].classification.multi_labels[0].confidence', 'maximum', '1.5' FROM orders
      WHERE o_orderkey % 41 = 0 AND o_orderkey % 37 > 0
    UNION ALL SELECT o_orderkey, 'objects[0].classification.multi_labels[0].why', 'additionalProperties', NULL FROM orders
      WHERE o_orderkey % 41 = 0 AND o_orderkey % 37 > 0)""",
)
def c4(t: Tables) -> DataFrame:
    rows = t.documents.selectExpr("sample_no", f"try_parse_json({ODD_TEXT}) AS doc")
    found = rows.select("sample_no", F.explode(contract.schema_findings(F.col("doc"))).alias("f"))
    return found.select("sample_no", "f.path", "f.rule", "f.detail")


IS_BAD = " OR ".join(f"o_orderkey % {n} = 0" for n in (13, 17, 19, 23, 29))
BROKEN = "CASE WHEN sample_no % 43 = 0 THEN left(raw_json, 40) WHEN sample_no % 47 = 0 THEN '[1]' ELSE raw_json END"


@query(
    "c5_validation_report",
    f"""SELECT o_orderkey AS sample_no, NOT ({IS_BAD} OR o_orderkey % 43 = 0 OR o_orderkey % 47 = 0) AS ok,
    CASE WHEN o_orderkey % 43 = 0 OR o_orderkey % 47 = 0 THEN 'sample must be an object' ELSE coalesce(message, 'ok') END AS message
    FROM orders LEFT JOIN (SELECT sample_no, arg_min(message, rule_order) AS message
    FROM ({VIOLATIONS}) GROUP BY sample_no) v ON o_orderkey = v.sample_no""",
)
def c5(t: Tables) -> DataFrame:
    rows = t.documents.selectExpr("sample_no", f"{BROKEN} AS raw_json")
    return contract.validation_report(contract.validate(contract.normalize_documents(rows, RUN)), "sample_no")


@query(
    "a5_validation_counts",
    f"SELECT count(*) AS n_documents, count(*) FILTER ({IS_BAD}) AS n_failed FROM orders",
)
def a5_validation(t: Tables) -> DataFrame:
    return contract.report_counts(contract.validation_report(contract.validate(normalized(t)), "sample_no"))


@query(
    "c6_workflow_step",
    """SELECT o_orderkey AS sample_no, 'cropped' AS status, '2026-06-01T00:00:00+08:00' AS updated_time,
    '2026-05-08T10:00:00+08:00' AS created_time FROM orders""",
)
def c6(t: Tables) -> DataFrame:
    moved = samples.advance(normalized(t), "cropped", "2026-06-01T00:00:00+08:00")
    return moved.selectExpr(
        "sample_no",
        "workflow.workflow_status AS status",
        "workflow.updated_time AS updated_time",
        "workflow.created_time AS created_time",
    )


# --- generated documents ----------------------------------------------------------------------------

GENERATED = "CASE WHEN sample_no % 3 > 0 THEN replace(raw_json, '\"cctv\"', '\"generated\"') ELSE raw_json END"
GEN_SQL = "SELECT *, CASE WHEN k % 19 = 0 THEN 'drone' WHEN k % 3 > 0 THEN 'generated' ELSE 'cctv' END AS source_type FROM (SELECT o_orderkey AS k FROM orders)"


def generated(t: Tables):
    return ingest_generated(t.documents.selectExpr("sample_no", f"{GENERATED} AS raw_json"), RUN)


@query(
    "p14_generated_only",
    f"""SELECT k AS sample_no, concat('Expected generated source_type: ', CASE WHEN k % 13 = 0 THEN '' ELSE concat('sample_', k) END)
    AS error FROM ({GEN_SQL}) WHERE source_type <> 'generated'""",
)
def p14(t: Tables) -> DataFrame:
    return generated(t).rejected.select("sample_no", "error")


@query(
    "b2_generated_ingest",
    f"""SELECT concat('sample_', k) AS sample_id, CASE WHEN k % 31 = 0 THEN 'discarded' ELSE 'boxed' END AS status, 1 AS n_objects
    FROM ({GEN_SQL}) WHERE source_type = 'generated' AND k % 13 > 0 AND k % 17 > 0 AND k % 23 > 0 AND k % 29 > 0""",
)
def b2(t: Tables) -> DataFrame:
    return generated(t).samples.select(
        "sample_id", F.col("workflow.workflow_status").alias("status"), F.size("objects").alias("n_objects")
    )


@query(
    "b2_quarantined",
    f"""SELECT k AS sample_no, message AS first_violation FROM ({GEN_SQL}) JOIN (SELECT sample_no, arg_min(message, rule_order)
    AS message FROM ({VIOLATIONS}) GROUP BY sample_no) v ON k = v.sample_no WHERE source_type = 'generated'""",
)
def b2_bad(t: Tables) -> DataFrame:
    return generated(t).quarantined.select("sample_no", "first_violation")


# --- files ------------------------------------------------------------------------------------------


@query("io7_document_lines", with_inputs("SELECT raw_json FROM fx_documents", "fx_documents"))
def io7(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "documents")
    t.documents.select("raw_json").write.text(path)
    return files.read_raw_lines(t.spark, path).select("raw_json")


@query(
    "io12_responses",
    with_inputs("SELECT sample_id, attempt, raw_text FROM fx_responses", "fx_responses"),
)
def io12(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "responses")
    files.write_json_lines(t.responses.select("sample_id", "attempt", "raw_text"), path)
    return files.read_responses(t.spark, path, "json").select("sample_id", "attempt", "raw_text")


