"""Column types of manifests, samples and model responses."""

from __future__ import annotations

from pyspark.sql import types as T

from boxloom import vocab


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_S, _I, _D, _B, _V = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType(), T.VariantType()

MANIFEST = T.StructType([T.StructField(name, _S) for name in vocab.MANIFEST_FIELDS])

BOX = _struct(format=_S, x1=_I, y1=_I, x2=_I, y2=_I)
GEOMETRY_MODEL = _struct(model_name=_S, model_version=_S, confidence=_D)
GEOMETRY_DETAIL = _struct(
    polygon=T.ArrayType(T.ArrayType(_D)), mask_uri=_S, mask_format=_S, generation_params=_V
)
CROP = _struct(crop_id=_S, crop_uri=_S, crop_box=BOX, crop_expand_ratio=_D, is_valid_crop=_B)
LABEL = _struct(label_key=_S, label_value=_S, confidence=_D, evidence=_S)
CLASSIFICATION = _struct(
    multi_labels=T.ArrayType(LABEL),
    classifier_type=_S,
    classifier_name=_S,
    classifier_version=_S,
    prompt_version=_S,
    raw_response=_V,
)
QUALITY_CHECK = _struct(
    qc_sampled=_B,
    qc_status=_S,
    reviewed_labels=T.ArrayType(_struct(label_key=_S, label_value=_S)),
    issue_flags=T.ArrayType(_S),
    reviewer=_S,
    review_time=_S,
    comment=_S,
)
OBJECT = _struct(
    object_id=_S,
    object_type=_S,
    box=BOX,
    geometry_source=_S,
    geometry_model=GEOMETRY_MODEL,
    geometry_detail=GEOMETRY_DETAIL,
    crop=CROP,
    classification=CLASSIFICATION,
    quality_check=QUALITY_CHECK,
)
# While a sample is being built each object also carries `pos`, its 0-based detection ordinal.
WORK_OBJECT = T.StructType([T.StructField("pos", _I), *OBJECT.fields])

SOURCE_CONTEXT = T.StructType([T.StructField(name, _S) for name in vocab.SOURCE_CONTEXT_FIELDS])
SCENE_CONTEXT = T.StructType([T.StructField(name, _S) for name in vocab.SCENE_CONTEXT_FIELDS])
IMAGE_ASSET = _struct(
    image_id=_S,
    image_uri=_S,
    width=_I,
    height=_I,
    source_type=_S,
    source_context=SOURCE_CONTEXT,
    scene_context=SCENE_CONTEXT,
)
QC_POLICY = _struct(qc_mode=_S, sampling_ratio=_D, sampling_method=_S, fail_policy=_S, qc_batch_id=_S)
WORKFLOW = _struct(
    workflow_status=_S, pipeline_id=_S, pipeline_version=_S, created_time=_S, updated_time=_S
)
EXPORT = _struct(export_format=_S, export_status=_S, export_uri=_S, labelstudio_mapping=_V)
SAMPLE = _struct(
    sample_id=_S,
    image_asset=IMAGE_ASSET,
    objects=T.ArrayType(OBJECT),
    qc_policy=QC_POLICY,
    workflow=WORKFLOW,
    export=EXPORT,
)

# Model replies arrive as text: one row per request and attempt. `pos` is null for whole-image requests.
RESPONSE = _struct(
    sample_id=_S,
    task_key=_S,
    pos=_I,
    attempt=_I,
    raw_text=_S,
    request_width=_I,
    request_height=_I,
)
