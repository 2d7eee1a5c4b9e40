"""Sample documents: filling defaults, the contract rules, and the stricter schema rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import schema, vocab
from boxloom.functions.columns import (
    bind,
    is_array,
    is_boolean,
    is_explicit_null,
    is_object,
    items_of,
    kind_of,
    let,
    members,
    null,
    text_of,
)
from boxloom.operators.samples import export_struct, qc_policy_struct
from boxloom.params import Run

VIOLATION = "struct<rule_order:int,path:string,rule:string,message:string>"
FINDING = "struct<path:string,rule:string,detail:string>"


# --- defaults ---------------------------------------------------------------------------------------
#
# Every object of a document is taken apart once (`members`); the functions below read from that struct.


def _opened(value: Column, fields: Iterable[str], build: Callable[[Column], Column]) -> Column:
    """`build` on the members of an object, a struct of VARIANTs that is null when `value` is no object."""
    return let(members(value, *fields), build)


def _text(held: Column, name: str) -> Column:
    return text_of(held.getField(name))


def _cast(held: Column, kind: str, name: str) -> Column:
    return F.try_variant_get(held.getField(name), "$", kind).alias(name)


def _flag(held: Column, name: str) -> Column:
    value = held.getField(name)
    return F.when(is_boolean(value), F.try_variant_get(value, "$", "boolean"))


def _default(held: Column, name: str, value: Column, default: Column) -> Column:
    """`default` only when the key is absent; an explicit null stays null."""
    return F.when(held.getField(name).isNull(), default).otherwise(value)


def _texts(held: Column, names: list[str]) -> list[Column]:
    return [_text(held, name).alias(name) for name in names]


def _open_object(held: Column, name: str) -> Column:
    value = held.getField(name)
    return F.when(~is_explicit_null(value), value).alias(name)


def _overlay(held: Column, name: str, fields: Iterable[str], build: Callable[[Column], Column]) -> Column:
    """Struct over all-null defaults: null stays null, anything that is no object yields the defaults."""
    value = held.getField(name)
    return F.when(~is_explicit_null(value), _opened(value, fields, build)).alias(name)


def _if_object(value: Column, fields: Iterable[str], build: Callable[[Column], Column]) -> Column:
    """Struct of an object; anything else gives null."""
    return _opened(value, fields, lambda held: F.when(held.isNotNull(), build(held)))


def _member_object(held: Column, name: str, fields: Iterable[str], build: Callable[[Column], Column]) -> Column:
    """Struct of a required object: absent counts as {}, null or another type gives null."""
    value = held.getField(name)
    return _opened(
        value, fields, lambda inner: F.when(inner.isNotNull() | value.isNull(), build(inner))
    ).alias(name)


def _box(value: Column) -> Column:
    corners = ("x1", "y1", "x2", "y2")
    return _if_object(
        value, BOX_FIELDS, lambda v: F.struct(_text(v, "format").alias("format"), *[_cast(v, "int", name) for name in corners])
    )


def _label(value: Column) -> Column:
    return _if_object(
        value,
        LABEL_FIELDS,
        lambda v: F.struct(
            *_texts(v, ["label_key", "label_value"]), _cast(v, "double", "confidence"), _text(v, "evidence").alias("evidence")
        ),
    )


def _crop(held: Column, object_id: Column) -> Column:
    own_id = F.concat(F.coalesce(object_id, F.lit("object")), F.lit("_crop"))
    return F.struct(
        _default(held, "crop_id", _text(held, "crop_id"), own_id).alias("crop_id"),
        _default(held, "crop_uri", _text(held, "crop_uri"), F.lit("")).alias("crop_uri"),
        _box(held.getField("crop_box")).alias("crop_box"),
        _cast(held, "double", "crop_expand_ratio"),
        _default(held, "is_valid_crop", _flag(held, "is_valid_crop"), F.lit(True)).alias("is_valid_crop"),
    )


def _classification(held: Column) -> Column:
    labels = F.transform(items_of(held.getField("multi_labels")), _label)
    no_labels = F.array().cast(schema.CLASSIFICATION["multi_labels"].dataType)
    return F.struct(
        _default(held, "multi_labels", labels, no_labels).alias("multi_labels"),
        _default(held, "classifier_type", _text(held, "classifier_type"), F.lit("vlm")).alias("classifier_type"),
        *_texts(held, ["classifier_name", "classifier_version", "prompt_version"]),
        _open_object(held, "raw_response"),
    )


def _quality_check(held: Column) -> Column:
    names = list(REVIEWED_LABEL_FIELDS)
    reviewed = F.transform(
        items_of(held.getField("reviewed_labels")), lambda v: _opened(v, names, lambda label: F.struct(*_texts(label, names)))
    )
    return F.struct(
        _flag(held, "qc_sampled").alias("qc_sampled"),
        _text(held, "qc_status").alias("qc_status"),
        reviewed.alias("reviewed_labels"),
        _cast(held, "array<string>", "issue_flags"),
        *_texts(held, ["reviewer", "review_time", "comment"]),
    )


def _object(value: Column) -> Column:
    def model(held: Column) -> Column:
        return F.struct(*_texts(held, ["model_name", "model_version"]), _cast(held, "double", "confidence"))

    def detail(held: Column) -> Column:
        return F.struct(
            _cast(held, "array<array<double>>", "polygon"),
            *_texts(held, ["mask_uri", "mask_format"]),
            _open_object(held, "generation_params"),
        )

    def build(held: Column) -> Column:
        return F.struct(
            *_texts(held, ["object_id", "object_type"]),
            _box(held.getField("box")).alias("box"),
            _text(held, "geometry_source").alias("geometry_source"),
            _if_object(held.getField("geometry_model"), GEOMETRY_MODEL_FIELDS, model).alias("geometry_model"),
            _overlay(held, "geometry_detail", GEOMETRY_DETAIL_FIELDS, detail),
            _member_object(held, "crop", CROP_FIELDS, lambda v: _crop(v, _text(held, "object_id"))),
            _member_object(held, "classification", CLASSIFICATION_FIELDS, _classification),
            _if_object(held.getField("quality_check"), QUALITY_CHECK_FIELDS, _quality_check).alias("quality_check"),
        ).cast(schema.OBJECT)

    return _if_object(value, OBJECT_FIELDS, build)


def normalize_documents(documents: DataFrame, run: Run, raw: str = "raw_json") -> DataFrame:
    """Typed sample columns from raw JSON text, with defaults where keys are absent.

    Keeps the input columns and adds `is_object`, whether the text is a JSON object at all. Keys outside
    the schema are dropped here and reported by `schema_findings`.
    """
    parsed = bind(documents, {"_held": members(F.try_parse_json(raw), *DOCUMENT_FIELDS)}).withColumn(
        "is_object", F.col("_held").isNotNull() & (F.left(F.ltrim(F.col(raw)), F.lit(1)) == "{")
    )
    doc = F.col("_held")

    def context(asset: Column, name: str, fields: list[str]) -> Column:
        return _overlay(asset, name, fields, lambda v: F.struct(*_texts(v, fields)))

    def image_asset(asset: Column) -> Column:
        return F.struct(
            *_texts(asset, ["image_id", "image_uri"]),
            _cast(asset, "int", "width"),
            _cast(asset, "int", "height"),
            _text(asset, "source_type").alias("source_type"),
            context(asset, "source_context", vocab.SOURCE_CONTEXT_FIELDS),
            context(asset, "scene_context", vocab.SCENE_CONTEXT_FIELDS),
        )

    def workflow(held: Column) -> Column:
        defaults = {
            "workflow_status": F.lit("raw"),
            "pipeline_id": F.lit(run.pipeline_id).cast("string"),
            "pipeline_version": F.lit(run.pipeline_version).cast("string"),
            "created_time": F.lit(run.now),
            "updated_time": F.lit(run.now),
        }
        return F.struct(*[_default(held, name, _text(held, name), default).alias(name) for name, default in defaults.items()])

    def export(held: Column) -> Column:
        defaults = export_struct(run.export)
        names = ["export_format", "export_status", "export_uri"]
        return F.struct(
            *[_default(held, n, _text(held, n), defaults.getField(n)).alias(n) for n in names],
            _open_object(held, "labelstudio_mapping"),
        )

    def qc_policy(held: Column) -> Column:
        return F.struct(
            _text(held, "qc_mode").alias("qc_mode"),
            _cast(held, "double", "sampling_ratio"),
            *_texts(held, ["sampling_method", "fail_policy", "qc_batch_id"]),
        )

    objects = _default(
        doc,
        "objects",
        F.transform(items_of(doc.getField("objects")), _object),
        F.array().cast(schema.SAMPLE["objects"].dataType),
    )
    policy = (
        qc_policy_struct(run.qc_policy)
        if run.qc_policy is not None
        else _if_object(doc.getField("qc_policy"), QC_POLICY_FIELDS, qc_policy)
    )
    # already typed input columns of the same name would be ambiguous downstream
    kept = [name for name in documents.columns if name not in schema.SAMPLE.fieldNames()]
    normalized = {
        "sample_id": _text(doc, "sample_id"),
        "image_asset": _member_object(doc, "image_asset", IMAGE_ASSET_FIELDS, image_asset).cast(schema.IMAGE_ASSET),
        "objects": objects,
        "qc_policy": policy.cast(schema.QC_POLICY),
        "workflow": _member_object(doc, "workflow", WORKFLOW_FIELDS, workflow).cast(schema.WORKFLOW),
        "export": _member_object(doc, "export", EXPORT_FIELDS, export).cast(schema.EXPORT),
    }
    return bind(parsed.select(*kept, "is_object", "_held"), normalized).drop("_held")


# --- contract rules ---------------------------------------------------------------------------------


def _broken(holds: Column, order: int, path: Column, rule: str, message: Column) -> Column:
    return F.when(
        ~F.coalesce(holds, F.lit(False)),
        F.struct(
            F.lit(order).alias("rule_order"),
            path.alias("path"),
            F.lit(rule).alias("rule"),
            F.concat(path, message).alias("message"),
        ),
    )


def _required_text(value: Column, order: int, path: Column) -> Column:
    return _broken(F.length(value) > 0, order, path, "required", F.lit(" is required"))


def _one_of(value: Column, choices: list[str], order: int, path: Column) -> Column:
    """Choice rule; a missing text is left to the required rule."""
    broken = _broken(value.isin(choices), order, path, "choice", F.concat(F.lit(" is invalid: "), value))
    return F.when(F.length(value) > 0, broken)


def _listed(*rules: Column) -> Column:
    return F.array_compact(F.array(*rules))


def _box_rules(box: Column, width: Column, height: Column, order: int, path: Column) -> Column:
    names = ("format", "x1", "y1", "x2", "y2")
    shown = F.format_string(
        ": {'format': '%s', 'x1': %s, 'y1': %s, 'x2': %s, 'y2': %s}",
        *[F.coalesce(box.getField(name).cast("string"), F.lit("None")) for name in names],
    )
    x1, y1, x2, y2 = (box.getField(name) for name in names[1:])
    complete = x1.isNotNull() & y1.isNotNull() & x2.isNotNull() & y2.isNotNull()
    present = [
        _broken(box.getField(name).isNotNull(), order + 1, F.concat(path, F.lit(f".{name}")), "required", F.lit(" is required"))
        for name in names
    ]
    in_x = (x1 >= 0) & (x1 < x2) & (x2 <= width)
    in_y = (y1 >= 0) & (y1 < y2) & (y2 <= height)
    rules = _listed(
        *present,
        F.when(
            box.getField("format").isNotNull(),
            _broken(box.getField("format") == "xyxy", order + 2, F.concat(path, F.lit(".format")), "format", F.lit(" must be xyxy")),
        ),
        F.when(complete, _broken(in_x, order + 3, path, "x_range", F.concat(F.lit(" has invalid x coordinates"), shown))),
        F.when(complete, _broken(in_y, order + 4, path, "y_range", F.concat(F.lit(" has invalid y coordinates"), shown))),
    )
    missing = _listed(_broken(F.lit(False), order, path, "object", F.lit(" must be an object")))
    return F.when(box.isNull(), missing).otherwise(rules)


def _label_rules(label: Column, path: Column) -> Column:
    confidence = label.getField("confidence")
    rules = _listed(
        _required_text(label.getField("label_key"), 41, F.concat(path, F.lit(".label_key"))),
        _required_text(label.getField("label_value"), 42, F.concat(path, F.lit(".label_value"))),
        F.when(
            confidence.isNotNull(),
            _broken(
                (confidence >= 0) & (confidence <= 1),
                43,
                F.concat(path, F.lit(".confidence")),
                "range",
                F.lit(" must be between 0 and 1"),
            ),
        ),
    )
    missing = _listed(_broken(F.lit(False), 40, path, "object", F.lit(" must be an object")))
    return F.when(label.isNull(), missing).otherwise(rules)


def _object_rules(obj: Column, i: Column, width: Column, height: Column) -> Column:
    path = F.concat(F.lit("objects["), i.cast("string"), F.lit("]"))

    def at(suffix: str) -> Column:
        return F.concat(path, F.lit(suffix))

    crop, classification = obj.getField("crop"), obj.getField("classification")
    crop_uri, crop_box = crop.getField("crop_uri"), crop.getField("crop_box")
    labels = classification.getField("multi_labels")
    crop_rules = F.when(
        crop.isNull(), _listed(_broken(F.lit(False), 25, at(".crop"), "required", F.lit(" is required")))
    ).otherwise(
        F.concat(
            _listed(
                _required_text(crop.getField("crop_id"), 26, at(".crop.crop_id")),
                _required_text(crop_uri, 27, at(".crop.crop_uri")),
                _broken(
                    F.coalesce(crop_uri != "pending", F.lit(True)),
                    28,
                    at(".crop.crop_uri"),
                    "pending",
                    F.lit(" must be a real crop path, not pending"),
                ),
            ),
            F.when(crop_box.isNull(), _listed(null(VIOLATION))).otherwise(
                _box_rules(crop_box, width, height, 30, at(".crop.crop_box"))
            ),
        )
    )
    label_rules = F.flatten(
        F.transform(
            labels,
            lambda label, j: _label_rules(
                label, F.concat(at(".classification.multi_labels["), j.cast("string"), F.lit("]"))
            ),
        )
    )
    classification_rules = F.when(
        classification.isNull(),
        _listed(_broken(F.lit(False), 38, at(".classification"), "object", F.lit(" must be an object"))),
    ).otherwise(
        F.concat(
            _listed(_broken(labels.isNotNull(), 39, at(".classification.multi_labels"), "list", F.lit(" must be a list"))),
            F.coalesce(label_rules, _listed(null(VIOLATION))),
            _listed(
                _broken(
                    classification.getField("classifier_type").isin(vocab.CLASSIFIER_TYPES),
                    44,
                    at(".classification.classifier_type"),
                    "choice",
                    F.concat(F.lit(" is invalid: "), F.coalesce(classification.getField("classifier_type"), F.lit("None"))),
                )
            ),
        )
    )
    rules = F.concat(
        _listed(
            _required_text(obj.getField("object_id"), 12, at(".object_id")),
            _required_text(obj.getField("object_type"), 13, at(".object_type")),
        ),
        _box_rules(obj.getField("box"), width, height, 14, at(".box")),
        _listed(
            _required_text(obj.getField("geometry_source"), 20, at(".geometry_source")),
            _one_of(obj.getField("geometry_source"), vocab.GEOMETRY_SOURCES, 21, at(".geometry_source")),
        ),
        crop_rules,
        classification_rules,
    )
    missing = _listed(_broken(F.lit(False), 11, path, "object", F.lit(" must be an object")))
    return F.when(obj.isNull(), missing).otherwise(rules)


def violations() -> Column:
    """All contract violations of the sample columns, in checking order; the first one is what a
    checker that stops early would report."""
    asset, workflow, export = F.col("image_asset"), F.col("workflow"), F.col("export")
    width, height = asset.getField("width"), asset.getField("height")
    asset_rules = F.when(
        asset.isNull(), _listed(_broken(F.lit(False), 2, F.lit("image_asset"), "required", F.lit(" is required")))
    ).otherwise(
        _listed(
            _required_text(asset.getField("image_id"), 3, F.lit("image_asset.image_id")),
            _required_text(asset.getField("image_uri"), 4, F.lit("image_asset.image_uri")),
            _broken(width > 0, 5, F.lit("image_asset.width"), "positive", F.lit(" must be positive")),
            _broken(height > 0, 6, F.lit("image_asset.height"), "positive", F.lit(" must be positive")),
            _required_text(asset.getField("source_type"), 7, F.lit("image_asset.source_type")),
            _one_of(asset.getField("source_type"), vocab.SOURCE_TYPES, 8, F.lit("image_asset.source_type")),
        )
    )
    objects = F.col("objects")
    object_rules = F.when(
        objects.isNull(), _listed(_broken(F.lit(False), 10, F.lit("objects"), "list", F.lit(" must be a list")))
    ).otherwise(F.flatten(F.transform(objects, lambda o, i: _object_rules(o, i, width, height))))

    def tail(struct: Column, name: str, order: int, checks: list[tuple[str, list[str]]]) -> Column:
        required = [
            _required_text(struct.getField(key), order + 1 + n, F.lit(f"{name}.{key}")) for n, (key, _) in enumerate(checks)
        ]
        choices = [
            _one_of(struct.getField(key), allowed, order + 4 + n, F.lit(f"{name}.{key}"))
            for n, (key, allowed) in enumerate(checks)
        ]
        absent = _listed(_broken(F.lit(False), order, F.lit(name), "required", F.lit(" is required")))
        return F.when(struct.isNull(), absent).otherwise(_listed(*required, *choices))

    return F.concat(
        _listed(_required_text(F.col("sample_id"), 1, F.lit("sample.sample_id"))),
        asset_rules,
        object_rules,
        tail(workflow, "workflow", 50, [("workflow_status", vocab.WORKFLOW_STATUSES)]),
        tail(
            export,
            "export",
            60,
            [("export_format", vocab.EXPORT_FORMATS), ("export_status", vocab.EXPORT_STATUSES)],
        ),
    )


def validate(samples: DataFrame) -> DataFrame:
    """Add `violations` and `first_violation` (message, null when the sample is valid)."""
    return bind(samples, {"violations": violations()}).withColumn(
        "first_violation", F.get("violations", F.lit(0)).getField("message")
    )


def violation_rows(validated: DataFrame, *keys: str) -> DataFrame:
    return validated.select(*keys, F.posexplode("violations").alias("place", "_v")).select(*keys, "place", "_v.*")


def split_valid(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid samples, and the quarantined ones with their violations."""
    return split_checked(validate(samples))


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same for rows that `validate` has seen; store them first, then neither output validates again."""
    good = F.col("first_violation").isNull()
    return checked.filter(good).drop("violations", "first_violation"), checked.filter(~good)


class ContractError(ValueError):
    """A strict run met a document that may not be written."""


def require_none(rows: DataFrame, reason: str) -> None:
    """Raise with the first of `rows` (sample_id and `reason`), if there is any."""
    for row in rows.select("sample_id", reason).take(1):
        raise ContractError(f"{row[0]}: {row[1]}")


def validation_report(validated: DataFrame, document: str) -> DataFrame:
    """Per document `ok` and `message`."""
    bad_json = F.when(~F.col("is_object"), F.lit("sample must be an object")) if "is_object" in validated.columns else null("string")
    message = F.coalesce(bad_json, F.col("first_violation"))
    return validated.select(
        F.col(document), message.isNull().alias("ok"), F.coalesce(message, F.lit("ok")).alias("message")
    )


def report_counts(report: DataFrame) -> DataFrame:
    return report.agg(F.count("*").alias("n_documents"), F.count_if(~F.col("ok")).alias("n_failed"))


# --- schema rules -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """Allowed shape of one key: JSON kind, presence, bounds and choices."""

    kind: str
    required: bool = False
    nullable: bool = False
    minimum: float | None = None
    maximum: float | None = None
    choices: list[str] | None = None
    min_length: int = 0
    is_time: bool = False


_ID = Field("string", required=True, min_length=1)
_NULL_TEXT = Field("string", nullable=True)
_NULL_TIME = Field("string", nullable=True, is_time=True)
_SHARE = Field("number", nullable=True, minimum=0, maximum=1)


def _choice(values: list[str], **options) -> Field:
    return Field("string", choices=values, **options)


# Allowed keys per object of a document; any other key is a finding.
DOCUMENT_FIELDS = {
    "sample_id": _ID,
    "image_asset": Field("object", required=True),
    "objects": Field("array", required=True),
    "qc_policy": Field("object", nullable=True),
    "workflow": Field("object", required=True),
    "export": Field("object", required=True),
}
IMAGE_ASSET_FIELDS = {
    "image_id": _ID,
    "image_uri": _ID,
    "width": Field("integer", required=True, minimum=1),
    "height": Field("integer", required=True, minimum=1),
    "source_type": _choice(vocab.SOURCE_TYPES, required=True),
    "source_context": Field("object", nullable=True),
    "scene_context": Field("object", nullable=True),
}
SOURCE_CONTEXT_FIELDS = {
    name: _NULL_TIME if name == "capture_time" else _NULL_TEXT for name in vocab.SOURCE_CONTEXT_FIELDS
}
SCENE_CONTEXT_FIELDS = {name: _NULL_TEXT for name in vocab.SCENE_CONTEXT_FIELDS}
OBJECT_FIELDS = {
    "object_id": _ID,
    "object_type": _ID,
    "box": Field("object", required=True),
    "geometry_source": _choice(vocab.GEOMETRY_SOURCES, required=True),
    "geometry_model": Field("object", nullable=True),
    "geometry_detail": Field("object", nullable=True),
    "crop": Field("object", required=True),
    "classification": Field("object", required=True),
    "quality_check": Field("object", nullable=True),
}
BOX_FIELDS = {
    "format": _choice(["xyxy"], required=True),
    "x1": Field("integer", required=True, minimum=0),
    "y1": Field("integer", required=True, minimum=0),
    "x2": Field("integer", required=True, minimum=1),
    "y2": Field("integer", required=True, minimum=1),
}
GEOMETRY_MODEL_FIELDS = {"model_name": _NULL_TEXT, "model_version": _NULL_TEXT, "confidence": _SHARE}
GEOMETRY_DETAIL_FIELDS = {
    "polygon": Field("array", nullable=True),
    "mask_uri": _NULL_TEXT,
    "mask_format": _choice(vocab.MASK_FORMATS, nullable=True),
    "generation_params": Field("object", nullable=True),
}
CROP_FIELDS = {
    "crop_id": _ID,
    "crop_uri": _ID,
    "crop_box": Field("object", nullable=True),
    "crop_expand_ratio": Field("number", nullable=True, minimum=0),
    "is_valid_crop": Field("boolean"),
}
CLASSIFICATION_FIELDS = {
    "multi_labels": Field("array", required=True),
    "classifier_type": _choice(vocab.CLASSIFIER_TYPES),
    "classifier_name": _NULL_TEXT,
    "classifier_version": _NULL_TEXT,
    "prompt_version": _NULL_TEXT,
    "raw_response": Field("object", nullable=True),
}
LABEL_FIELDS = {"label_key": _ID, "label_value": _ID, "confidence": _SHARE, "evidence": _NULL_TEXT}
QUALITY_CHECK_FIELDS = {
    "qc_sampled": Field("boolean"),
    "qc_status": _choice(vocab.QC_STATUSES, nullable=True),
    "reviewed_labels": Field("array", nullable=True),
    "issue_flags": Field("array"),
    "reviewer": _NULL_TEXT,
    "review_time": _NULL_TIME,
    "comment": _NULL_TEXT,
}
REVIEWED_LABEL_FIELDS = {"label_key": Field("string"), "label_value": Field("string")}
QC_POLICY_FIELDS = {
    "qc_mode": _choice(vocab.QC_MODES),
    "sampling_ratio": _SHARE,
    "sampling_method": _choice(vocab.SAMPLING_METHODS),
    "fail_policy": _choice(vocab.FAIL_POLICIES),
    "qc_batch_id": _NULL_TEXT,
}
WORKFLOW_FIELDS = {
    "workflow_status": _choice(vocab.WORKFLOW_STATUSES, required=True),
    "pipeline_id": _NULL_TEXT,
    "pipeline_version": _NULL_TEXT,
    "created_time": _NULL_TIME,
    "updated_time": _NULL_TIME,
}
EXPORT_FIELDS = {
    "export_format": _choice(vocab.EXPORT_FORMATS, required=True),
    "export_status": _choice(vocab.EXPORT_STATUSES, required=True),
    "export_uri": _NULL_TEXT,
    "labelstudio_mapping": Field("object", nullable=True),
}
ISO_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def _finding(broken: Column, path: Column, rule: str, detail: Column) -> Column:
    return F.when(
        F.coalesce(broken, F.lit(False)),
        F.struct(path.alias("path"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail")),
    )


def _is_kind(value: Column, wanted: str) -> Column:
    """Whether a value is of a JSON kind; objects and arrays are told without writing out their schema."""
    if wanted == "object":
        return is_object(value)
    if wanted == "array":
        return is_array(value)
    kind = kind_of(value)
    if wanted in ("string", "boolean"):
        return kind == {"string": "STRING", "boolean": "BOOLEAN"}[wanted]
    numeric = let(kind, lambda k: k.isin("BIGINT", "DOUBLE", "FLOAT") | k.startswith("DECIMAL"))
    number = F.try_variant_get(value, "$", "double")
    return numeric if wanted == "number" else F.when(numeric, number == F.rint(number)).otherwise(F.lit(False))


def _field_finding(value: Column, name: str, rules: Field, prefix: Column) -> Column:
    """The finding on one key, null if it is as it should be: missing, else its kind, else the first bound it breaks."""
    path = F.concat(prefix, F.lit(name))
    text, number = F.try_variant_get(value, "$", "string"), F.try_variant_get(value, "$", "double")
    bounds = []
    if rules.minimum is not None:
        bounds.append(_finding(number < rules.minimum, path, "minimum", text))
    if rules.maximum is not None:
        bounds.append(_finding(number > rules.maximum, path, "maximum", text))
    if rules.choices is not None:
        bounds.append(_finding(~text.isin(rules.choices), path, "enum", text))
    if rules.min_length:
        bounds.append(_finding(F.length(text) < rules.min_length, path, "minLength", text))
    if rules.is_time:
        bounds.append(_finding(~text.rlike(ISO_TIME), path, "format", text))
    nothing = null(FINDING)
    missing = _finding(F.lit(True), path, "required", F.lit(None)) if rules.required else nothing
    wrong = _finding(F.lit(True), path, "type", kind_of(value))
    if rules.nullable:
        wrong = F.when(~is_explicit_null(value), wrong)
    fits = F.coalesce(*bounds) if bounds else nothing
    return F.when(value.isNull(), missing).when(_is_kind(value, rules.kind), fits).otherwise(wrong)


def _object_findings(value: Column, fields: dict[str, Field], prefix: Column, *nested: Callable[[Column], Column]) -> Column:
    """Findings on one object; nothing when it is absent, null or no object.

    `nested` give the findings below it from its members, which are taken apart once.
    """
    nothing = F.array().cast(f"array<{FINDING}>")

    def inspect(held: Column) -> Column:
        # values are not needed for names, and this type leaves them unread
        names = F.map_keys(F.try_variant_get(value, "$", "map<string,struct<`-`:variant>>"))
        unknown = F.transform(
            F.array_sort(F.array_except(names, F.array(*[F.lit(name) for name in fields]))),
            lambda key: F.struct(
                F.concat(prefix, key).alias("path"),
                F.lit("additionalProperties").alias("rule"),
                null("string").alias("detail"),
            ),
        )
        own = _listed(*[_field_finding(held.getField(name), name, rules, prefix) for name, rules in fields.items()])
        below = [F.coalesce(part(held), nothing) for part in nested]
        return F.when(held.isNotNull(), F.concat(unknown, own, *below)).otherwise(nothing)

    return _opened(value, fields, inspect)


def _each(array: Column, check) -> Column:
    return F.flatten(F.transform(items_of(array), check))


def _labels(name: str, fields: dict[str, Field], prefix: Column) -> Callable[[Column], Column]:
    def check(value: Column, j: Column) -> Column:
        return _object_findings(value, fields, F.concat(prefix, F.lit(f"{name}["), j.cast("string"), F.lit("].")))

    return lambda held: _each(held.getField(name), check)


def _polygon(prefix: Column) -> Callable[[Column], Column]:
    def check(point: Column, j: Column) -> Column:
        numbers = F.try_variant_get(point, "$", "array<double>")
        holds = (F.size(numbers) == 2) & ~F.exists(numbers, lambda n: n.isNull())
        path = F.concat(prefix, F.lit("polygon["), j.cast("string"), F.lit("]"))
        return _listed(_finding(~F.coalesce(holds, F.lit(False)), path, "items", F.to_json(point)))

    return lambda held: _each(held.getField("polygon"), check)


def _under(name: str, fields: dict[str, Field], prefix: Column, *below: Callable[[Column], Callable[[Column], Column]]) -> Callable[[Column], Column]:
    """Findings on the member `name`; each of `below` takes the member's prefix and gives a check of its members."""
    inner = F.concat(prefix, F.lit(f"{name}."))
    return lambda held: _object_findings(held.getField(name), fields, inner, *[part(inner) for part in below])


def _document_object_findings(obj: Column, i: Column) -> Column:
    prefix = F.concat(F.lit("objects["), i.cast("string"), F.lit("]."))
    return _object_findings(
        obj,
        OBJECT_FIELDS,
        prefix,
        _under("box", BOX_FIELDS, prefix),
        _under("geometry_model", GEOMETRY_MODEL_FIELDS, prefix),
        _under("geometry_detail", GEOMETRY_DETAIL_FIELDS, prefix, _polygon),
        _under("crop", CROP_FIELDS, prefix, lambda inner: _under("crop_box", BOX_FIELDS, inner)),
        _under("classification", CLASSIFICATION_FIELDS, prefix, lambda inner: _labels("multi_labels", LABEL_FIELDS, inner)),
        _under("quality_check", QUALITY_CHECK_FIELDS, prefix, lambda inner: _labels("reviewed_labels", REVIEWED_LABEL_FIELDS, inner)),
    )


def schema_findings(document: Column) -> Column:
    """array<struct<path, rule, detail>>: where a raw document (VARIANT) departs from the schema."""
    top = F.lit("")
    return _object_findings(
        document,
        DOCUMENT_FIELDS,
        top,
        _under(
            "image_asset",
            IMAGE_ASSET_FIELDS,
            top,
            lambda inner: _under("source_context", SOURCE_CONTEXT_FIELDS, inner),
            lambda inner: _under("scene_context", SCENE_CONTEXT_FIELDS, inner),
        ),
        lambda held: _each(held.getField("objects"), _document_object_findings),
        _under("qc_policy", QC_POLICY_FIELDS, top),
        _under("workflow", WORKFLOW_FIELDS, top),
        _under("export", EXPORT_FIELDS, top),
    )


# --- ingest -----------------------------------------------------------------------------------------


def check_generated(samples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples of the generation branch, and those of another source type with `error`."""
    generated = F.coalesce(F.col("image_asset.source_type") == "generated", F.lit(False))
    error = F.concat(F.lit("Expected generated source_type: "), F.coalesce("sample_id", F.lit("")))
    return samples.filter(generated), samples.filter(~generated).withColumn("error", error)
