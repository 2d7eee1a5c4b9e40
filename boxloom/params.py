"""Operator parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from boxloom import vocab


@dataclass(frozen=True)
class BoxFilter:
    """Thresholds for detected boxes; `max_aspect_ratio` 0 switches that rule off."""

    min_confidence: float = 0.0
    min_width: float = 1.0
    min_height: float = 1.0
    min_area: float = 1.0
    max_aspect_ratio: float = 0.0

    @classmethod
    def shipped(cls) -> BoxFilter:
        return cls(0.0, 12, 24, 300, 8.0)


@dataclass(frozen=True)
class CropGuard:
    min_width: int = 4
    min_height: int = 4
    max_aspect_ratio: float = 20.0


@dataclass(frozen=True)
class RectangleService:
    """A detector that answers with labeling-tool rectangle results."""

    object_type_map: dict[str, str] = field(default_factory=dict)
    default_object_type: str = "person"
    object_id_prefix: str = "obj"
    target_label: str = "Person"
    geometry_source: str = "detector"
    model_name: str | None = None
    model_version: str | None = None
    prompt_version: str | None = None
    coordinate_units: str = "auto"
    auto_detect_units: bool = True
    store_raw_response: bool = False


@dataclass(frozen=True)
class BoxService:
    """A detector that answers with `boxes` or `objects` lists under configurable field names."""

    response_format: str = "boxes"
    boxes_field: str = "boxes"
    objects_field: str = "objects"
    label_field: str = "label"
    bbox_field: str = "bbox"
    confidence_field: str = "score"
    object_type_map: dict[str, str] = field(default_factory=dict)
    default_object_type: str = "object"
    geometry_source: str = "detector"
    model_name: str | None = None
    model_version: str | None = None


@dataclass(frozen=True)
class ReviewPolicy:
    target_object_type: str = "person"
    reviewer: str = "vlm_crop_reviewer"
    prompt_version: str = "crop_full_person_review_v1"
    failed_issue_flag: str = "incomplete_person_crop"
    record_passed: bool = False
    drop_failed: bool = False
    drop_incomplete_person: bool = False


@dataclass(frozen=True)
class Classifier:
    classifier_type: str = "vlm"
    classifier_name: str | None = None
    model: str | None = None
    classifier_version: str | None = None
    model_version: str | None = None
    prompt_version: str | None = None
    text_fallback: bool = False
    crop_guard: CropGuard = CropGuard()


@dataclass(frozen=True)
class QcPolicy:
    qc_mode: str = "sampling"
    sampling_ratio: float | None = None
    sampling_method: str = "random"
    fail_policy: str = "batch_rework"
    qc_batch_id: str | None = None


@dataclass(frozen=True)
class ExportDefaults:
    export_format: str = "labelstudio"
    export_status: str = "not_exported"
    export_uri: str | None = None


@dataclass(frozen=True)
class Run:
    """One run's identity; `now` is fixed per run so that a recomputed task writes the same value."""

    now: str
    now_utc: str
    pipeline_id: str | None = vocab.DEFAULT_PIPELINE_ID
    pipeline_version: str | None = vocab.DEFAULT_PIPELINE_VERSION
    qc_policy: QcPolicy | None = None
    export: ExportDefaults = ExportDefaults()


@dataclass(frozen=True)
class DirectPlan:
    services: dict[str, RectangleService | BoxService]
    default_task_key: str | None = None
    boxes: BoxFilter = BoxFilter()
    crop_dir: str = "data/processed/crops"
    crop_expand_ratio: float = 0.0
    review: ReviewPolicy | None = None
    classifier: Classifier = Classifier()
    skip_source_types: tuple[str, ...] = ("generated",)
    max_attempts: int = 3
    on_parse_error: str = "fail"
    #: raise on the first document that breaks the contract instead of returning it as quarantined
    strict: bool = False
    #: objects per working row; results are the same for every value
    part_size: int = 10_000
