"""Fixed values. Results only match when these are exactly as written here."""

SOURCE_TYPES = ["generated", "human_staged", "cctv", "robot_dog", "manual_upload"]
GEOMETRY_SOURCES = ["detector", "segmentation_model", "synthetic_generator", "human_annotation"]
CLASSIFIER_TYPES = ["vlm", "classifier", "rule", "human"]
WORKFLOW_STATUSES = [
    "raw",
    "boxed",
    "cropped",
    "classified",
    "sampling_selected",
    "qc_in_progress",
    "qc_completed",
    "export_ready",
    "exported",
    "discarded",
]
EXPORT_FORMATS = ["labelstudio", "coco", "yolo", "custom"]
EXPORT_STATUSES = ["not_exported", "exported", "failed"]
MASK_FORMATS = ["png", "rle", "coco_rle"]
QC_STATUSES = ["pending", "passed", "failed", "corrected", "discarded"]
QC_MODES = ["none", "sampling", "full_inspection"]
SAMPLING_METHODS = ["random", "stratified", "risk_based"]
FAIL_POLICIES = ["pass_only_sample", "batch_rework", "relabel_failed_only"]

IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".bmp", ".webp"]
VIDEO_SUFFIXES = [".mp4", ".avi", ".mov", ".mkv", ".flv", ".wmv"]

MANIFEST_FIELDS = [
    "sample_id",
    "image_id",
    "image_uri",
    "source_type",
    "task_mode",
    "task_key",
    "object_type",
    "anomaly_type",
    "site",
    "building",
    "floor",
    "room_name",
    "room_type",
    "task_group",
    "inspection_content",
    "collection_batch",
    "camera_id",
    "capture_time",
    "width",
    "height",
]
GENERATION_TASK_FIELDS = [
    "sample_id",
    "image_id",
    "image_uri",
    "anomaly_type",
    "source_type",
    "site",
    "building",
    "floor",
    "room_name",
    "room_type",
    "collection_batch",
    "camera_id",
    "capture_time",
]
REQUIRED_MANIFEST_FIELDS = ["sample_id", "image_id", "image_uri", "source_type"]
SOURCE_CONTEXT_FIELDS = [
    "generation_prompt",
    "generation_model",
    "collection_batch",
    "camera_id",
    "capture_time",
]
SCENE_CONTEXT_FIELDS = [
    "site",
    "building",
    "floor",
    "room_name",
    "room_type",
    "task_group",
    "inspection_content",
]

# Object ids a model copies from its instructions instead of inventing one.
PLACEHOLDER_IDS = ["", "自动生成的唯一ID", "unique_id", "auto_id", "id"]

# answer key, label key, value when true, value when false
BOOLEAN_LABELS = [
    ("safety_harness", "safety_belt", "wearing_safety_belt", "no_safety_belt"),
    ("hard_hat", "helmet", "wearing_helmet", "no_helmet"),
    ("reflective_vest", "reflective_vest", "wearing_reflective_vest", "no_reflective_vest"),
    ("safety_shoes", "safety_shoes", "wearing_safety_shoes", "no_safety_shoes"),
    ("smoking", "smoking", "smoking", "not_smoking"),
    ("falling_down", "falling", "falling", "not_falling"),
    ("sleeping_on_duty", "sleeping", "sleeping", "not_sleeping"),
    ("climbing_over_railing", "climbing_over_railing", "climbing_over_railing", "not_climbing_over_railing"),
    ("touching_equipment", "touching_equipment", "touching_equipment", "not_touching_equipment"),
    ("fighting", "fighting", "fighting", "not_fighting"),
    ("using_phone", "phone_usage", "using_phone", "not_using_phone"),
    ("safety_goggles", "safety_goggles", "wearing_safety_goggles", "no_safety_goggles"),
]
ANSWER_KEYS = [row[0] for row in BOOLEAN_LABELS]

DEFAULT_EVIDENCE = "vlm classification"
NOTE_MISSING_KEY = "模型未返回该字段，按规则置为 false"
NOTE_NOT_BOOLEAN = "字段不是布尔值，按规则置为 false"
NOTE_NO_EXPLICIT_VALUE = "fallback parser did not find an explicit value"
PROSE_PARSER_TAG = "fallback_text_boolean_parser"
PROSE_MODE_TAG = "text_fallback"
CROP_TOO_SMALL = "crop 尺寸过小，跳过 VLM 分类"
CROP_BAD_SIZE = "crop 尺寸无效，跳过 VLM 分类"
CROP_BAD_ASPECT = "crop 长宽比异常，跳过 VLM 分类"
INVALID_CROP = "invalid_crop_geometry"
CROP_GUARD_REVIEWER = "classification_crop_guard"
MISSING_CROP_URI = "missing crop.crop_uri"
NOT_AN_OBJECT = "classification response is not a JSON object"

RULE_LABELS = [("helmet", "unknown"), ("reflective_vest", "unknown"), ("phone_usage", "unknown")]
RULE_EVIDENCE = "dry-run classification placeholder"
RULE_CLASSIFIER_NAME = "dry_run_rule_classifier"
RULE_CLASSIFIER_VERSION = "v1"
RULE_PROMPT_VERSION = "dry_run"
RULE_REASON = "model key is not configured; validating DAG and data contract only"

OBJECT_DISPLAY_LABELS = {
    "person": "Person",
    "equipment": "Equipment",
    "fire_extinguisher": "Fire Extinguisher",
    "ground_area": "Ground Area",
    "yellow_black_line": "Yellow Black Line",
    "pipe": "Pipe",
    "support": "Support",
    "cable": "Cable",
    "leakage_area": "Leakage Area",
}
LABEL_CHOICES = {
    "helmet": ["unknown", "wearing_helmet", "no_helmet"],
    "reflective_vest": ["unknown", "wearing_reflective_vest", "no_reflective_vest"],
    "safety_belt": ["unknown", "wearing_safety_belt", "no_safety_belt"],
    "safety_shoes": ["unknown", "wearing_safety_shoes", "no_safety_shoes"],
    "smoking": ["unknown", "smoking", "not_smoking"],
    "sleeping": ["unknown", "sleeping", "not_sleeping"],
    "falling": ["unknown", "falling", "not_falling"],
    "phone_usage": ["unknown", "using_phone", "not_using_phone"],
    "climbing_over_railing": ["unknown", "climbing_over_railing", "not_climbing_over_railing"],
    "touching_equipment": ["unknown", "touching_equipment", "not_touching_equipment"],
    "fighting": ["unknown", "fighting", "not_fighting"],
    "safety_goggles": ["unknown", "wearing_safety_goggles", "no_safety_goggles"],
    "anomaly_type": ["unknown", "diesel_leak", "oil_leak", "coolant_leak"],
}
DEFAULT_RECTANGLE_LABEL = "Person"
REGION_HEADER = "区域分类标签"

# Values stored inside every detected object's provenance record.
DETECTOR_BACKEND = "vlm_labelstudio_detector"
OBJECT_CONTRACT = "AutoLabelSample.objects[]"
RECTANGLE_SOURCE_FORMAT = "labelstudio_rectangle"

DEFAULT_PIPELINE_ID = "autolabel_dag_v1"
DEFAULT_PIPELINE_VERSION = "0.1.0"
DEFAULT_MODEL_VERSION = "autolabel"
DEFAULT_PROMPT_VERSION = "crop_industrial_safety_v2"
DETECTION_PARSE_ERROR = "VLMJsonParseError"
ANSWER_PARSE_ERROR = "ClassificationJsonParseError"
