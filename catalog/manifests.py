"""Assets, manifests, routing and generation tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import shared_path, vocab
from boxloom.functions import text
from boxloom.operators import routing, samples
from boxloom.params import QcPolicy, Run
from boxloom.plans.generated import generation_tasks
from boxloom.sources import assets, manifest as csv
from catalog.inputs import Tables, with_inputs
from catalog.registry import query

RUN = Run(now="2026-05-08T10:00:00+08:00", now_utc="2026-05-08T02:00:00Z")

# --- assets: page addresses as file paths -----------------------------------------------------------

ASSET_PATH = """concat('raw/', page_id % 7, '/', translate(url, ':?#=', '____'), CASE page_id % 11 WHEN 0 THEN '.jpg'
  WHEN 1 THEN '.JPEG' WHEN 2 THEN '.png' WHEN 3 THEN '.webp' WHEN 4 THEN '.mp4' WHEN 5 THEN '.MKV' WHEN 6 THEN '.txt'
  WHEN 7 THEN '' WHEN 8 THEN '.bmp' WHEN 9 THEN '/.jpg' ELSE '.mov' END)"""
ASSETS = {
    "page_id": "page_id",
    "path": ASSET_PATH,
    "total_frames": "page_id % 5000",
    "width": "CAST(100 + page_id % 900 AS INT)",
    "height": "CAST(80 + page_id % 700 AS INT)",
}
ASSET_SQL = f"SELECT {', '.join(f'{v} AS {k}' for k, v in ASSETS.items())} FROM pages"
NAME_SQL = "regexp_extract(path, '[^/]*$')"
NAMED_SQL = f"""SELECT *, CASE WHEN ending IN ('.jpg', '.jpeg', '.png', '.bmp', '.webp') THEN 'image'
  WHEN ending IN ('.mp4', '.avi', '.mov', '.mkv', '.flv', '.wmv') THEN 'video' END AS kind,
  coalesce(nullif(trim(regexp_replace(left(name, length(name) - length(ending)), '[^0-9A-Za-z_.-]+', '_', 'g'), '._-'), ''),
    'item') AS slug
  FROM (SELECT *, lower(regexp_extract(name, '^.+([.][^.]+)$', 1)) AS ending FROM (SELECT *, {NAME_SQL} AS name
  FROM ({ASSET_SQL})))"""
MANIFEST_TAIL = """'direct' AS task_mode, '' AS task_key, '' AS object_type, '' AS anomaly_type,
  CAST(width AS INT) AS width, CAST(height AS INT) AS height"""
IMAGE_SQL = f"""SELECT concat('sample_', slug) AS sample_id, slug AS image_id, concat('staging/', name) AS image_uri,
  'manual_upload' AS source_type, {MANIFEST_TAIL} FROM ({NAMED_SQL}) WHERE kind = 'image'"""
FRAME_SQL = f"""SELECT *, unnest(range(0, total_frames, 30)) AS frame_no FROM ({NAMED_SQL})
  WHERE kind = 'video' AND total_frames > 0"""
FRAME_NAME = "concat(slug, '_frame_', CASE WHEN frame_no < 1000000 THEN lpad(CAST(frame_no AS VARCHAR), 6, '0') ELSE CAST(frame_no AS VARCHAR) END)"
FRAME_MANIFEST_SQL = f"""SELECT concat('sample_', frame) AS sample_id, frame AS image_id,
  concat('staging/', slug, '/', frame, '.jpg') AS image_uri, 'cctv' AS source_type, {MANIFEST_TAIL}
  FROM (SELECT *, {FRAME_NAME} AS frame FROM ({FRAME_SQL}))"""


def listed(t: Tables, kind: str) -> DataFrame:
    return t.derive("pages", ASSETS).filter(assets.asset_kind(F.col("path")) == kind)


def images(t: Tables) -> DataFrame:
    return assets.image_manifest(listed(t, "image"), sequence_dir="staging")


def frames(t: Tables) -> DataFrame:
    return assets.frame_manifest(assets.sample_frames(listed(t, "video")), "staging")


@query("io1_asset_kind", f"SELECT page_id, path, kind FROM ({NAMED_SQL}) WHERE kind IS NOT NULL")
def io1(t: Tables) -> DataFrame:
    kind = assets.asset_kind(F.col("path"))
    rows = t.derive("pages", ASSETS).select("page_id", "path", kind.alias("kind"))
    return rows.filter(F.col("kind").isNotNull()).orderBy("path")


@query("io2_image_manifest", IMAGE_SQL)
def io2(t: Tables) -> DataFrame:
    return images(t)


@query("io3_frame_manifest", FRAME_MANIFEST_SQL)
def io3(t: Tables) -> DataFrame:
    return frames(t)


VIDEO_SQL = "SELECT p_partkey AS video_id, CAST(p_size AS BIGINT) * 100 AS total_frames FROM part"


def videos(t: Tables) -> DataFrame:
    return t.derive("part", {"video_id": "p_partkey", "total_frames": "CAST(p_size AS BIGINT) * 100"})


@query(
    "io4_frame_count",
    f"""SELECT video_id, total_frames, CASE WHEN total_frames <= 0 THEN 0 ELSE (total_frames - 1) // 30 + 1 END AS n_all,
    CASE WHEN total_frames <= 0 THEN 0 ELSE least((total_frames - 1) // 30 + 1, 10) END AS n_capped FROM ({VIDEO_SQL})""",
)
def io4_count(t: Tables) -> DataFrame:
    total = F.col("total_frames")
    return videos(t).select(
        "video_id",
        "total_frames",
        assets.frame_count(total, 30).alias("n_all"),
        assets.frame_count(total, 30, 10).alias("n_capped"),
    )


@query(
    "io4_bad_videos",
    """SELECT p_partkey AS video_id, CASE WHEN p_size % 5 = 0 THEN 'frame count is unknown' ELSE 'video has no frames' END AS error
    FROM part WHERE p_size % 5 = 0 OR p_size % 7 = 0""",
)
def io4_bad(t: Tables) -> DataFrame:
    counts = "CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 7 = 0 THEN 0 ELSE p_size END"
    return assets.bad_videos(t.derive("part", {"video_id": "p_partkey", "total_frames": counts})).select("video_id", "error")


@query("io4_frames", f"SELECT video_id, unnest(range(0, total_frames, 30)) AS frame_no FROM ({VIDEO_SQL})")
def io4_frames(t: Tables) -> DataFrame:
    return assets.sample_frames(videos(t), 30).select("video_id", "frame_no")


@query(
    "w6_frame_cap",
    f"SELECT video_id, frame_no FROM (SELECT video_id, unnest(range(0, total_frames, 30)) AS frame_no FROM ({VIDEO_SQL})) WHERE frame_no < 300",
)
def w6_cap(t: Tables) -> DataFrame:
    return assets.sample_frames(videos(t), 30, max_frames=10).select("video_id", "frame_no")


@query("u1_combined_manifest", f"{IMAGE_SQL} UNION ALL {FRAME_MANIFEST_SQL}")
def u1(t: Tables) -> DataFrame:
    return assets.combine_manifests(images(t), frames(t))


@query(
    "t1_slugify",
    """SELECT page_id, coalesce(nullif(trim(regexp_replace(url, '[^0-9A-Za-z_.-]+', '_', 'g'), '._-'), ''), 'item') AS slug
    FROM pages""",
)
def t1(t: Tables) -> DataFrame:
    return t.read("pages").select("page_id", text.slugify(F.col("url")).alias("slug"))


# --- manifest files ---------------------------------------------------------------------------------


# cells with quotes, commas, line breaks, edge spaces and nulls
MANIFEST_CELLS = {
    "room_name": "CASE WHEN sample_no % 6 = 0 THEN concat('room \"', sample_no, '\", east') ELSE '  hall ' END",
    "inspection_content": "CASE WHEN sample_no % 4 = 0 THEN concat('line', chr(10), 'two') ELSE NULL END",
    "site": "CASE WHEN sample_no % 2 = 0 THEN '园区A' ELSE '' END",
}


def full_manifest(t: Tables) -> DataFrame:
    return t.manifest.selectExpr("*", *[f"{value} AS {name}" for name, value in MANIFEST_CELLS.items()])


FULL_SQL = f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in MANIFEST_CELLS.items())} FROM fx_manifest"
PRESENT = {"sample_id", "image_id", "image_uri", "source_type", "task_mode", "width", "height", *MANIFEST_CELLS}


def stored(fields: list[str]) -> str:
    return ", ".join(
        f"trim(coalesce(CAST({name} AS VARCHAR), '')) AS {name}" if name in PRESENT else f"'' AS {name}"
        for name in fields
    )


@query("io5_manifest_csv", with_inputs(f"SELECT {stored(vocab.MANIFEST_FIELDS)} FROM ({FULL_SQL})", "fx_manifest"))
def io5(t: Tables) -> DataFrame:
    """Written by the sink (IO5) and read back by the source (IO6)."""
    path = shared_path(t.spark, "manifest")
    csv.write_manifest(full_manifest(t), path)
    return csv.read_manifest(t.spark, path)


@query(
    "io9_generation_tasks",
    with_inputs(
        f"SELECT {stored(vocab.GENERATION_TASK_FIELDS)} FROM ({FULL_SQL}) WHERE task_mode = 'generation'", "fx_manifest"
    ),
)
def io9(t: Tables) -> DataFrame:
    path = shared_path(t.spark, "tasks")
    csv.write_generation_tasks(routing.generation_rows(full_manifest(t)), path)
    return csv.read_manifest(t.spark, path)


# --- routing ----------------------------------------------------------------------------------------


@query(
    "p1_direct_rows",
    with_inputs(
        "SELECT sample_id, task_mode FROM fx_manifest WHERE coalesce(nullif(trim(task_mode), ''), 'direct') = 'direct'",
        "fx_manifest",
    ),
)
def p1(t: Tables) -> DataFrame:
    return routing.direct_rows(t.manifest).select("sample_id", "task_mode")


@query(
    "p2_generation_rows",
    with_inputs("SELECT sample_id, task_mode FROM fx_manifest WHERE task_mode = 'generation'", "fx_manifest"),
)
def p2(t: Tables) -> DataFrame:
    return routing.generation_rows(t.manifest).select("sample_id", "task_mode")


@query("p2_without_task_mode", with_inputs("SELECT sample_id FROM fx_manifest", "fx_manifest"))
def p2_all(t: Tables) -> DataFrame:
    return routing.generation_rows(t.manifest.drop("task_mode")).select("sample_id")


HOLES = {
    "sample_id": "CASE WHEN sample_no % 41 = 0 THEN ' ' ELSE sample_id END",
    "image_uri": "CASE WHEN sample_no % 37 = 0 THEN '' ELSE image_uri END",
    "source_type": "CASE WHEN sample_no % 43 = 0 THEN NULL ELSE source_type END",
}
HOLE_SQL = f"SELECT sample_no, image_id, {', '.join(f'{v} AS {k}' for k, v in HOLES.items())} FROM fx_manifest"


@query(
    "p3_required_fields",
    with_inputs(
        f"""SELECT sample_no, CASE WHEN trim(coalesce(sample_id, '')) = '' THEN 'manifest row is missing required field: sample_id'
        WHEN coalesce(image_uri, '') = '' THEN 'manifest row is missing required field: image_uri'
        WHEN coalesce(source_type, '') = '' THEN 'manifest row is missing required field: source_type' END AS error
        FROM ({HOLE_SQL})""",
        "fx_manifest",
    ),
)
def p3(t: Tables) -> DataFrame:
    rows = t.manifest.selectExpr("sample_no", "image_id", *[f"{v} AS {k}" for k, v in HOLES.items()])
    good, bad = routing.split_required(rows)
    return good.select("sample_no", F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("sample_no", "error")
    )


@query(
    "p4_resolved_sizes",
    with_inputs(
        """SELECT sample_id, CASE WHEN width > 0 AND height > 0 THEN width ELSE CAST(100 + sample_no % 500 AS INT) END AS width,
        CASE WHEN width > 0 AND height > 0 THEN height ELSE CAST(90 + sample_no % 400 AS INT) END AS height FROM fx_manifest""",
        "fx_manifest",
    ),
)
def p4(t: Tables) -> DataFrame:
    real = t.manifest.selectExpr(
        "image_uri", "CAST(100 + sample_no % 500 AS INT) AS width", "CAST(90 + sample_no % 400 AS INT) AS height"
    )
    return routing.resolve_sizes(t.manifest, real).select("sample_id", "width", "height")


BASE_SQL = """SELECT sample_id, image_id, image_uri, width, height, source_type, 'raw' AS status,
  'autolabel_dag_v1' AS pipeline_id, '2026-05-08T10:00:00+08:00' AS created_time, 'labelstudio' AS export_format,
  'not_exported' AS export_status, 'batch_rework' AS fail_policy, CAST(0.08 AS DOUBLE) AS sampling_ratio,
  0 AS n_objects FROM fx_manifest"""


@query("p5_base_samples", with_inputs(BASE_SQL, "fx_manifest"))
def p5(t: Tables) -> DataFrame:
    run = Run(RUN.now, RUN.now_utc, qc_policy=QcPolicy(sampling_ratio=0.08))
    return samples.base_samples(t.manifest, run).selectExpr(
        "sample_id",
        "image_asset.image_id AS image_id",
        "image_asset.image_uri AS image_uri",
        "image_asset.width AS width",
        "image_asset.height AS height",
        "image_asset.source_type AS source_type",
        "workflow.workflow_status AS status",
        "workflow.pipeline_id AS pipeline_id",
        "workflow.created_time AS created_time",
        "export.export_format AS export_format",
        "export.export_status AS export_status",
        "qc_policy.fail_policy AS fail_policy",
        "qc_policy.sampling_ratio AS sampling_ratio",
        "size(objects) AS n_objects",
    )


@query(
    "p6_contexts",
    with_inputs(
        f"""SELECT sample_id, nullif(site, '') AS site, nullif(room_name, '') AS room_name, inspection_content,
        CAST(NULL AS VARCHAR) AS camera_id FROM ({FULL_SQL})""",
        "fx_manifest",
    ),
)
def p6(t: Tables) -> DataFrame:
    return samples.base_samples(full_manifest(t), RUN).selectExpr(
        "sample_id",
        "image_asset.scene_context.site AS site",
        "image_asset.scene_context.room_name AS room_name",
        "image_asset.scene_context.inspection_content AS inspection_content",
        "image_asset.source_context.camera_id AS camera_id",
    )


KEY = "CASE sample_no % 4 WHEN 0 THEN 'area_segmenter' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE concat('other_', sample_no % 3) END"


@query(
    "j1_task_routing",
    with_inputs(
        f"""SELECT sample_id, task_key, CASE WHEN task_key IN ('ppe_person', 'area_segmenter', 'other_0') THEN NULL
        ELSE concat('detector is not configured for task_key=', task_key) END AS error
        FROM (SELECT sample_id, coalesce(nullif({KEY}, ''), 'ppe_person') AS task_key FROM fx_manifest)""",
        "fx_manifest",
    ),
)
def j1(t: Tables) -> DataFrame:
    rows = t.manifest.selectExpr("sample_id", f"{KEY} AS task_key")
    known, unknown = routing.split_known_tasks(
        routing.with_task_key(rows, None, "ppe_person"), ["ppe_person", "area_segmenter", "other_0"]
    )
    return known.withColumn("error", F.lit(None).cast("string")).unionByName(unknown)


@query(
    "j9_tasks_to_do",
    with_inputs(
        """SELECT sample_id FROM fx_manifest WHERE task_mode = 'generation' AND sample_id NOT IN
        (SELECT concat('sample_', l_orderkey) FROM lineitem)""",
        "fx_manifest",
    ),
)
def j9(t: Tables) -> DataFrame:
    done = t.derive("lineitem", {"sample_id": "concat('sample_', l_orderkey)"})
    return generation_tasks(t.manifest, existing=done).select("sample_id")


@query(
    "w6_first_tasks",
    with_inputs(
        "SELECT sample_id FROM fx_manifest WHERE task_mode = 'generation' ORDER BY sample_id LIMIT 25", "fx_manifest"
    ),
)
def w6_tasks(t: Tables) -> DataFrame:
    return generation_tasks(t.manifest, limit=25).select("sample_id")


@query(
    "t8_forward_slashes",
    with_inputs("SELECT sample_id, replace(image_uri, chr(92), '/') AS image FROM fx_manifest", "fx_manifest"),
)
def t8(t: Tables) -> DataFrame:
    return t.manifest.select("sample_id", text.forward_slashes(F.col("image_uri")).alias("image"))
