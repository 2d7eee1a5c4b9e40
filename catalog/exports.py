"""Labeling-tool export: results, tasks, state, label vocabulary and configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom import shared_path, vocab
from boxloom.operators import export
from boxloom.plans.counters import store_counts
from boxloom.sources import documents as files
from catalog import scenes as sc
from catalog.inputs import Tables
from catalog.registry import query

DISPLAY = "CASE object_type WHEN 'person' THEN 'Person' ELSE object_type END"
HUNDRED = "CAST(100 AS DOUBLE)"


def share(part: str, size: str) -> str:
    return f"greatest(CAST(0 AS DOUBLE), least({HUNDRED}, CAST({part} AS DOUBLE) / CAST({size} AS DOUBLE) * {HUNDRED}))"


EXPORTED = f"SELECT * FROM ({sc.KEPT_SQL}) WHERE k % 31 > 0"
# answers as labels: which value, and the evidence kept with it
LABEL_ROWS = ", ".join(str(row) for row in vocab.BOOLEAN_LABELS)
CHOICES = f"""SELECT e.*, m.key, m.label_key, CASE WHEN (m.key = 'hard_hat' AND hard_hat) OR (m.key = 'smoking' AND smoking
    AND hard_hat IS NULL) THEN m.yes ELSE m.no END AS choice,
  CASE WHEN hard_hat IS NULL THEN CASE WHEN m.key = 'smoking' THEN concat('smoking: (', smoking, ')')
      ELSE '{vocab.NOTE_NO_EXPLICIT_VALUE}' END
    WHEN m.key = 'hard_hat' THEN 'vlm classification' WHEN m.key = 'smoking' THEN concat('n', s % 9)
    ELSE '{vocab.NOTE_MISSING_KEY}' END AS evidence
  FROM ({EXPORTED}) e CROSS JOIN (VALUES {LABEL_ROWS}) m(key, label_key, yes, no) WHERE source_type <> 'generated'"""


def results(t: Tables) -> DataFrame:
    tasks = export.export_tasks(sc.classified(t).drop("part_no"))
    rows = tasks.select("data.sample_id", F.explode(F.get("predictions", F.lit(0))["result"]).alias("r"))
    return rows.withColumn("type", F.try_variant_get("r", "$.type", "string"))


def field(path: str, kind: str, name: str):
    return F.try_variant_get("r", path, kind).alias(name)


@query(
    "e1_rectangle_results",
    f"""SELECT sample_id, object_id AS id, {DISPLAY} AS label, {share("x1", "width")} AS x, {share("y1", "height")} AS y,
    {share("(x2 - x1)", "width")} AS w, {share("(y2 - y1)", "height")} AS h, width AS original_width,
    height AS original_height, x1 AS box_x1, concat('crops/', sample_id, '_', object_id, '.jpg') AS crop_uri FROM ({EXPORTED})""",
)
def e1(t: Tables) -> DataFrame:
    rows = results(t).filter("type = 'rectanglelabels'")
    return rows.select(
        "sample_id",
        field("$.id", "string", "id"),
        field("$.value.rectanglelabels[0]", "string", "label"),
        field("$.value.x", "double", "x"),
        field("$.value.y", "double", "y"),
        field("$.value.width", "double", "w"),
        field("$.value.height", "double", "h"),
        field("$.original_width", "int", "original_width"),
        field("$.original_height", "int", "original_height"),
        field("$.meta.box_xyxy.x1", "int", "box_x1"),
        field("$.meta.crop.crop_uri", "string", "crop_uri"),
    )


@query(
    "e2_choice_results",
    f"""SELECT sample_id, object_id AS id, concat('cls_', label_key) AS from_name, choice, evidence, label_key
    FROM ({CHOICES})""",
)
def e2(t: Tables) -> DataFrame:
    rows = results(t).filter("type = 'choices'")
    return rows.select(
        "sample_id",
        field("$.id", "string", "id"),
        field("$.from_name", "string", "from_name"),
        field("$.value.choices[0]", "string", "choice"),
        field("$.meta.evidence", "string", "evidence"),
        field("$.meta.label_key", "string", "label_key"),
    )


TASKS = f"""SELECT s.sample_id, replace(s.image_uri, chr(92), '/') AS image, '0.1.0' AS model_version,
    CAST(count(e.p) * CASE WHEN s.source_type = 'generated' THEN 1 ELSE 13 END AS INT) AS n_results,
    coalesce(string_agg(e.object_id, ',' ORDER BY e.p), '') AS regions
    FROM ({sc.SCENE_SQL}) s LEFT JOIN ({EXPORTED}) e ON s.sample_id = e.sample_id WHERE s.k % 31 > 0
    GROUP BY s.sample_id, s.image_uri, s.source_type"""


@query("e3_tasks", TASKS)
def e3(t: Tables) -> DataFrame:
    return task_rows(sc.classified(t))


@query("e3_tasks_in_parts", TASKS)
def e3_in_parts(t: Tables) -> DataFrame:
    return task_rows(sc.in_parts(t))


def task_rows(samples: DataFrame) -> DataFrame:
    rows = export.export_tasks(samples).select("data", F.get("predictions", F.lit(0)).alias("p"))
    rectangles = F.filter("p.result", lambda r: F.try_variant_get(r, "$.type", "string") == "rectanglelabels")
    regions = F.transform(rectangles, lambda r: F.try_variant_get(r, "$.id", "string"))
    return rows.select(
        "data.sample_id",
        "data.image",
        "p.model_version",
        F.size("p.result").alias("n_results"),
        F.array_join(regions, ",").alias("regions"),
    )


@query(
    "e4_export_run",
    f"""SELECT s.sample_id, replace(s.image_uri, chr(92), '/') AS image,
    CAST(count(e.p) * CASE WHEN s.source_type = 'generated' THEN 1 ELSE 13 END AS INT) AS n_results,
    CAST(coalesce(sum(e.x2 - e.x1), 0) AS BIGINT) AS box_widths
    FROM ({sc.SCENE_SQL}) s LEFT JOIN ({EXPORTED}) e ON s.sample_id = e.sample_id WHERE s.k % 31 > 0
    GROUP BY s.sample_id, s.image_uri, s.source_type""",
)
def e4(t: Tables) -> DataFrame:
    """Tasks written as sorted, packed JSON lines (IO10) and read back."""
    path = shared_path(t.spark, "export")
    files.write_json_lines(export.ordered_tasks(export.export_tasks(sc.classified(t))), path, "gzip")
    box = "meta struct<box_xyxy:struct<x1:bigint,x2:bigint>>"
    kind = f"data struct<image:string,sample_id:string>, predictions array<struct<result:array<struct<type:string,{box.replace(' ', ':', 1)}>>>>"
    rows = t.spark.read.schema(kind).json(path).select("data.*", F.get("predictions", F.lit(0))["result"].alias("r"))
    rectangles = F.filter("r", lambda o: o["type"] == "rectanglelabels")
    widths = F.transform(rectangles, lambda o: o["meta"]["box_xyxy"]["x2"] - o["meta"]["box_xyxy"]["x1"])
    total = F.aggregate(widths, F.lit(0).cast("bigint"), lambda acc, v: acc + v)
    return rows.select("sample_id", "image", F.size("r").alias("n_results"), total.alias("box_widths"))


@query(
    "w5_task_positions",
    f"SELECT row_number() OVER (ORDER BY sample_id) AS position, sample_id FROM ({sc.SCENE_SQL})",
)
def w5(t: Tables) -> DataFrame:
    """Tasks in their order, by number, so that the order itself is checked."""
    tasks = sc.scenes(t).select(F.struct("sample_id").alias("data"), F.array().cast("array<string>").alias("predictions"))
    return export.task_positions(tasks).select("position", "data.sample_id")


@query(
    "e5_export_state",
    f"""SELECT sample_id, CASE WHEN k % 31 = 0 THEN 'not_exported' ELSE 'exported' END AS export_status,
    CASE WHEN k % 31 > 0 THEN 'out/tasks.json' END AS export_uri,
    CASE WHEN k % 31 = 0 THEN 'discarded' ELSE 'exported' END AS status FROM ({sc.SCENE_SQL})""",
)
def e5(t: Tables) -> DataFrame:
    done = export.mark_exported(sc.classified(t), "out/tasks.json", sc.RUN.now)
    return done.selectExpr(
        "sample_id",
        "export.export_status AS export_status",
        "export.export_uri AS export_uri",
        "workflow.workflow_status AS status",
    )


@query("p10_exportable", f"SELECT sample_id FROM ({sc.SCENE_SQL}) WHERE k % 31 > 0")
def p10(t: Tables) -> DataFrame:
    return sc.classified(t).filter(export.is_exportable()).select("sample_id")


@query("a3_rectangle_labels", f"SELECT DISTINCT {DISPLAY} AS label FROM ({sc.KEPT_SQL})")
def a3(t: Tables) -> DataFrame:
    return export.rectangle_labels(sc.cropped(t)).orderBy("label")


KINDS = "CASE p_partkey % 6 WHEN 0 THEN 'person' WHEN 1 THEN 'leakage_area' WHEN 2 THEN 'yellow_black_line' WHEN 3 THEN NULL ELSE p_type END"


@query(
    "j5_display_labels",
    f"""SELECT p_partkey, CASE kind WHEN 'person' THEN 'Person' WHEN 'leakage_area' THEN 'Leakage Area'
    WHEN 'yellow_black_line' THEN 'Yellow Black Line' ELSE coalesce(kind, 'object') END AS label
    FROM (SELECT p_partkey, {KINDS} AS kind FROM part)""",
)
def j5(t: Tables) -> DataFrame:
    rows = t.derive("part", {"p_partkey": "p_partkey", "kind": KINDS})
    return rows.select("p_partkey", export.display_label(F.col("kind")).alias("label"))


COUNTS = f"""SELECT count(*) AS n_samples, count(*) FILTER (source_type = 'generated') AS n_ingested,
    (SELECT count(*) FROM ({sc.KEPT_SQL})) AS n_objects, count(*) FILTER (k % 31 > 0) AS n_tasks FROM ({sc.SCENE_SQL})"""


@query("a5_store_counts_in_parts", COUNTS)
def a5_in_parts(t: Tables) -> DataFrame:
    return store_counts(sc.in_parts(t))


@query("a5_store_counts", COUNTS)
def a5(t: Tables) -> DataFrame:
    return store_counts(sc.classified(t))


# --- label vocabulary: one label per line item, with new keys, new values and blanks -----------------

LABELS = {
    "document": "concat('sample_', l_orderkey)",
    "object_pos": "l_linenumber",
    "label_pos": "l_partkey * 1000000 + l_suppkey",
    "label_key": """CASE l_partkey % 6 WHEN 0 THEN 'helmet' WHEN 1 THEN 'smoking' WHEN 2 THEN 'custom_a' WHEN 3
      THEN concat('new_', l_partkey % 4) WHEN 4 THEN 'anomaly_type' ELSE '' END""",
    "label_value": """CASE l_suppkey % 9 WHEN 0 THEN 'unknown' WHEN 1 THEN 'wearing_helmet' WHEN 2 THEN '' WHEN 3 THEN 'oil_leak'
      ELSE concat('v & ', l_suppkey % 13) END""",
}
LABEL_SQL = f"""SELECT * FROM (SELECT {", ".join(f"{v} AS {c}" for c, v in LABELS.items())} FROM lineitem)
  WHERE label_key <> '' AND label_value <> ''"""
SHIPPED = ", ".join(
    f"('{key}', {k}, {n}, '{value}')"
    for k, (key, values) in enumerate(vocab.LABEL_CHOICES.items(), 1)
    for n, value in enumerate(values, 1)
)
VOCABULARY = f"""WITH shipped AS (SELECT label_key, CAST(key_position AS BIGINT) AS key_position,
    CAST(position AS BIGINT) AS position, label_value FROM (VALUES {SHIPPED}) v(label_key, key_position, position, label_value)),
  seen AS (SELECT label_key, label_value, min(n) AS first_n FROM (SELECT *, row_number() OVER (ORDER BY document, object_pos,
    label_pos) AS n FROM ({LABEL_SQL})) GROUP BY ALL),
  new_keys AS (SELECT label_key, 13 + row_number() OVER (ORDER BY min(first_n)) AS key_position FROM seen
    WHERE label_key NOT IN (SELECT label_key FROM shipped) GROUP BY label_key),
  starting AS (SELECT * FROM shipped UNION ALL SELECT label_key, key_position, 1, 'unknown' FROM new_keys),
  added AS (SELECT s.label_key, s.label_value, row_number() OVER (PARTITION BY s.label_key ORDER BY s.first_n) AS n FROM seen s
    ANTI JOIN starting b ON s.label_key = b.label_key AND s.label_value = b.label_value),
  bases AS (SELECT label_key, any_value(key_position) AS key_position, count(*) AS n FROM starting GROUP BY label_key),
  vocabulary AS (SELECT * FROM starting UNION ALL SELECT a.label_key, b.key_position, b.n + a.n, a.label_value
    FROM added a JOIN bases b ON a.label_key = b.label_key)"""


def labels(t: Tables) -> DataFrame:
    return t.derive("lineitem", LABELS).filter("label_key <> '' AND label_value <> ''")


@query("a4_label_vocabulary", f"{VOCABULARY} SELECT label_key, key_position, position, label_value FROM vocabulary")
def a4(t: Tables) -> DataFrame:
    return export.label_vocabulary(labels(t))


@query(
    "a4_label_places_in_parts",
    f"""SELECT sample_id AS document, CAST(dense_rank() OVER (PARTITION BY sample_id ORDER BY p) - 1 AS INT) AS object_pos,
    label_key, choice AS label_value FROM ({CHOICES})""",
)
def a4_places(t: Tables) -> DataFrame:
    """First-seen order: objects of later parts count on from those of earlier ones."""
    rows = export.exploded_labels(sc.in_parts(t).filter(export.is_exportable()))
    return rows.select("document", "object_pos", "label_key", "label_value")


@query(
    "a4_scene_labels",
    f"SELECT sample_id AS document, label_key, choice AS label_value, count(*) AS n FROM ({CHOICES}) GROUP BY ALL",
)
def a4_scenes(t: Tables) -> DataFrame:
    rows = export.exploded_labels(sc.classified(t).filter(export.is_exportable()))
    return rows.groupBy("document", "label_key", "label_value").agg(F.count("*").alias("n"))


ESCAPED = "replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
LINES = f"""{VOCABULARY} SELECT line FROM (
  SELECT unnest(['<View>', '  <Image name="image" value="$image"/>', '  <RectangleLabels name="label" toName="image">',
    '  </RectangleLabels>', '  <Header value="{vocab.REGION_HEADER}"/>', '</View>']) AS line
  UNION ALL SELECT concat('    <Label value="', {ESCAPED.format(DISPLAY)}, '"/>') FROM (SELECT DISTINCT object_type FROM ({sc.KEPT_SQL}))
  UNION ALL SELECT concat('  <Choices name="cls_', {ESCAPED.format("label_key")},
    '" toName="image" perRegion="true" choice="single" showInline="true">') FROM bases
  UNION ALL SELECT '  </Choices>' FROM bases
  UNION ALL SELECT concat('    <Choice value="', {ESCAPED.format("label_value")}, '"/>') FROM vocabulary)"""


@query("e6_label_config", LINES)
def e6(t: Tables) -> DataFrame:
    lines = export.label_config_lines(export.rectangle_labels(sc.cropped(t)), export.label_vocabulary(labels(t)))
    return lines.orderBy("section", "key_position", "position").select("line")


