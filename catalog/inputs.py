"""Annotation inputs derived from the driver tables, once for Spark and once as SQL.

Every derivation is row by row (plus one join for answers), so its size follows the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

MANIFEST = {
    "sample_no": "o_orderkey",
    "sample_id": "concat('sample_', o_orderkey)",
    "image_id": "concat('img_', o_orderkey)",
    "image_uri": "concat('raw', chr(92), 'images', chr(92), 'img_', o_orderkey, '.jpg')",
    "source_type": """CASE o_orderkey % 5 WHEN 0 THEN 'generated' WHEN 1 THEN 'human_staged' WHEN 2 THEN 'cctv'
        WHEN 3 THEN 'robot_dog' ELSE 'manual_upload' END""",
    "task_mode": """CASE WHEN o_orderkey % 11 = 0 THEN 'generation' WHEN o_orderkey % 11 = 1 THEN ''
        WHEN o_orderkey % 11 = 2 THEN NULL ELSE 'direct' END""",
    "width": "CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE 640 + 80 * (o_orderkey % 17) END AS INT)",
    "height": "CAST(480 + 60 * (o_orderkey % 13) AS INT)",
}
DETECTIONS = {
    "sample_id": "concat('sample_', l_orderkey)",
    "pos": """CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate) AS INT)""",
    "confidence": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount * CAST(10 AS DOUBLE) END",
    "label": "CASE WHEN l_returnflag = 'N' THEN 'Person' WHEN l_returnflag = 'A' THEN 'person' ELSE 'Vehicle' END",
    "x": "CAST(l_partkey % 1000 AS DOUBLE) / 10",
    "y": "CAST(l_suppkey % 100 AS DOUBLE)",
    "bw": "l_quantity",
    "bh": "l_tax * CAST(1000 AS DOUBLE)",
}
# The same boxes without the ordinal, for operators that look at one box at a time.
BOXES = {name: text for name, text in DETECTIONS.items() if name != "pos"} | {
    "line": "l_linenumber",
    "width": "CAST(640 + 80 * (l_orderkey % 17) AS INT)",
    "height": "CAST(480 + 60 * (l_orderkey % 13) AS INT)",
}
RESPONSES = {
    "event_id": "event_id",
    "sample_id": "concat('sample_', user_id)",
    "attempt": "CAST(event_id % 3 + 1 AS INT)",
    "event_type": "event_type",
    "value": "value",
    "raw_text": """CASE event_type
        WHEN 'view' THEN concat('{"contains_person": ', CASE WHEN value > 20 THEN 'true' ELSE 'false' END,
            ', "is_complete_visible_person": true, "missing_parts": [], "reason": ""}')
        WHEN 'click' THEN concat('```json', chr(10),
            '{"contains_person": true, "is_complete_visible_person": false, "missing_parts": ["feet"], "reason": "cut"}',
            chr(10), '```')
        WHEN 'signup' THEN concat('result: {"contains_person": true, "is_complete_visible_person": true} end ', event_id)
        WHEN 'purchase' THEN '[{"contains_person": false}, oops'
        ELSE concat('no json {here ', event_id) END""",
}
ANSWERS = {
    "doc_id": "d.doc_id",
    "sample_id": "concat('sample_', d.doc_id)",
    "raw_text": """CASE WHEN l.doc_id IS NULL
        THEN concat('**hard_hat**: visible -> true. smoking: none (false). id ', d.doc_id)
        ELSE concat('{"hard_hat": ', CASE WHEN l.quality = 1 THEN 'true' ELSE 'false' END,
            ', "smoking": ', CASE WHEN l.toxic = 1 THEN '"true"' ELSE 'false' END,
            ', "notes": {"smoking": "n', d.doc_id % 7, '"}}') END""",
}
DOCUMENTS = {
    "sample_no": "o_orderkey",
    "raw_json": """concat('{"sample_id": "', CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE concat('sample_', o_orderkey) END,
        '", "image_asset": {"image_id": "img_', o_orderkey, '", "image_uri": "a.jpg", "width": ',
        CASE WHEN o_orderkey % 17 = 0 THEN '0' ELSE '1000' END,
        ', "height": 500, "source_type": "', CASE WHEN o_orderkey % 19 = 0 THEN 'drone' ELSE 'cctv' END, '"',
        CASE o_orderkey % 3 WHEN 0 THEN ', "scene_context": null' WHEN 1 THEN ', "scene_context": {"site": "A"}' ELSE '' END,
        '}, "objects": [{"object_id": "p1", "object_type": "person", "box": {"format": "xyxy", "x1": 10, "y1": 10, "x2": ',
        CASE WHEN o_orderkey % 23 = 0 THEN '5' ELSE '90' END,
        ', "y2": 90}, "geometry_source": "detector", "crop": {"crop_id": "c", "crop_uri": "',
        CASE WHEN o_orderkey % 29 = 0 THEN 'pending' ELSE 'c.jpg' END,
        '"}, "classification": {"multi_labels": []}}], "workflow": {"workflow_status": "',
        CASE WHEN o_orderkey % 31 = 0 THEN 'discarded' ELSE 'boxed' END, '"}}')""",
}


def _sql(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{text} AS {name}' for name, text in columns.items())} FROM {source}"


SQL = {
    "fx_manifest": _sql(MANIFEST, "orders"),
    "fx_detections": _sql(DETECTIONS, "lineitem"),
    "fx_boxes": _sql(BOXES, "lineitem"),
    "fx_responses": _sql(RESPONSES, "events"),
    "fx_answers": _sql(ANSWERS, "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"),
    "fx_documents": _sql(DOCUMENTS, "orders"),
}


def with_inputs(sql: str, *names: str) -> str:
    """Prefix a statement with the derivations it reads."""
    return "WITH " + ", ".join(f"{name} AS ({SQL[name]})" for name in names) + " " + sql


class Tables:
    """The driver tables of one scale factor and the inputs derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def read(self, name: str) -> DataFrame:
        """A table; spread over the cores when it arrives as fewer splits (small files only)."""
        table = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        cores = self.spark.sparkContext.defaultParallelism
        return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table

    def derive(self, source: str, columns: dict[str, str]) -> DataFrame:
        return self.read(source).selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])

    @cached_property
    def manifest(self) -> DataFrame:
        return self.derive("orders", MANIFEST)

    @cached_property
    def detections(self) -> DataFrame:
        return self.derive("lineitem", DETECTIONS)

    @cached_property
    def boxes(self) -> DataFrame:
        return self.derive("lineitem", BOXES)

    @cached_property
    def responses(self) -> DataFrame:
        return self.derive("events", RESPONSES)

    @cached_property
    def answers(self) -> DataFrame:
        documents, labels = self.read("documents").alias("d"), self.read("labels").alias("l")
        joined = documents.join(labels, documents.doc_id == labels.doc_id, "left")
        return joined.selectExpr(*[f"{text} AS {name}" for name, text in ANSWERS.items()])

    @cached_property
    def documents(self) -> DataFrame:
        return self.derive("orders", DOCUMENTS)
