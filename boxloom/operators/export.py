"""Labeling-tool tasks and the label configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions.columns import bind, let, literal_map, nonblank
from boxloom.functions.geometry import percent_rect
from boxloom.functions.text import control_name, forward_slashes, xml_escape
from boxloom.operators.ranking import dense_ids, numbered
from boxloom.session import stored


def is_exportable() -> Column:
    """Everything but discarded samples; a missing status is exportable."""
    return F.coalesce(F.col("workflow.workflow_status") != "discarded", F.lit(True))


def display_label(object_type: Column) -> Column:
    kind = F.coalesce(object_type, F.lit("object"))
    return F.coalesce(F.try_element_at(literal_map(vocab.OBJECT_DISPLAY_LABELS), kind), kind)


def rectangle_result(obj: Column, sample_id: Column, width: Column, height: Column) -> Column:
    """The rectangle of one object, with everything known about it under `meta`."""

    def build(rect: Column) -> Column:
        value = F.struct(
            *[rect.getField(name).alias(name) for name in ("x", "y", "width", "height", "rotation")],
            F.array(display_label(obj.getField("object_type"))).alias("rectanglelabels"),
        )
        meta = F.struct(
            sample_id.alias("sample_id"),
            *[obj.getField(name).alias(name) for name in ("object_id", "object_type", "geometry_source")],
            obj.getField("box").alias("box_xyxy"),
            *[obj.getField(name).alias(name) for name in ("crop", "classification", "quality_check")],
        )
        return F.struct(
            obj.getField("object_id").alias("id"),
            F.lit("rectanglelabels").alias("type"),
            F.lit("label").alias("from_name"),
            F.lit("image").alias("to_name"),
            width.alias("original_width"),
            height.alias("original_height"),
            F.lit(0).alias("image_rotation"),
            value.alias("value"),
            meta.alias("meta"),
        )

    return let(percent_rect(obj.getField("box"), width, height), build)


def choice_results(obj: Column, sample_id: Column) -> Column:
    """One choice per label with a key and a value, on the region of its object."""
    labels = F.filter(
        F.coalesce(obj.getField("classification").getField("multi_labels"), F.array()),
        lambda label: nonblank(label.getField("label_key")).isNotNull()
        & nonblank(label.getField("label_value")).isNotNull(),
    )

    def build(label: Column) -> Column:
        meta = F.struct(
            sample_id.alias("sample_id"),
            obj.getField("object_id").alias("object_id"),
            obj.getField("object_type").alias("object_type"),
            *[label.getField(name).alias(name) for name in ("label_key", "confidence", "evidence")],
        )
        return F.struct(
            obj.getField("object_id").alias("id"),
            F.lit("choices").alias("type"),
            control_name(label.getField("label_key")).alias("from_name"),
            F.lit("image").alias("to_name"),
            F.struct(F.array(label.getField("label_value")).alias("choices")).alias("value"),
            meta.alias("meta"),
        )

    return F.transform(labels, build)


def export_tasks(samples: DataFrame) -> DataFrame:
    """One task per exportable sample: `data`, and one prediction whose results list each object's
    rectangle followed by its choices. Results are VARIANT, so each kind keeps just its own keys."""
    sample_id = F.col("sample_id")
    width, height = F.col("image_asset.width"), F.col("image_asset.height")

    def results(obj: Column) -> Column:
        rectangle = F.to_variant_object(rectangle_result(obj, sample_id, width, height))
        choices = F.transform(choice_results(obj, sample_id), lambda c: F.to_variant_object(c))
        return F.concat(F.array(rectangle), choices)

    version = F.coalesce(nonblank(F.col("workflow.pipeline_version")), F.lit(vocab.DEFAULT_MODEL_VERSION))
    kept = [name for name in samples.columns if name in ("document", "part_no")]
    found = F.flatten(F.transform(F.coalesce("objects", F.array()), results))
    # bound, since whoever explodes the results would have them worked out again by the filters that follow from it
    made = bind(
        samples.filter(is_exportable()),
        {
            "data": F.struct(
                forward_slashes(F.col("image_asset.image_uri")).alias("image"), sample_id.alias("sample_id")
            ),
            "predictions": F.array(F.struct(version.alias("model_version"), found.alias("result"))),
        },
        drop=[name for name in samples.columns if name not in kept],
    )
    return made.select(*kept, "data", "predictions")


def ordered_tasks(tasks: DataFrame) -> DataFrame:
    """Tasks sorted by document name where known, else by sample id (a distributed sort)."""
    key = F.col("document") if "document" in tasks.columns else F.col("data.sample_id")
    return tasks.orderBy(key).select("data", "predictions")


def task_positions(tasks: DataFrame) -> DataFrame:
    """Tasks with `position`, from 1, in the order of `ordered_tasks` (document names or sample ids differ)."""
    key = F.col("document") if "document" in tasks.columns else F.col("data.sample_id")
    return dense_ids(tasks.withColumn("_key", key), ["_key"], "position").select("position", "data", "predictions")


def mark_exported(samples: DataFrame, export_uri: str, now: str) -> DataFrame:
    """Export state and workflow status of the exportable samples; discarded ones stay as they are."""
    exported = (
        F.col("export")
        .withField("export_format", F.lit("labelstudio"))
        .withField("export_status", F.lit("exported"))
        .withField("export_uri", F.lit(export_uri))
    )
    moved = (
        F.col("workflow").withField("workflow_status", F.lit("exported")).withField("updated_time", F.lit(now))
    )
    return samples.withColumns(
        {
            "export": F.when(is_exportable(), exported).otherwise(F.col("export")),
            "workflow": F.when(is_exportable(), moved).otherwise(F.col("workflow")),
        }
    )


def rectangle_labels(samples: DataFrame) -> DataFrame:
    """Distinct display labels of all objects; a single default label when there are no objects."""
    found = samples.select(F.explode("objects.object_type").alias("object_type")).distinct()
    labels = stored(found.select(display_label(F.col("object_type")).alias("label")).distinct(), "rectangles")
    default = labels.agg(F.count("*").alias("n")).filter("n = 0")
    return labels.unionByName(default.select(F.lit(vocab.DEFAULT_RECTANGLE_LABEL).alias("label")))


def exploded_labels(samples: DataFrame, order: str = "sample_id") -> DataFrame:
    """Every label with key and value, with its place: document, object and label position."""
    objects = samples.select(
        F.col(order).alias("document"),
        F.posexplode(F.transform("objects", lambda o: o.getField("classification").getField("multi_labels"))).alias(
            "object_pos", "labels"
        ),
    )
    labels = objects.select("document", "object_pos", F.posexplode("labels").alias("label_pos", "label"))
    return labels.select("document", "object_pos", "label_pos", "label.label_key", "label.label_value").filter(
        nonblank(F.col("label_key")).isNotNull() & nonblank(F.col("label_value")).isNotNull()
    )


def label_vocabulary(labels: DataFrame) -> DataFrame:
    """label_key, key_position, position, label_value: the shipped choices, extended by what was seen.

    New values go to the end of their key and new keys, which start with `unknown`, to the end of the
    list, both in first-seen order. Labels are reduced to one row per (key, value) before anything is
    ranked, and ranking is exact for any number of values.
    """
    spark = labels.sparkSession
    first_seen = F.min(F.struct("document", "object_pos", "label_pos"))
    # the corpus is read once; what is left has one row per distinct label
    seen = stored(labels.groupBy("label_key", "label_value").agg(first_seen.alias("first_seen")), "labels")

    shipped = [
        (key, k, n, value)
        for k, (key, values) in enumerate(vocab.LABEL_CHOICES.items(), 1)
        for n, value in enumerate(values, 1)
    ]
    base = spark.createDataFrame(shipped, "label_key string, key_position bigint, position bigint, label_value string")

    known_keys = list(vocab.LABEL_CHOICES)
    choices = F.create_map(
        *[part for key, values in vocab.LABEL_CHOICES.items() for part in (F.lit(key), F.array(*map(F.lit, values)))]
    )
    known_values = F.coalesce(F.try_element_at(choices, F.col("label_key")), F.array(F.lit("unknown")))

    new_keys = (
        seen.filter(~F.col("label_key").isin(known_keys))
        .groupBy("label_key")
        .agg(F.min("first_seen").alias("first_seen"))
    )
    key_places = (
        numbered(new_keys, [], ["first_seen"], "key_position")
        .withColumn("key_position", F.col("key_position") + len(known_keys))
        .drop("first_seen")
    )
    new_values = numbered(
        seen.filter(~F.array_contains(known_values, F.col("label_value"))),
        ["label_key"],
        ["first_seen"],
        "position",
    ).select("label_key", "label_value", (F.col("position") + F.size(known_values)).alias("position"))

    known_places = base.filter("position = 1").select("label_key", "key_position")
    places = known_places.unionByName(key_places)
    columns = ["label_key", "key_position", "position", "label_value"]
    starters = key_places.select(
        "label_key", "key_position", F.lit(1).cast("bigint").alias("position"), F.lit("unknown").alias("label_value")
    )
    return (
        base.unionByName(starters).unionByName(new_values.join(places, "label_key").select(*columns)).select(*columns)
    )


def label_config_lines(rectangles: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """The label configuration (XML) as rows (section, key_position, position, line).

    Sorted by the first three columns the lines are the document; no row or task holds all of it.
    """
    spark = rectangles.sparkSession
    place = "section int, key_position bigint, position string, line string"
    control = xml_escape(control_name(F.col("label_key")))

    def fixed(*lines: tuple[int, str, str]) -> DataFrame:
        return spark.createDataFrame([(section, 0, order, text) for section, order, text in lines], place)

    frame = fixed(
        (0, "0", "<View>"),
        (0, "1", '  <Image name="image" value="$image"/>'),
        (0, "2", '  <RectangleLabels name="label" toName="image">'),
        (2, "0", "  </RectangleLabels>"),
        (2, "1", f'  <Header value="{vocab.REGION_HEADER}"/>'),
        (4, "0", "</View>"),
    )
    rectangle_lines = rectangles.select(
        F.lit(1).alias("section"),
        F.lit(0).cast("bigint").alias("key_position"),
        F.col("label").alias("position"),
        F.concat(F.lit('    <Label value="'), xml_escape(F.col("label")), F.lit('"/>')).alias("line"),
    )
    keys = vocabulary.select("label_key", "key_position").distinct()

    def key_line(position: str, line: Column) -> DataFrame:
        return keys.select(
            F.lit(3).alias("section"), "key_position", F.lit(position).alias("position"), line.alias("line")
        )

    opening = key_line(
        "",
        F.concat(
            F.lit('  <Choices name="'),
            control,
            F.lit('" toName="image" perRegion="true" choice="single" showInline="true">'),
        ),
    )
    values = vocabulary.select(
        F.lit(3).alias("section"),
        "key_position",
        F.format_string("%019d", "position").alias("position"),
        F.concat(F.lit('    <Choice value="'), xml_escape(F.col("label_value")), F.lit('"/>')).alias("line"),
    )
    closing = key_line("~", F.lit("  </Choices>"))
    lines = frame
    for part in (rectangle_lines, opening, values, closing):
        lines = lines.unionByName(part)
    return lines


def write_label_config(lines: DataFrame, path: str) -> None:
    """Sorted text part files which, in name order, are the XML document."""
    lines.orderBy("section", "key_position", "position").select("line").write.text(path)
