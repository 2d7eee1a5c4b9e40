"""The object element: construction, ordinals, ids, and nesting objects under samples.

A working sample row is (sample_id, part_no, image_asset, objects, workflow, ...). Objects carry `pos`,
their 0-based detection ordinal, until `to_documents` strips it. A working row holds at most `part_size`
objects: an image with more is spread over several rows with the same sample_id and increasing part_no, so no
join or group grows with one hot image. Ordinary images are the single part 0. Parts end with the work:
`whole_samples` makes one row of them, which is what documents, tasks, counters and the store are made from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import schema, vocab
from boxloom.functions.columns import null
from boxloom.functions.text import strip

PART_SIZE = 10_000
OBJECTS = f"array<{schema.WORK_OBJECT.simpleString()}>"


def part_of(pos: Column, part_size: int = PART_SIZE) -> Column:
    return F.floor(pos / F.lit(part_size)).cast("int")


def generated_id(prefix: str, ordinal: Column) -> Column:
    return F.format_string(f"{prefix.replace('%', '%%')}_%06d", ordinal)


def object_id(source_id: Column, prefix: str, ordinal: Column) -> Column:
    """The model's own id (text) unless missing or a placeholder; then `<prefix>_<ordinal>`."""
    usable = source_id.isNotNull() & ~strip(source_id).isin(vocab.PLACEHOLDER_IDS)
    return F.when(usable, source_id).otherwise(generated_id(prefix, ordinal))


def empty_classification(classifier_type: str = "vlm") -> Column:
    return F.struct(
        F.array().cast(schema.CLASSIFICATION["multi_labels"].dataType).alias("multi_labels"),
        F.lit(classifier_type).alias("classifier_type"),
        null("string").alias("classifier_name"),
        null("string").alias("classifier_version"),
        null("string").alias("prompt_version"),
        null("variant").alias("raw_response"),
    )


def pending_crop(identifier: Column) -> Column:
    return F.struct(
        F.concat(identifier, F.lit("_crop")).alias("crop_id"),
        F.lit("pending").alias("crop_uri"),
        null(schema.BOX).alias("crop_box"),
        null("double").alias("crop_expand_ratio"),
        F.lit(False).alias("is_valid_crop"),
    )


def make_object(
    pos: Column,
    identifier: Column,
    object_type: Column,
    box: Column,
    geometry_source: Column,
    model_name: str | None = None,
    model_version: str | None = None,
    confidence: Column | None = None,
    polygon: Column | None = None,
    mask_uri: Column | None = None,
    mask_format: Column | None = None,
    generation_params: Column | None = None,
) -> Column:
    """A fresh object: crop pending, nothing classified, no quality check."""

    def given(column: Column | None, kind: str) -> Column:
        return null(kind) if column is None else column

    model = F.struct(
        F.lit(model_name).cast("string").alias("model_name"),
        F.lit(model_version).cast("string").alias("model_version"),
        given(confidence, "double").alias("confidence"),
    )
    detail = F.struct(
        given(polygon, "array<array<double>>").alias("polygon"),
        given(mask_uri, "string").alias("mask_uri"),
        given(mask_format, "string").alias("mask_format"),
        given(generation_params, "variant").alias("generation_params"),
    )
    return F.struct(
        pos.cast("int").alias("pos"),
        identifier.alias("object_id"),
        object_type.alias("object_type"),
        box.alias("box"),
        geometry_source.alias("geometry_source"),
        model.alias("geometry_model"),
        detail.alias("geometry_detail"),
        pending_crop(identifier).alias("crop"),
        empty_classification().alias("classification"),
        null(schema.QUALITY_CHECK).alias("quality_check"),
    )


def split_parts(samples: DataFrame, part_size: int = PART_SIZE) -> DataFrame:
    """Cut rows with very many objects into the parts their positions belong to.

    Narrow: one row in, nearly always the same row out. An object's part follows from its `pos` alone, so
    filters before or after do not move it. `n_parts` tells how many rows the sample has.
    """
    kept = [name for name in samples.columns if name not in ("objects", "part_no", "n_parts")]
    parts = F.array_distinct(F.transform("objects", lambda o: part_of(o["pos"], part_size)))
    pos = F.col("objects")["pos"]
    # the usual row is told by compiled expressions; a null position, with which `array_contains` is null, makes a part of its own
    one = (F.array_min(pos) >= 0) & (F.array_max(pos) < part_size) & ~F.array_contains(pos, F.lit(-1))
    some = F.when((F.size("objects") > 0) & ~F.coalesce(one, F.lit(False)), parts).otherwise(F.array(F.lit(0)))
    split = samples.withColumn("_parts", some).select(
        *kept, "objects", F.size("_parts").alias("n_parts"), F.explode("_parts").alias("part_no")
    )
    own = F.filter("objects", lambda o: part_of(o["pos"], part_size) == F.col("part_no"))
    return split.withColumn("objects", F.when(F.col("n_parts") == 1, F.col("objects")).otherwise(own))


def whole_samples(samples: DataFrame) -> DataFrame:
    """One row per sample: the objects of its parts in order, everything else from its first part.

    One shuffle by sample. Where most samples are single (`n_parts` 1), pass only the others.
    """
    values = [name for name in samples.columns if name not in ("sample_id", "part_no", "n_parts", "objects")]
    parts = F.array_sort(
        F.collect_list(F.struct("part_no", "objects")), lambda a, b: a.getField("part_no") - b.getField("part_no")
    )
    joined = samples.groupBy("sample_id").agg(
        F.min_by(F.struct(*values), "part_no").alias("_first"),
        F.flatten(F.transform(parts, lambda p: p.getField("objects"))).alias("objects"),
    )
    return joined.select("sample_id", "objects", "_first.*").select(
        [name for name in samples.columns if name not in ("part_no", "n_parts")]
    )


def nest_objects(
    samples: DataFrame,
    detections: DataFrame,
    build: Callable[[Column], Column],
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Left join of samples (one row each) with a flat detections table (sample_id, pos, ...).

    `build` makes the element from a detection struct, after grouping, so only the flat columns are
    shuffled. Detections are grouped by (sample_id, part), which bounds every group; a position given
    twice keeps its smallest row. Samples without detections keep an empty array. Part 0 of a sample is
    unique and joins without skew; the few further parts, if any, join separately.
    """
    fields = ["pos", *[name for name in detections.columns if name not in ("sample_id", "pos")]]
    flat = detections.withColumn("pos", F.col("pos").cast("int")).withColumn(
        "part_no", part_of(F.col("pos"), part_size)
    )
    single = flat.groupBy("sample_id", "part_no", "pos").agg(F.min(F.struct(*fields)).alias("_row"))
    grouped = single.groupBy("sample_id", "part_no").agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    built = grouped.select("sample_id", "part_no", F.transform("_rows", build).alias("objects"))
    bare = samples.drop("objects", "part_no")
    first = bare.join(built.filter("part_no = 0").drop("part_no"), "sample_id", "left").withColumn(
        "part_no", F.lit(0)
    )
    further = bare.join(built.filter("part_no > 0"), "sample_id")
    empty = F.array().cast(built.schema["objects"].dataType)
    return first.unionByName(further).withColumn("objects", F.coalesce("objects", empty))


def map_objects(samples: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return samples.withColumn("objects", F.transform("objects", change))


def to_documents(samples: DataFrame) -> DataFrame:
    """Working rows to the document columns: `pos` dropped, everything else unchanged."""
    return map_objects(samples, lambda o: o.dropFields("pos"))
