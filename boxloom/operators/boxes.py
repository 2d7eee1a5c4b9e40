"""Box quality filter and crop metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions.geometry import aspect_ratio, box_height, box_width, expand_box
from boxloom.operators.objects import map_objects
from boxloom.params import BoxFilter, CropGuard
from boxloom import vocab


def drop_reason(confidence: Column, box: Column, rules: BoxFilter) -> Column:
    """First reason to drop a detected box; null keeps it. An unknown confidence passes."""
    width, height = box_width(box), box_height(box)
    area = width.cast("bigint") * height.cast("bigint")
    reason = (
        F.when(confidence < rules.min_confidence, F.lit("low_confidence"))
        .when((width <= 0) | (height <= 0), F.lit("invalid_box"))
        .when(
            (width < rules.min_width) | (height < rules.min_height) | (area < rules.min_area),
            F.lit("tiny_box"),
        )
    )
    if rules.max_aspect_ratio:
        reason = reason.when(aspect_ratio(width, height) > rules.max_aspect_ratio, F.lit("extreme_aspect_ratio"))
    return reason


def object_drop_reason(obj: Column, rules: BoxFilter) -> Column:
    return drop_reason(obj.getField("geometry_model").getField("confidence"), obj.getField("box"), rules)


def filter_boxes(samples: DataFrame, rules: BoxFilter) -> DataFrame:
    """Keep good boxes inside each row; no shuffle."""
    return samples.withColumn("objects", F.filter("objects", lambda o: object_drop_reason(o, rules).isNull()))


def dropped_boxes(samples: DataFrame, rules: BoxFilter) -> DataFrame:
    """sample_id, drop_reason, n of the boxes `filter_boxes` removes; only the reasons are exploded."""
    reasons = F.array_compact(F.transform("objects", lambda o: object_drop_reason(o, rules)))
    return (
        samples.select("sample_id", F.explode(reasons).alias("drop_reason"))
        .groupBy("sample_id", "drop_reason")
        .agg(F.count("*").alias("n"))
    )


def crop_struct(
    sample_id: Column, object_id: Column, box: Column, width: Column, height: Column, crop_dir: str, ratio: float
) -> Column:
    crop_id = F.concat(sample_id, F.lit("_"), object_id)
    return F.struct(
        crop_id.alias("crop_id"),
        F.concat(F.lit(crop_dir.rstrip("/") + "/"), crop_id, F.lit(".jpg")).alias("crop_uri"),
        expand_box(box, width, height, ratio).alias("crop_box"),
        F.lit(float(ratio)).alias("crop_expand_ratio"),
        F.lit(True).alias("is_valid_crop"),
    )


def attach_crops(
    samples: DataFrame,
    crop_dir: str,
    ratio: float,
    width: Column | None = None,
    height: Column | None = None,
) -> DataFrame:
    """Crop metadata on every object, clipped to the image size (pass real sizes when known)."""
    width = F.col("image_asset.width") if width is None else width
    height = F.col("image_asset.height") if height is None else height
    return map_objects(
        samples,
        lambda o: o.withField(
            "crop",
            crop_struct(
                F.col("sample_id"), o.getField("object_id"), o.getField("box"), width, height, crop_dir, ratio
            ),
        ),
    )


def crop_problem(box: Column, guard: CropGuard) -> Column:
    """Why a crop is not worth classifying; null when it is."""
    width, height = box_width(box), box_height(box)
    reason = F.when((width < guard.min_width) | (height < guard.min_height), F.lit(vocab.CROP_TOO_SMALL)).when(
        (width <= 0) | (height <= 0), F.lit(vocab.CROP_BAD_SIZE)
    )
    if guard.max_aspect_ratio > 0:
        reason = reason.when(aspect_ratio(width, height) > guard.max_aspect_ratio, F.lit(vocab.CROP_BAD_ASPECT))
    return reason
