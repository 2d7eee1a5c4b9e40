"""Asset listings and the manifest rows made from them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions.text import slugify

LISTING = "path string, modificationTime timestamp, length bigint"


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def suffix(path: Column) -> Column:
    """Lower-case suffix with its dot; empty for dot files and names without one."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    name = file_name(path)
    return F.left(name, F.length(name) - F.length(suffix(path)))


def asset_kind(path: Column) -> Column:
    """`image`, `video`, or null for any other file."""
    ending = suffix(path)
    return F.when(ending.isin(vocab.IMAGE_SUFFIXES), F.lit("image")).when(
        ending.isin(vocab.VIDEO_SUFFIXES), F.lit("video")
    )


def list_assets(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """All files of one kind below `root`; a missing root is an empty listing.

    File contents are never read: only the listing columns are selected. Empty files are not listed.
    """
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LISTING)
    return files.select("path", "modificationTime", "length").filter(asset_kind(F.col("path")) == kind)


def _manifest_columns(image_id: Column, image_uri: Column, source_type: Column) -> list[Column]:
    return [
        F.concat(F.lit("sample_"), image_id).alias("sample_id"),
        image_id.alias("image_id"),
        image_uri.alias("image_uri"),
        source_type.alias("source_type"),
        F.lit("direct").alias("task_mode"),
        F.lit("").alias("task_key"),
        F.lit("").alias("object_type"),
        F.lit("").alias("anomaly_type"),
        F.col("width").cast("int").alias("width"),
        F.col("height").cast("int").alias("height"),
    ]


def image_manifest(
    images: DataFrame, source_type: str = "manual_upload", sequence_dir: str | None = None
) -> DataFrame:
    """Manifest rows of images (`path`, `width`, `height`); `sequence_dir` names where copies live."""
    path = F.col("path")
    uri = path if sequence_dir is None else F.concat(F.lit(sequence_dir.rstrip("/") + "/"), file_name(path))
    return images.select(*_manifest_columns(slugify(stem(path)), uri, F.lit(source_type)))


def frame_count(total_frames: Column, stride: int, max_frames: int | None = None) -> Column:
    """How many frames sampling keeps; none when there are none to sample."""
    _check_stride(stride)
    kept = F.floor((total_frames - 1) / F.lit(stride)) + 1
    if max_frames is not None:
        kept = F.least(kept, F.lit(max_frames).cast("bigint"))
    return F.when(total_frames <= 0, F.lit(0)).otherwise(kept).cast("bigint")


def bad_videos(videos: DataFrame) -> DataFrame:
    """Videos that `sample_frames` cannot sample, with `error`: the frame count is missing or not positive."""
    total = F.col("total_frames").cast("bigint")
    error = F.when(total.isNull(), F.lit("frame count is unknown")).when(total <= 0, F.lit("video has no frames"))
    return videos.withColumn("error", error).filter("error IS NOT NULL")


def sample_frames(videos: DataFrame, stride: int = 30, max_frames: int | None = None) -> DataFrame:
    """One row per kept frame (`frame_no` 0, stride, 2*stride, ...) of videos with `total_frames`.

    Videos without a positive count have none; `bad_videos` reports them.
    """
    _check_stride(stride)
    total = F.col("total_frames").cast("bigint")
    kept = frame_count(total, stride, max_frames)
    ordinals = F.when(kept > 0, F.sequence(F.lit(0).cast("bigint"), kept - 1))
    return videos.select("*", F.explode(ordinals).alias("_ordinal")).select(
        *videos.columns, (F.col("_ordinal") * stride).alias("frame_no")
    )


def frame_manifest(frames: DataFrame, output_dir: str) -> DataFrame:
    """Manifest rows of sampled frames (`path` of the video, `frame_no`, `width`, `height`)."""
    video = slugify(stem(F.col("path")))
    frame = F.format_string("%s_frame_%06d", video, F.col("frame_no"))
    uri = F.concat(F.lit(output_dir.rstrip("/") + "/"), video, F.lit("/"), frame, F.lit(".jpg"))
    return frames.select(*_manifest_columns(slugify(frame), uri, F.lit("cctv")))


def combine_manifests(images: DataFrame, frames: DataFrame) -> DataFrame:
    return images.unionByName(frames)


def image_sizes(spark: SparkSession, root: str) -> DataFrame:
    """`image_uri`, `width`, `height` of the images below `root`; undecodable files have null sizes."""
    images = (
        spark.read.format("image")
        .option("recursiveFileLookup", True)
        .option("dropInvalid", False)
        .load(root)
    )
    return images.select(
        F.regexp_replace("image.origin", "^file:/+", "/").alias("image_uri"),
        F.when(F.col("image.width") > 0, F.col("image.width")).alias("width"),
        F.when(F.col("image.height") > 0, F.col("image.height")).alias("height"),
    )


def _check_stride(stride: int) -> None:
    if stride <= 0:
        raise ValueError("frame stride must be greater than 0")
