"""Cutting crops out of image rows."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.operators.boxes import attach_crops
from boxloom.sources.files import Decoder, decode_png, header_sizes, opened

if TYPE_CHECKING:
    import pandas as pd

UNREADABLE_IMAGE, EMPTY_CROP = "image cannot be read", "box leaves no pixels"
CROP_PIXELS = (
    "sample_id string, object_id string, origin string, height int, width int, nChannels int, mode int, data binary, "
    "error string"
)


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """Decoded images below `root` keyed by `image_uri`, undecodable files left out."""
    images = spark.read.format("image").option("recursiveFileLookup", True).option("dropInvalid", True).load(root)
    return images.select(F.regexp_replace("image.origin", "^file:/+", "/").alias("image_uri"), "image")


def crop_pixels(samples: DataFrame, images: DataFrame, crop_dir: str, ratio: float) -> DataFrame:
    """One image row (Spark's image schema) per object, cut at the box expanded by `ratio`.

    Crops are clipped to the decoded size, not the manifest's. Pixels are joined last and once per
    sample row; the requests travel as one array of small structs. An object whose image is missing or cannot
    be decoded, or whose box leaves no pixels, comes back without pixels and with `error`.
    """
    narrow = samples.select(
        "sample_id", F.col("image_asset.image_uri").alias("image_uri"), "objects"
    ).filter(F.size("objects") > 0)
    joined = narrow.join(images, "image_uri", "left")
    cropped = attach_crops(joined, crop_dir, ratio, F.col("image.width"), F.col("image.height"))
    requests = cropped.select(
        "sample_id",
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.mode").alias("mode"),
        F.col("image.data").alias("data"),
        F.col("objects.object_id").alias("object_ids"),
        F.col("objects.crop.crop_uri").alias("uris"),
        *[F.col(f"objects.crop.crop_box.{name}").alias(name) for name in ("x1", "y1", "x2", "y2")],
    )

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        import pandas as pd

        chunk = 256
        names = [part.split()[0] for part in CROP_PIXELS.split(", ")]

        def frame(crops: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(crops, columns=names, dtype=object)

        for batch in batches:
            for row in batch.itertuples(index=False):
                pixels = None
                if row.data is not None:
                    shape = int(row.height), int(row.width), int(row.channels)
                    pixels = np.frombuffer(row.data, np.uint8).reshape(shape)
                crops = []
                for i in range(len(row.uris)):
                    place = row.sample_id, row.object_ids[i], row.uris[i]
                    if pixels is None:
                        crops.append((*place, *[None] * 5, UNREADABLE_IMAGE))
                    else:
                        part = pixels[row.y1[i] : row.y2[i], row.x1[i] : row.x2[i]]
                        if part.size:
                            crops.append((*place, *part.shape, int(row.mode), part.tobytes(), None))
                        else:
                            crops.append((*place, *[None] * 5, EMPTY_CROP))
                    if len(crops) == chunk:
                        yield frame(crops)
                        crops = []
                if crops:
                    yield frame(crops)

    return requests.mapInPandas(cut, CROP_PIXELS)


def crop_files(samples: DataFrame, crop_dir: str, ratio: float, decode: Decoder = decode_png, salts: int = 16) -> DataFrame:
    """As `crop_pixels`, from the files the samples name: requests go to the images, no pixels are shuffled.

    Headers give the sizes to which boxes are clipped. Then small requests are dealt by image address, an image with very many
    sample rows over up to `salts` tasks, and each task opens its images one after the other and cuts. Images that no
    object needs are never opened. `decode` turns a file's bytes into pixels (height, width, channels).
    """
    narrow = samples.select("sample_id", F.col("image_asset.image_uri").alias("image_uri"), "objects").filter(F.size("objects") > 0)
    sizes = header_sizes(narrow)
    joined = narrow.join(sizes.select("image_uri", "width", "height"), "image_uri", "left")
    cropped = attach_crops(joined, crop_dir, ratio, F.col("width"), F.col("height"))
    requests = cropped.select(
        F.col("image_uri"), "sample_id", F.col("width").isNotNull().alias("sized"), F.col("objects.object_id").alias("object_ids"), F.col("objects.crop.crop_uri").alias("uris"),
        *[F.col(f"objects.crop.crop_box.{name}").alias(name) for name in ("x1", "y1", "x2", "y2")],
    )
    dealt = requests.withColumn("_salt", F.pmod(F.xxhash64("sample_id"), F.lit(salts))).repartition("image_uri", "_salt").sortWithinPartitions("image_uri")
    schema = pa.schema([
        ("sample_id", pa.string()), ("object_id", pa.string()), ("origin", pa.string()), ("height", pa.int32()), ("width", pa.int32()),
        ("nChannels", pa.int32()), ("mode", pa.int32()), ("data", pa.binary()), ("error", pa.string()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image, pixels, held, size = None, None, [], 0

        def read(uri):
            try:
                system, path = opened(uri)
                with system.open_input_file(path) as file:
                    return decode(file.read())
            except (OSError, ValueError, zlib.error, struct.error):
                return None

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema, strict=True)], schema=schema)

        for rows in batches:
            for row in rows.to_pylist():
                if row["image_uri"] != image:
                    image, pixels = row["image_uri"], read(row["image_uri"]) if row["sized"] else None
                for i, uri in enumerate(row["uris"]):
                    place = row["sample_id"], row["object_ids"][i], uri
                    part = None if pixels is None else pixels[row["y1"][i] : row["y2"][i], row["x1"][i] : row["x2"][i]]
                    if part is None or not part.size:
                        held.append((*place, *[None] * 5, UNREADABLE_IMAGE if part is None else EMPTY_CROP))
                    else:
                        held.append((*place, *part.shape, (part.shape[2] - 1) * 8, part.tobytes(), None))
                        size += part.size
                    if len(held) >= 1000 or size > 16_000_000:
                        yield batch()
                        held, size = [], 0
        if held:
            yield batch()

    return dealt.mapInArrow(cut, CROP_PIXELS)
