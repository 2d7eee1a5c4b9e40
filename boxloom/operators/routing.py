"""Which manifest rows go where: branch routing, required fields, sizes, task keys, limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions.columns import nonblank, null
from boxloom.functions.text import strip


def _cell(rows: DataFrame, name: str) -> Column:
    return nonblank(strip(F.col(name))) if name in rows.columns else null("string")


def direct_rows(rows: DataFrame) -> DataFrame:
    """Rows for direct annotation; a blank or absent task mode counts as direct."""
    return rows.filter(F.coalesce(_cell(rows, "task_mode"), F.lit("direct")) == "direct")


def generation_rows(rows: DataFrame) -> DataFrame:
    """Rows for generation; a manifest without the task_mode column is all generation."""
    return rows.filter(F.col("task_mode") == "generation") if "task_mode" in rows.columns else rows


def missing_fields(rows: DataFrame) -> Column:
    """Names of the required fields a row lacks, in checking order."""
    return F.array_compact(
        F.array(*[F.when(_is_blank(rows, name), F.lit(name)) for name in vocab.REQUIRED_MANIFEST_FIELDS])
    )


def _is_blank(rows: DataFrame, name: str) -> Column:
    return _cell(rows, name).isNull()


def split_required(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with `error` naming the first missing field."""
    missing = missing_fields(rows)
    rejected = rows.filter(F.size(missing) > 0).withColumn(
        "error", F.concat(F.lit("manifest row is missing required field: "), F.get(missing, F.lit(0)))
    )
    return rows.filter(F.size(missing) == 0), rejected


def manifest_size(rows: DataFrame) -> Column:
    """struct(width, height) when both cells hold positive integers, else null."""
    width, height = (
        (F.col(name).try_cast("int") if name in rows.columns else null("int")) for name in ("width", "height")
    )
    given = (width > 0) & (height > 0)
    return F.when(given, F.struct(width.alias("width"), height.alias("height")))


def resolve_sizes(rows: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Integer `width`/`height` from the manifest, else from `sizes` (image_uri, width, height).

    Only rows the manifest leaves open take part in the join, so a complete manifest shuffles nothing.
    """
    sized = rows.withColumn("_size", manifest_size(rows))
    kept = [name for name in rows.columns if name not in ("width", "height")]
    given = sized.select(*kept, F.col("_size.width").alias("width"), F.col("_size.height").alias("height"))
    if sizes is None:
        return given
    real = sizes.groupBy("image_uri").agg(F.max("width").alias("width"), F.max("height").alias("height"))
    unresolved = sized.filter(F.col("_size").isNull()).select(*kept)
    looked_up = unresolved.join(real, "image_uri", "left").select(*kept, "width", "height")
    return given.filter(F.col("width").isNotNull()).unionByName(looked_up)


def with_task_key(
    rows: DataFrame, direct_default: str | None = None, detector_default: str | None = None
) -> DataFrame:
    """Fill `task_key` from the row, then the direct default, then the detector default."""
    fallbacks = [F.lit(value) for value in (direct_default, detector_default) if value]
    return rows.withColumn("task_key", F.coalesce(_cell(rows, "task_key"), *fallbacks, null("string")))


def split_known_tasks(rows: DataFrame, services: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose task key has a service, and the rest with `error`.

    Services are a handful of configured names, so they are literals in the plan, not a joined table.
    """
    known = F.coalesce(F.col("task_key").isin(services), F.lit(False))
    reason = F.when(
        F.col("task_key").isNull(), F.lit("task_key is required when there is no default")
    ).otherwise(F.concat(F.lit("detector is not configured for task_key="), F.col("task_key")))
    return rows.filter(known), rows.filter(~known).withColumn("error", reason)


def not_yet_done(tasks: DataFrame, existing: DataFrame) -> DataFrame:
    """Tasks whose sample does not exist yet."""
    return tasks.join(existing.select("sample_id").distinct(), "sample_id", "left_anti")


def first_tasks(tasks: DataFrame, limit: int | None) -> DataFrame:
    """The first `limit` tasks by sample id; all of them without a limit."""
    return tasks if limit is None else tasks.orderBy("sample_id").limit(limit)
