"""Base samples, workflow steps and the keyed sample store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom import schema, vocab
from boxloom.functions.columns import nonblank, null
from boxloom.operators.objects import OBJECTS
from boxloom.params import ExportDefaults, QcPolicy, Run
from boxloom.session import stored


def context_struct(rows: DataFrame, fields: list[str]) -> Column:
    """Manifest cells as a context struct; blank and absent cells are null."""
    return F.struct(
        *[
            (nonblank(F.col(name).cast("string")) if name in rows.columns else null("string")).alias(name)
            for name in fields
        ]
    )


def qc_policy_struct(policy: QcPolicy | None) -> Column:
    if policy is None:
        return null(schema.QC_POLICY)
    return F.struct(
        *[F.lit(getattr(policy, name)).alias(name) for name in schema.QC_POLICY.fieldNames()]
    ).cast(schema.QC_POLICY)


def export_struct(export: ExportDefaults) -> Column:
    return F.struct(
        F.lit(export.export_format).alias("export_format"),
        F.lit(export.export_status).alias("export_status"),
        F.lit(export.export_uri).cast("string").alias("export_uri"),
        null("variant").alias("labelstudio_mapping"),
    )


def base_samples(rows: DataFrame, run: Run, status: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """One sample per manifest row with resolved integer width and height, no objects yet."""
    image_asset = F.struct(
        "image_id",
        "image_uri",
        F.col("width").cast("int").alias("width"),
        F.col("height").cast("int").alias("height"),
        "source_type",
        context_struct(rows, vocab.SOURCE_CONTEXT_FIELDS).alias("source_context"),
        context_struct(rows, vocab.SCENE_CONTEXT_FIELDS).alias("scene_context"),
    )
    workflow = F.struct(
        F.lit(status).alias("workflow_status"),
        F.lit(run.pipeline_id).cast("string").alias("pipeline_id"),
        F.lit(run.pipeline_version).cast("string").alias("pipeline_version"),
        F.lit(run.now).alias("created_time"),
        F.lit(run.now).alias("updated_time"),
    )
    return rows.select(
        "sample_id",
        F.lit(0).alias("part_no"),
        image_asset.alias("image_asset"),
        F.array().cast(OBJECTS).alias("objects"),
        qc_policy_struct(run.qc_policy).alias("qc_policy"),
        workflow.alias("workflow"),
        export_struct(run.export).alias("export"),
        *keep,
    )


def advance(samples: DataFrame, status: str, now: str, when: Column | None = None) -> DataFrame:
    """Set the workflow status and refresh updated_time, on all rows or where `when` holds."""
    moved = F.col("workflow").withField("workflow_status", F.lit(status)).withField("updated_time", F.lit(now))
    return samples.withColumn("workflow", moved if when is None else F.when(when, moved).otherwise(F.col("workflow")))


def union_branches(generated: DataFrame, direct: DataFrame) -> DataFrame:
    """Both branches in one table with `run_seq`; the direct branch runs last and so wins."""
    return generated.withColumn("run_seq", F.lit(0)).unionByName(
        direct.withColumn("run_seq", F.lit(1)), allowMissingColumns=True
    )


def last_write_wins(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Per key the row with the highest order values.

    An aggregation, not a window: every task first reduces its own rows to one per key, so a key with a
    large share of all rows sends one row per task over the network. Documents in parts (`part_no`) win or lose
    together: all parts of the winning write stay, parts of other writes go. There a window follows, over a key's parts alone.
    """
    if "part_no" in rows.columns and "part_no" not in keys:
        # each part's newest write, computed once; then a window over these few rows of a key. A join with the keys' newest writes is
        # guessed at next to nothing beside whole objects, and taken for small, all keys would go through the driver
        values = [name for name in rows.columns if name not in (*keys, "part_no")]
        last = F.max_by(F.struct(*values), F.struct(*order)).alias("_row")
        written = F.max(F.struct(*[column.alias(f"o{i}") for i, column in enumerate(order)])).alias("_written")
        parts = stored(rows.groupBy(*keys, "part_no").agg(last, written), "newest")
        flat = parts.select(*keys, "part_no", "_row.*", "_written", F.max("_written").over(Window.partitionBy(*keys)).alias("_newest"))
        return flat.filter(F.col("_written").eqNullSafe(F.col("_newest"))).select(*rows.columns)
    values = [name for name in rows.columns if name not in keys]
    newest = F.max_by(F.struct(*values), F.struct(*order))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """Sample ids written more than once, with their count; the parts of one document count once."""
    if "part_no" in rows.columns:
        parts = rows.groupBy("sample_id", "part_no").agg(F.count("*").alias("n_rows"))
        return parts.groupBy("sample_id").agg(F.max("n_rows").alias("n_rows")).filter("n_rows > 1")
    return rows.groupBy("sample_id").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def replace_samples(store: DataFrame, written: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """The next store snapshot: rows of re-run or failed samples leave, written rows enter."""
    gone = written.select("sample_id")
    if removed is not None:
        gone = gone.union(removed.select("sample_id"))
    return store.join(gone.distinct(), "sample_id", "left_anti").unionByName(written)


def stale_crops(crops: DataFrame, written: DataFrame) -> DataFrame:
    """Crops (sample_id, crop_uri) of re-run samples that the new run no longer refers to."""
    rerun = crops.join(written.select("sample_id").distinct(), "sample_id", "left_semi")
    current = written.select("sample_id", F.explode("objects.crop.crop_uri").alias("crop_uri")).distinct()
    return rerun.join(current, ["sample_id", "crop_uri"], "left_anti")
