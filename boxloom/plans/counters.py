"""Counters of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def store_counts(samples: DataFrame) -> DataFrame:
    """One row: samples, ingested (generated) samples, objects, exportable tasks. A document in parts is one sample."""
    first = F.col("part_no") == 0 if "part_no" in samples.columns else F.lit(True)
    return samples.agg(
        F.count_if(first).alias("n_samples"),
        F.count_if(first & (F.col("image_asset.source_type") == "generated")).alias("n_ingested"),
        F.coalesce(F.sum(F.greatest(F.size("objects"), F.lit(0))), F.lit(0)).cast("bigint").alias("n_objects"),
        F.count_if(first & F.coalesce(F.col("workflow.workflow_status") != "discarded", F.lit(True))).alias("n_tasks"),
    )
