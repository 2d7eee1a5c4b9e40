"""Session settings the operators rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    # JSON decoders used by annotation tools keep the last of two equal keys.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # lets AQE split a skewed join side even when that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; safe to call on any session, cluster settings stay untouched."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's `spark.checkpoint.dir`; only an unset one gets a folder of our own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="boxloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write rows into the shared folder and read them back, so that several outputs compute them once."""
    path = shared_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table inside the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
