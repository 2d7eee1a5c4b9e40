"""Manifest and generation-task CSV tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions.text import strip

_CSV = {"header": True, "quote": '"', "escape": '"'}


def read_manifest(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header, every cell trimmed text, empty cells ''.

    Quoted line breaks need `multi_line`, under which Spark does not split a file; the sink writes many
    part files, so reading stays parallel. Switch it off for one huge file without line breaks in cells.
    """
    rows = spark.read.options(**_CSV, multiLine=multi_line).csv(path)
    return rows.select(*[strip(F.coalesce(rows[name], F.lit(""))).alias(name) for name in rows.columns])


def project_fields(rows: DataFrame, fields: list[str]) -> DataFrame:
    """The given columns in order, as text; absent columns and nulls become ''."""
    present = set(rows.columns)
    return rows.select(
        *[
            (F.coalesce(F.col(name).cast("string"), F.lit("")) if name in present else F.lit("")).alias(name)
            for name in fields
        ]
    )


def write_csv(rows: DataFrame, path: str, fields: list[str]) -> None:
    """Part files with a header each, UTF-8 without byte-order mark."""
    project_fields(rows, fields).write.options(**_CSV, emptyValue="", nullValue="").csv(path)


def write_manifest(rows: DataFrame, path: str) -> None:
    write_csv(rows, path, vocab.MANIFEST_FIELDS)


def write_generation_tasks(rows: DataFrame, path: str) -> None:
    write_csv(rows, path, vocab.GENERATION_TASK_FIELDS)
