"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

Every stage decides on all rows its predecessor kept; all but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.llm import op01_byte_bpe, op05_lines, op08_quality, op09_benchmark, similar_texts
from boxloom.llm.common import store


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled rows of its input."""
    model = op08_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op08_quality.keep_good(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, except from the largest doc_id that holds them; n_chars follows the text."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # one column, so that no name of a table can clash with one of the operator
    row = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0))
    kept = op05_lines.drop_repeated_lines(docs.select("doc_id", "text", row.alias("row")), also=["row"])
    column = {c: F.col("row").getField(c) for c in others} | {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in others:
        column["n_chars"] = F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(column["n_chars"])
    return kept.select([column[c].cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts alike in at least 0.8 of their five-word shingles the smallest doc_id stays.

    Copies are found by op7's fingerprints and vantage-point trees, and by minimum hashes where texts differ more; then compared.
    Rows are judged each, also where they repeat a doc_id; rows with a null doc_id stay.
    """
    found = similar_texts.similar(docs, width=5, similarity=0.8)
    copies = store(found.where("doc_id <> component_id").select("doc_id", "text_hash").distinct(), "copies")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = (F.col("row.doc_id").cast("long") == F.col("doc_id")) & (F.xxhash64(F.col("row.text").cast("string")) == F.col("text_hash"))
    return rows.join(copies.hint("merge"), same, "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return op09_benchmark.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of ids and decoded bytes of each text that is left."""
    import public_tokenizers

    return op01_byte_bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_contaminated),
    ("tokens", encode),
]

#: The classifier and the fingerprints have no SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
