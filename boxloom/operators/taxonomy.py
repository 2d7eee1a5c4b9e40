"""Conformance of objects and labels with a taxonomy given as nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAXONOMY = "struct<object_types: array<string>, label_dimensions: map<string, array<string>>>"


def constraints(taxonomies: DataFrame) -> DataFrame:
    """kind, label_key, value of all that a taxonomy (column `text`: JSON) allows; several taxonomies allow what any of them does.

    Kinds: object_type (value), label_key (label_key), label (label_key and value). Unreadable text allows nothing.
    """
    parsed = taxonomies.select(F.from_json("text", TAXONOMY).alias("t"))
    none = F.lit(None).cast("string")
    types = parsed.select(F.explode("t.object_types").alias("value")).select(F.lit("object_type").alias("kind"), none.alias("label_key"), "value")
    dimensions = parsed.select(F.explode("t.label_dimensions").alias("label_key", "values"))
    keys = dimensions.select(F.lit("label_key").alias("kind"), "label_key", none.alias("value"))
    values = dimensions.select(F.lit("label").alias("kind"), "label_key", F.explode("values").alias("value"))
    return types.unionByName(keys).unionByName(values).distinct()


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """The taxonomy files at `path`, one whole file a row."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))


def violations(samples: DataFrame, allowed: DataFrame) -> DataFrame:
    """sample_id, pos, kind, label_key, value of object types, label keys and label values that `allowed` does not hold.

    The values of an unknown key are not reported again. Missing types, keys and values are violations with a null. The
    claims of all objects meet the constraints in one anti-join, which Spark broadcasts where they are small.
    """
    objects = samples.select("sample_id", F.posexplode("objects").alias("pos", "o"))
    labels = F.coalesce("o.classification.multi_labels", F.array().cast("array<struct<label_key:string,label_value:string>>"))
    none = F.lit(None).cast("string")
    pairs = F.transform(labels, lambda x: F.struct(F.lit("label").alias("kind"), x.getField("label_key").alias("label_key"), x.getField("label_value").alias("value")))
    keys = F.array_distinct(F.transform(pairs, lambda x: F.struct(F.lit("label_key").alias("kind"), x.getField("label_key").alias("label_key"), none.alias("value"))))
    own = F.array(F.struct(F.lit("object_type").alias("kind"), none.alias("label_key"), F.col("o.object_type").alias("value")))
    claims = objects.select("sample_id", "pos", F.explode(F.concat(own, keys, pairs)).alias("c")).select("sample_id", "pos", "c.*")

    def beyond(rows: DataFrame, limits: DataFrame, names: list[str]) -> DataFrame:
        same = [rows[name].eqNullSafe(limits[name]) for name in names]
        return rows.join(limits, same, "left_anti")

    wrong = beyond(claims, allowed, ["kind", "label_key", "value"])
    unknown = wrong["kind"] != "label"
    # a value counts where its key is known
    known = allowed.filter("kind = 'label_key'").select("label_key")
    values = wrong.filter(~unknown)
    return wrong.filter(unknown).unionByName(values.join(known, "label_key", "left_semi").select(*wrong.columns))


def conformance(samples: DataFrame, allowed: DataFrame) -> DataFrame:
    """kind, label_key, value and how many objects claim each thing that is not allowed."""
    return violations(samples, allowed).groupBy("kind", "label_key", "value").agg(F.count("*").alias("n_objects"))
