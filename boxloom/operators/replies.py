"""Model replies: parse outcome, bounded retry, and lining replies up with objects."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocab
from boxloom.functions.columns import bind
from boxloom.functions.text import first_json, first_object, first_object_or_json, preview
from boxloom.operators.objects import PART_SIZE, part_of

# reply kind -> how its JSON is found, and the error class when there is none
RULES: dict[str, tuple[Callable[[Column], Column], str]] = {
    "detection": (first_json, vocab.DETECTION_PARSE_ERROR),
    "review": (first_object, vocab.DETECTION_PARSE_ERROR),
    "answers": (first_object_or_json, vocab.ANSWER_PARSE_ERROR),
}


def parse_replies(replies: DataFrame, kind: str) -> DataFrame:
    """Add `payload`, `parse_status` (ok / unparseable), `error_class` and `error_preview`."""
    find, error_class = RULES[kind]
    parsed = bind(replies, {"payload": find(F.col("raw_text"))})
    failed = F.col("payload").isNull()
    return parsed.select(
        "*",
        F.when(failed, F.lit("unparseable")).otherwise(F.lit("ok")).alias("parse_status"),
        F.when(failed, F.lit(error_class)).alias("error_class"),
        F.when(failed, preview(F.col("raw_text"))).alias("error_preview"),
    )


def first_parseable(
    parsed: DataFrame, keys: list[str], max_attempts: int = 3, tie_break: list[str] | None = None
) -> DataFrame:
    """Per key the earliest parseable reply within `max_attempts`, and `n_attempts` made.

    Keys whose attempts all failed have null payload and attempt. Replies are reduced inside each task
    before the shuffle, so a key with very many attempts stays cheap.
    """
    values = [name for name in parsed.columns if name not in keys]
    order = F.struct("attempt", *(tie_break or []), "raw_text")
    usable = (F.col("parse_status") == "ok") & (F.col("attempt") <= max_attempts)
    return (
        parsed.groupBy(*keys)
        .agg(
            F.min_by(F.struct(*values), F.when(usable, order)).alias("_best"),
            F.count_if(F.col("attempt") <= max_attempts).alias("n_attempts"),
        )
        .select(*keys, "n_attempts", *[F.col(f"_best.{name}").alias(name) for name in values])
    )


def readable(kind: str) -> Column:
    """Whether a reply parses, for deciding on attempts before anything is read from it."""
    return RULES[kind][0](F.col("raw_text")).isNotNull()


def of_attempt(replies: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """One reply per key from each sample's chosen attempt (sample_id, attempt), as raw text.

    `keys` contain sample_id. Replies of other attempts leave first; of a repeated reply the smallest row stays
    (`repeated_replies` counts them). Grouping by the join keys too needs no second shuffle.
    """
    values = [name for name in replies.columns if name not in (*keys, "attempt", "raw_text")]
    wanted = replies.join(chosen.select("sample_id", "attempt"), ["sample_id", "attempt"], "left_semi")
    single = wanted.groupBy("sample_id", "attempt", *[key for key in keys if key != "sample_id"])
    return single.agg(F.min(F.struct("raw_text", *values)).alias("_reply")).select(*keys, "_reply.*")


def repeated_replies(replies: DataFrame, keys: list[str]) -> DataFrame:
    """Keys and attempts that were answered more than once, with the number of replies."""
    return replies.groupBy(*keys, "attempt").agg(F.count("*").alias("n_replies")).filter("n_replies > 1")


def choose_attempts(stages: list[DataFrame], max_attempts: int = 3, first_needed: bool = True) -> DataFrame:
    """sample_id and `attempt`: the first attempt in which every reply of every stage was readable.

    `stages` are tables with sample_id, attempt, ok. An attempt counts only with a reply of the first stage; a
    sample without any such reply has no row. Without `first_needed` any stage's reply makes an attempt, and every
    sample has a row. A null attempt marks an exhausted sample.
    """
    every = None
    for n, stage in enumerate(stages):
        outcome = stage.select("sample_id", "attempt", "ok", F.lit(n == 0 or not first_needed).alias("first"))
        every = outcome if every is None else every.unionByName(outcome)
    whole = every.groupBy("sample_id", "attempt").agg(F.every("ok").alias("ok"), F.bool_or("first").alias("first"))
    good = F.col("ok") & F.col("first") & (F.col("attempt") <= max_attempts)
    return (
        whole.groupBy("sample_id")
        .agg(F.min(F.when(good, F.col("attempt"))).alias("attempt"), F.bool_or("first").alias("first"))
        .filter("first")
        .select("sample_id", "attempt")
    )


def by_position(values: DataFrame, value: str, part_size: int = PART_SIZE) -> DataFrame:
    """One map pos -> value per (sample_id, part_no) from rows unique by (sample_id, pos).

    The part bounds each map, whatever share of the rows one sample has.
    """
    return (
        values.withColumn("part_no", part_of(F.col("pos"), part_size))
        .groupBy("sample_id", "part_no")
        .agg(F.map_from_entries(F.collect_list(F.struct("pos", value))).alias(value))
    )


def align(samples: DataFrame, values: DataFrame, value: str, part_size: int = PART_SIZE) -> DataFrame:
    """Left join of samples with per-object values; adds the map column `value`.

    Only the values move: they are laid out by sample, as samples are that came out of detection, and parts are told
    apart in the join's condition. As a key of its own the part would have whole objects shuffled and sorted again,
    and once more where parts are joined to samples. In return all maps of one sample meet in one task, whose join holds
    them while it passes the sample's parts; each is bounded by its part, their number by the sample's replies.
    """
    maps = by_position(values.repartition("sample_id"), value, part_size)
    same_part = F.col("_rows.part_no") - F.col("_maps.part_no") == 0
    joined = samples.alias("_rows").join(
        maps.alias("_maps"), (F.col("_rows.sample_id") == F.col("_maps.sample_id")) & same_part, "left"
    )
    own = ["sample_id", "part_no", *[name for name in samples.columns if name not in ("sample_id", "part_no")]]
    return joined.select(*[F.col(f"_rows.{name}") for name in own], F.col(f"_maps.{value}"))


def at_position(values: Column, obj: Column) -> Column:
    return F.try_element_at(values, obj.getField("pos"))
