"""Quality-control sampling: which samples are inspected, and what an inspection means for their batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.params import QcPolicy
from boxloom.session import stored

KEY_DIGITS = 13
KEY_SPACE = 16**KEY_DIGITS
#: Parts into which a round of `smallest` cuts the keys that are still open.
PARTS = 4096
#: Rows that one task may put in order at the end.
RANKED = 100_000


def sample_key(sample_id: Column, seed: str) -> Column:
    """A uniform whole number under `KEY_SPACE` that depends on the sample and the seed only."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), sample_id)), 1, KEY_DIGITS), 16, 10).cast("bigint")


def risk_key(sample_id: Column, seed: str, weight: Column) -> Column:
    """An exponential key: the smallest keys are a sample without replacement in which weights count as draws.

    Keys are rounded to whole numbers, so that they are cut exactly; null or non-positive weights never come first.
    """
    uniform = (sample_key(sample_id, seed) + F.lit(0.5)) / F.lit(float(KEY_SPACE))
    return F.when(weight > 0, F.floor(-F.ln(uniform) / weight * F.lit(1e12))).otherwise(F.lit(2**62)).cast("bigint")


def smallest(rows: DataFrame, strata: list[str], quota: Column) -> DataFrame:
    """Of each stratum the `quota` rows with the smallest (key, sample_id); `quota` may use the stratum's `n`.

    `rows` have the strata, key and sample_id, one row per sample. No stratum is sorted or gathered: each round counts
    keys in `PARTS` equal parts of the interval that is still open, and goes on inside the part that holds
    the last row wanted. Rows below that part are in, and only the rows inside it, at most `RANKED` or those of one
    key, are put in order.
    """
    spans = rows.groupBy(*strata).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    cut = stored(spans.select(*strata, "low", "high", F.least(quota, F.col("n")).cast("bigint").alias("wanted"), F.col("n").alias("inside")), "spans")
    cut = cut.filter("wanted > 0")
    cuts = []
    while True:
        done = (F.col("inside") <= RANKED) | (F.col("low") == F.col("high"))
        cuts.append(cut.filter(done))
        left = cut.filter(~done)
        if not left.head(1):
            break
        width = F.floor((F.col("high") - F.col("low")) / PARTS) + 1
        part = F.floor((F.col("key") - F.col("low")) / width)
        counted = (
            _with_cut(rows, left, strata)
            .filter("key BETWEEN low AND high")
            .groupBy(*strata, "low", "high", "wanted", part.alias("part"))
            .agg(F.count("*").alias("inside"))
        )
        before = Window.partitionBy(*strata).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        ahead = counted.withColumn("before", F.coalesce(F.sum("inside").over(before), F.lit(0)))
        ahead = ahead.filter("before < wanted AND before + inside >= wanted")
        low = F.col("low") + F.col("part") * width
        cut = stored(
            ahead.select(*strata, low.alias("low"), F.least(F.col("high"), low + width - 1).alias("high"), (F.col("wanted") - F.col("before")).alias("wanted"), "inside"),
            "spans",
        )
    ends = cuts[0]
    for more in cuts[1:]:
        ends = ends.unionByName(more)
    judged = _with_cut(rows, ends, strata)
    # one task orders at most RANKED rows of a stratum
    order = Window.partitionBy(*strata).orderBy("key", "sample_id")
    edge = judged.filter("key BETWEEN low AND high").withColumn("place", F.row_number().over(order)).filter("place <= wanted")
    return judged.filter("key < low").select(*rows.columns).unionByName(edge.select(*rows.columns))


def _with_cut(rows: DataFrame, cut: DataFrame, strata: list[str]) -> DataFrame:
    """Rows beside the cut of their stratum; Spark ships the cuts where they are small and splits hot strata where not."""
    same = [rows[s].eqNullSafe(cut[s]) for s in strata]
    joined = rows.join(cut, same) if same else rows.join(F.broadcast(cut))  # without strata there is one cut
    return joined.select(*[rows[c] for c in rows.columns], cut["low"], cut["high"], cut["wanted"])


def qc_sample(samples: DataFrame, policy: QcPolicy, seed: str, strata: list[str] | None = None, weight: Column | None = None) -> DataFrame:
    """The rows of `samples` to be inspected, by the policy's mode and method; the same rows for the same seed.

    random: each sample by itself with the policy's ratio, no shuffle. stratified: exactly ceil(ratio * n) of each
    stratum of n samples. risk_based: as many, drawn by `weight` without replacement. A repeated sample_id is one
    sample with all its rows. Samples without an id are never drawn. No ratio draws nothing.
    """
    if policy.qc_mode == "full_inspection":
        return samples
    ratio = policy.sampling_ratio or 0.0
    if policy.qc_mode == "none" or ratio <= 0:
        return samples.filter(F.lit(False))
    key = sample_key(F.col("sample_id"), seed)
    if policy.sampling_method == "random":
        return samples.filter(key < F.lit(int(ratio * KEY_SPACE)))
    if policy.sampling_method == "risk_based":
        key = risk_key(F.col("sample_id"), seed, weight if weight is not None else F.lit(1.0))
    strata = strata or []
    # the smallest row of a repeated sample decides its stratum and weight
    drawn = samples.filter(F.col("sample_id").isNotNull()).select("sample_id", *strata, key.alias("key"))
    single = drawn.groupBy("sample_id").agg(F.min(F.struct(*strata, "key")).alias("row")).select("sample_id", "row.*")
    chosen = smallest(stored(single, "drawn"), strata, F.ceil(F.col("n") * F.lit(ratio)))
    return samples.join(stored(chosen.select("sample_id"), "chosen"), "sample_id", "left_semi")


def select_for_qc(samples: DataFrame, chosen: DataFrame, now: str) -> DataFrame:
    """Samples with the status `sampling_selected` where `chosen` (sample_id) holds them."""
    moved = F.col("workflow").withField("workflow_status", F.lit("sampling_selected")).withField("updated_time", F.lit(now))
    marked = samples.join(chosen.select("sample_id").distinct().withColumn("_chosen", F.lit(True)), "sample_id", "left")
    return marked.withColumn("workflow", F.when(F.col("_chosen"), moved).otherwise(F.col("workflow"))).select(*samples.columns)


def batch_decisions(samples: DataFrame, checks: DataFrame, accepted_share: float = 0.0) -> DataFrame:
    """qc_batch_id, n_samples, n_inspected, n_failed, n_open, decision per batch.

    `samples` have sample_id and qc_batch_id, `checks` sample_id and qc_status (null or `pending`: not inspected yet), at most
    one row per sample. `pending`: inspections are open, or none was made. `failed`: more than `accepted_share` of the
    inspected samples failed. Otherwise `passed`. Statuses `failed` and `discarded` are failures.
    """
    drawn = checks.select("sample_id", "qc_status", F.lit(True).alias("drawn"))
    rows = samples.select("sample_id", "qc_batch_id").join(drawn, "sample_id", "left")
    failed = F.col("qc_status").isin("failed", "discarded")
    waiting = F.col("drawn") & F.coalesce(F.col("qc_status") == "pending", F.lit(True))
    counted = rows.groupBy("qc_batch_id").agg(
        F.count("*").alias("n_samples"),
        F.count_if(F.col("drawn") & ~waiting).alias("n_inspected"),
        F.count_if(failed).alias("n_failed"),
        F.count_if(waiting).alias("n_open"),
    )
    decision = (
        F.when((F.col("n_open") > 0) | (F.col("n_inspected") == 0), "pending")
        .when(F.col("n_failed") > F.col("n_inspected") * F.lit(accepted_share), "failed")
        .otherwise("passed")
    )
    return counted.withColumn("decision", decision)


def batch_outcomes(samples: DataFrame, checks: DataFrame, policy: QcPolicy, accepted_share: float = 0.0) -> DataFrame:
    """sample_id, qc_batch_id, qc_status, decision, outcome of every sample.

    What a decided batch means for a sample depends on the policy's `fail_policy`:

    - `batch_rework`: a failed batch sends all its samples to `rework`, a passed one accepts all.
    - `relabel_failed_only`: failed samples go to `relabel`, all others are accepted.
    - `pass_only_sample`: inspected samples that passed are accepted, failed ones go to `relabel`, the rest is on `hold`.

    Samples of a pending batch are on `hold`. A null batch is a batch of its own. Samples meet their batch's decision in a join
    of two plain shuffles or a broadcast of checked size, so a batch with a third of all samples is split at run time.
    """
    decisions = stored(batch_decisions(samples, checks, accepted_share).select("qc_batch_id", "decision"), "decisions")
    rows = samples.select("sample_id", "qc_batch_id").join(checks.select("sample_id", "qc_status"), "sample_id", "left")
    same = rows["qc_batch_id"].eqNullSafe(decisions["qc_batch_id"])
    joined = rows.join(decisions, same).select("sample_id", rows["qc_batch_id"], "qc_status", "decision")
    return joined.withColumn("outcome", outcome(F.col("decision"), F.col("qc_status"), policy.fail_policy))


def outcome(decision: Column, qc_status: Column, fail_policy: str) -> Column:
    failed = F.coalesce(qc_status.isin("failed", "discarded"), F.lit(False))
    if fail_policy == "batch_rework":
        decided = F.when(decision == "failed", "rework").otherwise("accept")
    elif fail_policy == "relabel_failed_only":
        decided = F.when(failed, "relabel").otherwise("accept")
    elif fail_policy == "pass_only_sample":
        decided = F.when(failed, "relabel").when(qc_status.isNotNull(), "accept").otherwise("hold")
    else:
        raise ValueError(f"unknown fail policy {fail_policy!r}")
    return F.when(decision == "pending", "hold").otherwise(decided)


#: Where an outcome leaves a sample; `hold` leaves it where it is.
NEXT_STATUS = {"accept": "qc_completed", "relabel": "cropped", "rework": "raw"}


def apply_outcomes(samples: DataFrame, outcomes: DataFrame, now: str) -> DataFrame:
    """Samples with the workflow status that their outcome (sample_id, outcome) leaves them in."""
    status = F.coalesce(*[F.when(F.col("outcome") == name, F.lit(to)) for name, to in NEXT_STATUS.items()])
    moved = F.col("workflow").withField("workflow_status", status).withField("updated_time", F.lit(now))
    joined = samples.join(outcomes.select("sample_id", "outcome"), "sample_id", "left")
    return joined.withColumn("workflow", F.when(status.isNotNull(), moved).otherwise(F.col("workflow"))).select(*samples.columns)
