"""Samples for quality control, and what inspections mean for batches."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from boxloom.operators import sampling
from boxloom.params import QcPolicy


def key(sample_id, seed="s"):
    return int(hashlib.md5(f"{seed}:{sample_id}".encode()).hexdigest()[: sampling.KEY_DIGITS], 16)


@pytest.mark.parametrize("parts, ranked", [(4096, 100_000), (4, 3), (2, 1)])
def test_exact_quota_of_every_stratum(spark, monkeypatch, parts, ranked):
    monkeypatch.setattr(sampling, "PARTS", parts)
    monkeypatch.setattr(sampling, "RANKED", ranked)
    rows = [(f"id{k}", None if k % 5 == 0 else "hot" if k % 3 else f"s{k % 17}") for k in range(700)] + [("only", "alone")]
    frame = spark.createDataFrame(rows, "sample_id string, stratum string")
    policy = QcPolicy(sampling_ratio=0.1, sampling_method="stratified")
    got = {r.sample_id for r in sampling.qc_sample(frame, policy, "s", ["stratum"]).collect()}
    strata = {}
    for i, s in rows:
        strata.setdefault(s, []).append(i)
    want = {i for ids in strata.values() for i in sorted(ids, key=key)[: math.ceil(len(ids) * 0.1)]}
    assert got == want
    whole = {r.sample_id for r in sampling.qc_sample(frame, policy, "s").collect()}
    assert whole == set(sorted((i for i, _ in rows), key=key)[:71])


def test_equal_keys_are_cut_by_id(spark, monkeypatch):
    monkeypatch.setattr(sampling, "RANKED", 2)
    frame = spark.createDataFrame([(f"id{k:02d}", 7) for k in range(20)] + [("low", 1), ("high", 9)], "sample_id string, key long")
    got = sorted(r.sample_id for r in sampling.smallest(frame, [], F.lit(4)).collect())
    assert got == ["id00", "id01", "id02", "low"]


def test_inclusion_grows_with_weight(spark):
    weights = [0.5, 1.0, 2.0, 8.0]
    frame = spark.range(4000).selectExpr("concat('s', id) AS sample_id", "CAST(id % 4 AS INT) AS class")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.col("class") + 1)
    policy = QcPolicy(sampling_ratio=0.1, sampling_method="risk_based")
    drawn = Counter(r["class"] for r in sampling.qc_sample(frame, policy, "a", weight=weight).collect())
    assert sum(drawn.values()) == 400 and drawn[0] < drawn[1] < drawn[2] < drawn[3]
    again = sampling.qc_sample(frame.repartition(9), policy, "a", weight=weight)
    assert Counter(r["class"] for r in again.collect()) == drawn
    never = sampling.qc_sample(frame, policy, "a", weight=F.when(F.col("class") > 0, 1.0))
    assert Counter(r["class"] for r in never.collect())[0] == 0


def test_modes(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "sample_id string")
    count = lambda **policy: sampling.qc_sample(frame, QcPolicy(**policy), "s").count()
    assert count(qc_mode="full_inspection") == 4 and count(qc_mode="none", sampling_ratio=1.0) == 0 and count() == 0
    assert count(sampling_ratio=1.0) == 3 and count(sampling_ratio=1.0, sampling_method="stratified") == 3
    assert sampling.qc_sample(frame.filter("false"), QcPolicy(sampling_ratio=0.5, sampling_method="stratified"), "s").count() == 0


BATCHES = [("a1", "a"), ("a2", "a"), ("a3", "a"), ("b1", "b"), ("b2", "b"), ("c1", "c"), ("c2", "c"), ("n1", None), ("n2", None), ("d1", "d")]
CHECKS = [("a1", "failed"), ("a2", "passed"), ("b1", "passed"), ("c1", "pending"), ("c2", "failed"), ("n1", "corrected"), ("n2", "discarded")]


@pytest.mark.parametrize(
    "fail_policy, want",
    [
        ("batch_rework", {"a1": "rework", "a2": "rework", "a3": "rework", "b1": "accept", "b2": "accept", "n1": "rework", "n2": "rework"}),
        ("relabel_failed_only", {"a1": "relabel", "a2": "accept", "a3": "accept", "b1": "accept", "b2": "accept", "n1": "accept", "n2": "relabel"}),
        ("pass_only_sample", {"a1": "relabel", "a2": "accept", "a3": "hold", "b1": "accept", "b2": "hold", "n1": "accept", "n2": "relabel"}),
    ],
)
def test_outcomes(spark, fail_policy, want):
    samples = spark.createDataFrame(BATCHES, "sample_id string, qc_batch_id string").selectExpr("*", "named_struct('workflow_status', 'classified', 'updated_time', 'old') AS workflow")
    checks = spark.createDataFrame(CHECKS, "sample_id string, qc_status string")
    outcomes = sampling.batch_outcomes(samples, checks, QcPolicy(fail_policy=fail_policy))
    want = want | {"c1": "hold", "c2": "hold", "d1": "hold"}
    assert {r.sample_id: r.outcome for r in outcomes.collect()} == want
    after = {r.sample_id: tuple(r.workflow) for r in sampling.apply_outcomes(samples, outcomes, "now").collect()}
    assert after == {i: ("classified", "old") if o == "hold" else (sampling.NEXT_STATUS[o], "now") for i, o in want.items()}


def test_outcomes_of_an_accepted_share_and_unknown_policies(spark):
    samples = spark.createDataFrame(BATCHES, "sample_id string, qc_batch_id string")
    checks = spark.createDataFrame(CHECKS, "sample_id string, qc_status string")
    got = {r.qc_batch_id: r.decision for r in sampling.batch_decisions(samples, checks, 0.5).collect()}
    assert got == {"a": "passed", "b": "passed", "c": "pending", "d": "pending", None: "passed"}
    with pytest.raises(ValueError):
        sampling.batch_outcomes(samples, checks, QcPolicy(fail_policy="other"))


def test_selected_samples_are_marked(spark):
    samples = spark.createDataFrame(BATCHES, "sample_id string, qc_batch_id string").selectExpr("*", "named_struct('workflow_status', 'classified', 'updated_time', 'old') AS workflow")
    chosen = spark.createDataFrame([("a1",), ("a1",), ("zz",)], "sample_id string")
    after = {r.sample_id: tuple(r.workflow) for r in sampling.select_for_qc(samples, chosen, "now").collect()}
    assert after == {i: ("sampling_selected", "now") if i == "a1" else ("classified", "old") for i, _ in BATCHES}
