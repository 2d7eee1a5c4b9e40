"""Quality-control samples and batch outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.operators import sampling
from boxloom.params import QcPolicy
from catalog.inputs import Tables
from catalog.registry import query

# a third of all samples are in one stratum and in one batch
QC = {
    "sample_id": "concat('sample_', o_orderkey)",
    "stratum": "CASE WHEN o_orderkey % 3 = 0 THEN 'cctv' WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('site_', o_custkey % 40) END",
    "risk": "CAST(1 + o_custkey % 10 AS DOUBLE)",
    "qc_batch_id": "CASE WHEN o_orderkey % 3 = 0 THEN 'batch_hot' WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('batch_', o_custkey) END",
    "verdict": "CASE WHEN o_orderkey % 9 <> 0 AND o_custkey % 2 = 0 AND o_custkey % 5 = 0 THEN 'failed' WHEN o_custkey % 13 = 0 THEN 'pending' WHEN o_orderkey % 9 = 0 THEN 'passed' ELSE 'corrected' END",
    "drawn": "o_orderkey % 4 < 3",
}
QC_SQL = f"SELECT {', '.join(f'{v} AS {k}' for k, v in QC.items())} FROM orders"
KEY = f"CAST(concat('0x', substr(md5(concat('qc:', sample_id)), 1, {sampling.KEY_DIGITS})) AS BIGINT)"
RISK_KEY = f"CAST(floor(-ln(({KEY} + 0.5) / {float(sampling.KEY_SPACE)}) / risk * 1e12) AS BIGINT)"


def policy(method: str, ratio: float = 0.08, fail: str = "batch_rework") -> QcPolicy:
    return QcPolicy(sampling_ratio=ratio, sampling_method=method, fail_policy=fail)


@query("x2_random_sample", f"SELECT sample_id, stratum FROM ({QC_SQL}) WHERE {KEY} < {int(0.08 * sampling.KEY_SPACE)}")
def x2_random(t: Tables) -> DataFrame:
    return sampling.qc_sample(t.derive("orders", QC), policy("random"), "qc").select("sample_id", "stratum")


def drawn_sql(key: str) -> str:
    return f"""SELECT sample_id, stratum FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {key}, sample_id) AS place,
    count(*) OVER (PARTITION BY stratum) AS n FROM ({QC_SQL})) WHERE place <= ceil(n * CAST(0.08 AS DOUBLE))"""


@query("x2_stratified_sample", drawn_sql(KEY))
def x2_stratified(t: Tables) -> DataFrame:
    return sampling.qc_sample(t.derive("orders", QC), policy("stratified"), "qc", ["stratum"]).select("sample_id", "stratum")


@query("x2_risk_based_sample", drawn_sql(RISK_KEY))
def x2_risk(t: Tables) -> DataFrame:
    chosen = sampling.qc_sample(t.derive("orders", QC), policy("risk_based"), "qc", ["stratum"], F.col("risk"))
    return chosen.select("sample_id", "stratum")


DECIDED = f"""WITH rows AS (SELECT sample_id, qc_batch_id, CASE WHEN drawn THEN verdict END AS qc_status, drawn FROM ({QC_SQL})),
    batches AS (SELECT qc_batch_id, count(*) AS n_samples, count(*) FILTER (qc_status <> 'pending') AS n_inspected,
      count(*) FILTER (qc_status = 'failed') AS n_failed, count(*) FILTER (qc_status = 'pending') AS n_open FROM rows GROUP BY qc_batch_id),
    decided AS (SELECT *, CASE WHEN n_open > 0 OR n_inspected = 0 THEN 'pending' WHEN n_failed > n_inspected * CAST(0.05 AS DOUBLE) THEN 'failed'
      ELSE 'passed' END AS decision FROM batches)"""


def checked(t: Tables) -> tuple[DataFrame, DataFrame]:
    samples = t.derive("orders", QC)
    return samples, samples.filter("drawn").select("sample_id", F.col("verdict").alias("qc_status"))


@query("x2_batch_decisions", f"{DECIDED} SELECT * FROM decided")
def x2_decisions(t: Tables) -> DataFrame:
    return sampling.batch_decisions(*checked(t), 0.05)


def outcome_sql(decided: str) -> str:
    return f"""{DECIDED} SELECT sample_id, r.qc_batch_id, qc_status, decision, CASE WHEN decision = 'pending' THEN 'hold' {decided} END AS outcome
    FROM rows r JOIN decided d ON r.qc_batch_id IS NOT DISTINCT FROM d.qc_batch_id"""


@query("x2_batch_rework", outcome_sql("WHEN decision = 'failed' THEN 'rework' ELSE 'accept'"))
def x2_rework(t: Tables) -> DataFrame:
    return sampling.batch_outcomes(*checked(t), policy("random", fail="batch_rework"), 0.05)


@query("x2_relabel_failed_only", outcome_sql("WHEN qc_status = 'failed' THEN 'relabel' ELSE 'accept'"))
def x2_relabel(t: Tables) -> DataFrame:
    return sampling.batch_outcomes(*checked(t), policy("random", fail="relabel_failed_only"), 0.05)


@query("x2_pass_only_sample", outcome_sql("WHEN qc_status = 'failed' THEN 'relabel' WHEN qc_status IS NOT NULL THEN 'accept' ELSE 'hold'"))
def x2_pass(t: Tables) -> DataFrame:
    return sampling.batch_outcomes(*checked(t), policy("random", fail="pass_only_sample"), 0.05)
