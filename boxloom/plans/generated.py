"""Generated samples: documents of the external generator to validated samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from boxloom.operators import contract, routing
from boxloom.params import Run
from boxloom.session import stored


@dataclass(frozen=True)
class GeneratedResult:
    samples: DataFrame
    quarantined: DataFrame
    rejected: DataFrame


def generation_tasks(manifest: DataFrame, existing: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Generation rows of a manifest, minus finished samples, capped by the task limit if one is set."""
    tasks = routing.generation_rows(manifest)
    if existing is not None:
        tasks = routing.not_yet_done(tasks, existing)
    return routing.first_tasks(tasks, limit)


def ingest_generated(
    documents: DataFrame, run: Run, raw: str = "raw_json", strict: bool = False
) -> GeneratedResult:
    """Fill defaults, keep generated samples, validate. Nothing aborts: the rest is returned with reasons.

    The checked documents are stored once; every output is a selection from them. With `strict` the first foreign
    source type or contract violation raises.
    """
    checked = stored(contract.validate(contract.normalize_documents(documents, run, raw)), "generated")
    generated, rejected = contract.check_generated(checked)
    valid, quarantined = contract.split_checked(generated)
    rejected = rejected.drop("violations", "first_violation")
    if strict:
        contract.require_none(rejected, "error")
        contract.require_none(quarantined, "first_violation")
    return GeneratedResult(valid, quarantined, rejected)
