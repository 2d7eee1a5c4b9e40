"""Calling a model from Spark tasks, with a bounded number of attempts for unreadable replies."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.operators.replies import parse_replies
from boxloom.session import ensure_checkpoint_dir

if TYPE_CHECKING:
    import pandas as pd

Model = Callable[["pd.DataFrame"], "pd.Series"]

CALL_ERROR = "ModelCallError"
ERROR_CHARS = 300


def score(requests: DataFrame, make_model: Callable[[], Model], partitions: int | None = None) -> DataFrame:
    """Add `raw_text`, the model's reply per request row, and `call_error`.

    `make_model` runs once per task and returns a function from an Arrow batch (size
    `spark.sql.execution.arrow.maxRecordsPerBatch`) to replies. `partitions` sets how many tasks call the
    model at a time. Filter requests first: Spark moves no predicate across this step.

    A call that raises does not end the job: its batch is asked again row by row, and rows whose own call raises, or
    answers with another number of replies, come back with a null reply and the exception in `call_error`. What
    `make_model` raises does end the job, since no request can be made without a model.
    """
    spread = requests if partitions is None else requests.repartition(partitions)
    added = [T.StructField("raw_text", T.StringType()), T.StructField("call_error", T.StringType())]
    schema = T.StructType([*requests.schema.fields, *added])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_model()

        def asked(rows: pd.DataFrame) -> list:
            replies = list(model(rows))
            if len(replies) != len(rows):
                raise ValueError(f"{len(replies)} replies to {len(rows)} requests")
            return replies

        for batch in batches:
            errors: list[str | None] = [None] * len(batch)
            try:
                replies = asked(batch)
            except Exception:
                replies = [None] * len(batch)
                for at in range(len(batch)):
                    try:
                        replies[at] = asked(batch.iloc[at : at + 1])[0]
                    except Exception as error:
                        errors[at] = f"{type(error).__name__}: {error}"[:ERROR_CHARS]
            yield batch.assign(raw_text=replies, call_error=errors)

    return spread.mapInPandas(run, schema)


def score_with_retry(
    requests: DataFrame,
    make_model: Callable[[], Model],
    kind: str,
    max_attempts: int = 3,
    partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Replies that parse (with `attempt` and `payload`), and requests whose attempts all failed.

    A failed call is a failed attempt like an unreadable reply. Failed requests carry the `error_class`, `error_preview`
    (the exception or the start of the reply) of their last attempt.

    Each round is checkpointed to the shared folder: a lost executor then re-reads replies instead of
    calling the model again, and only the failures of a round enter the next.
    """
    ensure_checkpoint_dir(requests.sparkSession)
    remaining, done = requests, None
    for attempt in range(1, max_attempts + 1):
        asked = remaining.select(*requests.columns).withColumn("attempt", F.lit(attempt))
        scored = score(asked, make_model, partitions).checkpoint()
        parsed = parse_replies(scored, kind)
        called = F.col("call_error").isNull()
        good = parsed.filter((F.col("parse_status") == "ok") & called).drop("call_error")
        done = good if done is None else done.unionByName(good)
        remaining = parsed.filter((F.col("parse_status") != "ok") | ~called).select(
            *requests.columns,
            F.when(called, F.col("error_class")).otherwise(F.lit(CALL_ERROR)).alias("error_class"),
            F.when(called, F.col("error_preview")).otherwise(F.col("call_error")).alias("error_preview"),
        )
        if remaining.isEmpty():
            break
    return done, remaining
