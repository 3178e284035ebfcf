"""The evaluation job: an export against labelled rows, with its history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from postmill import fixed_values as fv
from postmill.operators import evaluate
from postmill.session import job, write_stage
from postmill.sinks.files import append_history


def run(
    validation: DataFrame, export: DataFrame, history_path: str, run_ts: str, row_no: str = "row_no",
    flags: Sequence[str] = fv.EVALUATED_FLAGS, texts: Sequence[str] = fv.EVALUATED_TEXTS,
) -> DataFrame:
    """Counters and scores at three levels; the scores are added to the history."""
    spark = validation.sparkSession
    with job(spark):
        scores = write_stage(evaluate.compare(validation, export, flags, texts, row_no), "scores")
        append_history(evaluate.history_rows(scores, run_ts), history_path, run_ts)
        # a row per column and level, no more
        return spark.createDataFrame(scores.collect(), scores.schema)
