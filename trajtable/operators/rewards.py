"""Reward tables from scorer results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "score double, acc double, pred string"


def reward_rows(df: DataFrame, session: Sequence[str], index: str, result: str = "result") -> DataFrame:
    """Score the last output of every session.

    ``result`` is JSON: an object carries ``score`` plus extras, a bare number is both score and acc.
    """
    session = list(session)
    last = df.groupBy(*session).agg(F.max_by(result, index).alias("_result"))
    detail = F.from_json("_result", RESULT)
    number = F.col("_result").try_cast("double")
    return last.select(
        *session,
        F.coalesce(detail["score"], number).alias("score"),
        F.coalesce(detail["acc"], number).alias("acc"),
        detail["pred"].alias("pred"),
    )


def reward_on_error(df: DataFrame, raw: str, seconds: Column, limit: float) -> DataFrame:
    """Time-outs and unreadable scores become reward 0 and acc 0, each with its flag."""
    value = F.col(raw).try_cast("double")
    timed_out = seconds > limit
    failed = ~timed_out & value.isNull()
    bad = timed_out | failed
    return df.withColumns(
        {
            "timed_out": timed_out,
            "failed": failed,
            "reward": F.when(bad, 0.0).otherwise(value),
            "acc": F.when(bad, 0.0).otherwise(F.col("acc")),
        }
    )
