"""Wrappers around user code that runs in tasks.

This module is sent to the executors by value, so it must not create Spark columns at import time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def reward_function(scorer: Callable, **fixed):
    """A user's scorer ``(data_source, solution, truth, extra, **fixed)`` as an Arrow-batched function.

    It returns a number (used as score and acc) or a dict with ``score`` and optionally ``acc``.
    """

    @F.pandas_udf("score double, acc double")
    def run(source: pd.Series, solution: pd.Series, truth: pd.Series, extra: pd.Series) -> pd.DataFrame:
        rows = []
        for args in zip(source, solution, truth, extra):
            got = scorer(*args, **fixed)
            if not isinstance(got, dict):
                got = {"score": float(got), "acc": float(got)}
            rows.append((float(got["score"]), float(got.get("acc", got["score"]))))
        return pd.DataFrame(rows, columns=["score", "acc"])

    return run


def explode_function():
    """A table function from an array of positions to one row per position."""

    @udtf(returnType="in_event: int, response_pos: int", useArrow=True)
    class ExplodePositions:
        def eval(self, positions: list):
            for i, p in enumerate(positions or []):
                yield i, p

    return ExplodePositions
