"""Registry of runnable queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.session import configure
from trajtable.sources.tables import duck

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _with_inputs(text: str, inputs: tuple[str, ...]) -> str:
    """Put the derived inputs in front of the query's own common table expressions."""
    head = duck(*inputs)
    if text.startswith("WITH RECURSIVE "):
        return head.replace("WITH", "WITH RECURSIVE", 1) + ", " + text[15:]
    return head + (", " + text[5:] if text.startswith("WITH ") else "\n" + text)


def query(name: str, sql: str | None = None, inputs: tuple[str, ...] = ()):
    """Register a query; ``inputs`` names the derived inputs its SQL reads."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            text = sql.strip()
            if inputs:
                text = _with_inputs(text, inputs)
            ORACLES[name] = text
        return fn

    return register


def r6(col: Column | str) -> Column:
    """Round to six decimals; adding zero turns -0.0 into 0.0."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col, 6) + F.lit(0.0)


def csv(col: Column | str) -> Column:
    """An array as comma separated text, for results that are compared as values."""
    col = F.col(col) if isinstance(col, str) else col
    return F.concat_ws(",", F.transform(col, lambda x: x.cast("string")))
