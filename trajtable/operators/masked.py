"""Masked reducers over token or response rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.plans.skew import with_stats

EPS = 1e-8


def kept(value: Column, mask: Column) -> Column:
    """The value where the mask is on, else null (aggregates then skip it)."""
    return F.when(mask > 0, value)


def masked_sum(value: Column, mask: Column) -> Column:
    return F.coalesce(F.sum(kept(value, mask)), F.lit(0.0))


def masked_mean(value: Column, mask: Column) -> Column:
    return masked_sum(value, mask) / (F.sum(mask) + EPS)


def masked_moments(value: Column, mask: Column, weight: Column | None = None) -> list[Column]:
    """Aggregates ``_n``, ``_mean`` and ``_m2`` (squared deviations from the plain mean).

    ``weight`` stands for a row that represents several equal tokens.
    """
    if weight is None:
        x = kept(value, mask)
        return [
            F.sum(mask).cast("double").alias("_n"),
            F.avg(x).alias("_mean"),
            (F.var_pop(x) * F.count(x)).alias("_m2"),
        ]
    w = kept(weight, mask)
    total, first, second = F.sum(w), F.sum(w * value), F.sum(w * value * value)
    return [
        total.cast("double").alias("_n"),
        (first / total).alias("_mean"),
        (second - first * first / total).alias("_m2"),
    ]


def _mean_and_var() -> tuple[Column, Column]:
    """Masked mean (denominator n + 1e-8) and its unbiased variance; 0 or 1 tokens is an error."""
    n = F.col("_n")
    mean = F.col("_mean") * n / (n + EPS)
    shift = F.col("_mean") - mean
    var = (F.col("_m2") + n * shift * shift) / (n + EPS) * n / (n - 1)
    error = F.raise_error(F.lit("masked variance needs more than one token"))
    return mean, F.when(F.coalesce(n, F.lit(0)) <= 1, error.cast("double")).otherwise(var)


def masked_variance(df: DataFrame, value: Column, mask: Column, keys: Sequence[str]) -> DataFrame:
    """Per group: token count, masked mean, masked unbiased variance."""
    mean, var = _mean_and_var()
    stats = df.groupBy(*keys).agg(*masked_moments(value, mask))
    return stats.select(*keys, F.col("_n").alias("n"), mean.alias("mean"), var.alias("var"))


def whiten(
    df: DataFrame,
    value: str,
    mask: Column,
    keys: Sequence[str],
    out: str,
    shift_mean: bool = True,
    weight: Column | None = None,
) -> DataFrame:
    """Whiten ``value`` inside each group (a training step): one aggregate and a join back."""
    mean, var = _mean_and_var()
    stats = with_stats(df, keys, *masked_moments(F.col(value), mask, weight))
    scaled = (F.col(value) - mean) / F.sqrt(var + EPS)
    return stats.withColumn(out, scaled if shift_mean else scaled + mean).drop("_n", "_mean", "_m2")
