"""Deduplication, ordering, row limits, seeded sampling and resampling.

Seeded orders use md5 of the seed and the row key: repeatable, independent of partitioning, and
equal on any engine. They do not reproduce the permutations of another random generator.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.plans.skew import by_sort, join_on, materialise, running, with_stats


def canonical(value: Column, kind: str = "map") -> Column:
    """Text of a nested key; maps compare regardless of entry order."""
    return F.to_json(F.array_sort(F.map_entries(value))) if kind == "map" else F.to_json(value)


def seeded(seed: int, *key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[k.cast("string") for k in key]))


def uniform(draw: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an md5 text."""
    return F.conv(F.substring(draw, 1, 13), 16, 10).cast("bigint") / float(2**52)


def first_rows(df: DataFrame, n: int, order: str) -> DataFrame:
    """First n rows by a stored position: each task keeps its own first n, and these meet in one task.

    For a large n, number the rows with ``skew.positions`` and filter.
    """
    return df.orderBy(order).limit(n)


def _lowest(df: DataFrame, n: int, draw: Column, key: Column) -> DataFrame:
    return df.withColumns({"_draw": draw, "_key": key}).orderBy("_draw", "_key").limit(n).drop("_draw", "_key")


def sample_rows(df: DataFrame, n: int, seed: int, key: Column) -> DataFrame:
    """n rows without replacement in a seeded order; n of every task meet in one (see ``first_rows``)."""
    return _lowest(df, n, seeded(seed, key), key)


def review_sample(df: DataFrame, n: int, seed: int, first: Column, key: Column) -> DataFrame:
    """A seeded shuffle of the rows by their input, the first n of them."""
    return _lowest(df, n, seeded(seed, first, key), key)


def score_order(df: DataFrame) -> Column:
    """score, else score_1, else 0."""
    cols = [F.col(c) for c in ("score", "score_1") if c in df.columns]
    return F.coalesce(*cols, F.lit(0.0))


def ordered_by_score(df: DataFrame, descending: bool, ties: Sequence[str]) -> DataFrame:
    key = score_order(df)
    return df.orderBy(key.desc() if descending else key.asc(), *ties)


def matching_lines(df: DataFrame, text: str, keyword: str, *keep: str) -> DataFrame:
    """Lines that contain the keyword, with their line number."""
    lines = df.where(F.col(text).contains(keyword)).select(*keep, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return lines.where(F.col("line").contains(keyword))


def check_merge(df: DataFrame, index: str, shard: str, expected: str) -> DataFrame:
    """Merge checks in one row: rows, duplicated indices, and whether shards agree on the source count.

    ``ok`` is an error instead of false when a check fails.
    """
    per = df.groupBy(index).agg(F.count(F.lit(1)).alias("_k"), F.min(expected).alias("_lo"), F.max(expected).alias("_hi"))
    stats = per.agg(
        F.sum("_k").alias("n_rows"), F.count(F.when(F.col("_k") > 1, 1)).alias("duplicates"),
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
    )
    problem = (
        F.when(F.col("duplicates") > 0, "duplicate index").when(F.col("_lo") != F.col("_hi"), "shards disagree on the source count")
        .when(F.col("n_rows") != F.col("_hi"), "row count differs from the source")
    )
    return stats.withColumn("ok", F.when(problem.isNotNull(), F.raise_error(problem).cast("boolean")).otherwise(F.lit(True))).select(
        "n_rows", "duplicates", "ok"
    )


def resample_weights(score: Column, method: str, power: float, top: Column, bottom: Column) -> Column:
    """|s| ** power; or 1 for the extremes and 0 else; or 0.4 for the best and 0.1 else. At least 1e-8."""
    if method == "pow":
        raw = F.pow(F.abs(score), F.lit(power))
    elif method == "max_min":
        raw = F.when((score == top) | (score == bottom), 1.0).otherwise(0.0)
    elif method == "max_random":
        raw = F.when(score == top, 0.4).otherwise(0.1)
    else:
        raise ValueError(f"unknown resampling {method}")
    return F.greatest(raw, F.lit(0.0)) + 1e-8


def resample(
    df: DataFrame, score: str, ids: Sequence[str], batch: Sequence[str] = ("step",), method: str = "pow", power: float = 2.0,
    seed: int = 42,
) -> DataFrame:
    """Draw as many rows as the batch has, with replacement, in proportion to the weights.

    Every row is the owner of the interval between the cumulative weights before and after it. The
    draws are a stratified set of seeded numbers, one per n-th of the total weight, so a row knows
    from its interval alone how many draws hit it: at most one partial stratum at either end is
    decided by the seeded number of that stratum. ``ids`` must tell the rows of a batch apart.
    """
    ids, batch = list(ids), list(batch)
    rows = with_stats(df, batch, F.max(score).alias("_top"), F.min(score).alias("_bottom"))
    weight = resample_weights(F.col(score), method, power, F.col("_top"), F.col("_bottom"))
    # decimals add up exactly, so neighbouring rows agree on the edge between them
    rows = rows.select(*batch, *ids, weight.cast("decimal(20,10)").alias("_w"), seeded(seed, *map(F.col, ids)).alias("_draw"))
    order = [F.col("_draw"), *map(F.col, ids)]
    totals = {"_total": F.col("_w"), "_n": F.lit(1)}
    rows = running(by_sort(materialise(rows), batch, order), batch, order, behind={"_cum": F.col("_w")}, whole=totals)
    unit = F.col("_total").cast("double") / F.col("_n")
    edge = lambda c: F.least(c.cast("double") / unit, F.col("_n").cast("double"))
    # number of draws below a point: whole strata, plus the one the point falls in if its draw is lower
    def drawn_below(point: Column) -> Column:
        stratum = F.floor(point)
        mark = uniform(seeded(seed, *map(F.col, batch), stratum))
        return stratum + F.when(mark < point - stratum, 1).otherwise(0)

    after, before = edge(F.col("_cum")), edge(F.col("_cum") - F.col("_w"))
    rows = rows.withColumn("copies", (drawn_below(after) - drawn_below(before)).cast("int"))
    drawn = rows.where(F.col("copies") > 0).select(*batch, *ids, "copies")
    return join_on(df, drawn, [*batch, *ids]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))


def replica_seed(base: int, index: Column) -> Column:
    return F.lit(base) + index
