"""Length-balanced bins on the trajectory table, per training step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.plans.skew import join_on, ranked, with_stats


def workload(length: Column) -> Column:
    """Relative cost of a sequence: linear part plus attention (fixed value 24576)."""
    n = length.cast("bigint")
    return 24576 * n + n * n


def _deal(rank0: Column, k: Column) -> Column:
    """Zig-zag deal: 0..k-1, then k-1..0, and again."""
    lap, seat = F.floor(rank0 / k), rank0 % k
    return F.when(lap % 2 == 0, seat).otherwise(k - 1 - seat).cast("bigint")


def pack_balanced(
    df: DataFrame, k: int, cost: str, ids: Sequence[str], batch: Sequence[str] = ("step",), out: str = "bin"
) -> DataFrame:
    """k bins of equal row count (up to one) and near-equal workload.

    Rows are ranked by falling workload and dealt zig-zag; ``ids`` breaks ties.
    """
    order = [F.col(cost).desc(), *map(F.col, ids)]
    rows = ranked(df, batch, order, out="_rank")
    return rows.withColumn(out, _deal(F.col("_rank") - 1, F.lit(k))).drop("_rank")


def pack_by_group(
    df: DataFrame, k: int, cost: str, group: str = "uid", batch: Sequence[str] = ("step",), out: str = "bin", equal_counts: bool = False
) -> DataFrame:
    """Like ``pack_balanced`` with all rows of a group in one bin.

    With ``equal_counts`` a number of groups that is no multiple of ``k`` is an error.
    """
    keys = [*batch, group]
    groups = df.groupBy(*keys).agg(F.sum(cost).alias("_cost"))
    if equal_counts:
        uneven = F.raise_error(F.concat(F.col("_n").cast("string"), F.lit(f" groups cannot be dealt evenly to {k} bins"))).cast("bigint")
        groups = with_stats(groups, batch, F.count(F.lit(1)).alias("_n"))
        groups = groups.withColumn("_cost", F.when(F.col("_n") % k != 0, uneven).otherwise(F.col("_cost"))).drop("_n")
    dealt = pack_balanced(groups, k, "_cost", [group], batch, out).select(*keys, out)
    return join_on(df, dealt, keys)


def pack_by_tokens(
    df: DataFrame, max_tokens: int, length: str, ids: Sequence[str], batch: Sequence[str] = ("step",),
    at_least: int = 1, multiple: int = 1, out: str = "bin",
) -> DataFrame:
    """min(rows, ceil(tokens / max)) bins per batch, at least ``at_least``, rounded up to a multiple."""
    too_long = F.raise_error(F.concat(F.lit("row longer than the bin: "), F.col("_longest").cast("string")))
    rows = with_stats(
        df, batch, F.count(F.lit(1)).alias("_rows"), F.sum(length).alias("_tokens"), F.max(length).alias("_longest")
    )
    bins = F.greatest(F.least(F.col("_rows"), F.ceil(F.col("_tokens") / max_tokens)), F.lit(at_least))
    bins = (F.ceil(bins / multiple) * multiple).cast("bigint")
    rows = rows.withColumn("bins", F.when(F.col("_longest") > max_tokens, too_long.cast("bigint")).otherwise(bins))
    rows = rows.withColumn("_cost", workload(F.col(length)))
    order = [F.col("_cost").desc(), *map(F.col, ids)]
    ranks = ranked(rows, batch, order, out="_rank")
    return ranks.withColumn(out, _deal(F.col("_rank") - 1, F.col("bins"))).drop(
        "_rank", "_cost", "_rows", "_tokens", "_longest"
    )


def pack_order(
    df: DataFrame, cost: str, ids: Sequence[str], keys: Sequence[str] = ("step", "bin"), out: str = "position"
) -> DataFrame:
    """Small, large, small inside a bin: every second rank rises, the others fall after them."""
    rows = ranked(df, keys, [F.col(cost), *map(F.col, ids)], out="_rank")
    rows = with_stats(rows, keys, F.count(F.lit(1)).alias("_n"))
    r = F.col("_rank") - 1
    spot = F.when(r % 2 == 0, r / 2).otherwise(F.col("_n") - 1 - (r - 1) / 2)
    return rows.withColumn(out, spot.cast("bigint")).drop("_rank", "_n")


def bin_order(bins: DataFrame, cost: str, batch: Sequence[str] = ("step",), out: str = "bin_position") -> DataFrame:
    """Order of the bins (one row each): heavy in the middle, light at both ends."""
    rows = ranked(bins, batch, [F.col(cost).desc(), F.col("bin").desc()], out="_rank")
    rows = with_stats(rows, batch, F.count(F.lit(1)).alias("_n"))
    r, front = F.col("_rank") - 1, F.ceil(F.col("_n") / 2)
    spot = F.when(r % 2 == 0, front - 1 - r / 2).otherwise(front + (r - 1) / 2)
    return rows.withColumn(out, spot.cast("bigint")).drop("_rank", "_n")


def pack_stats(
    df: DataFrame, k: int, cost: str, position: str, bin_column: str = "bin", batch: Sequence[str] = ("step",)
) -> DataFrame:
    """Bin totals in arrival order (k equal runs) and after packing, one row per batch."""
    sized = with_stats(df, batch, F.count(F.lit(1)).alias("_n"))
    sized = sized.withColumn("_run", F.floor(F.col(position) * k / F.col("_n")))
    before = sized.groupBy(*batch, "_run").agg(F.sum(cost).alias("_c")).groupBy(*batch).agg(
        F.min("_c").alias("min_before"), F.max("_c").alias("max_before"), F.avg("_c").alias("mean"),
    )
    after = df.groupBy(*batch, bin_column).agg(F.sum(cost).alias("_c")).groupBy(*batch).agg(
        F.min("_c").alias("min_after"), F.max("_c").alias("max_after")
    )
    both = before.join(after, list(batch))
    return both.withColumn("diff_before", F.col("max_before") - F.col("min_before"))
