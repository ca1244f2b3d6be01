"""Batch shape: concatenate, project, take, chunk, repeat, unfold. Rows carry a stored index column."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.plans.skew import positions, ranked


def with_index(df: DataFrame, order: Sequence[Column], out: str = "idx") -> DataFrame:
    """Global 0-based row number in the given order; a null order value comes first."""
    return positions(df, order, out)


def counted(df: DataFrame, out: str = "n_rows") -> DataFrame:
    """Attach the row count."""
    return with_constants(df, F.count(F.lit(1)).alias(out))


def with_constants(df: DataFrame, *aggregates: Column) -> DataFrame:
    """Attach whole-table aggregates to every row, as scalar subqueries."""
    one = df.agg(*aggregates)
    return df.withColumns({name: one.select(name).scalar() for name in one.columns})


def concat(parts: Sequence[DataFrame], meta: Sequence[str] = ()) -> DataFrame:
    """Stack batches; columns in ``meta`` must hold one value over all of them."""
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    if not meta:
        return rows
    rows = with_constants(
        rows, *[F.min(c).alias(f"_lo_{c}") for c in meta], *[F.max(c).alias(f"_hi_{c}") for c in meta]
    )
    for c in meta:
        clash = F.raise_error(F.lit(f"meta column {c} differs between batches")).cast(dict(rows.dtypes)[c])
        rows = rows.withColumn(c, F.when(F.col(f"_lo_{c}").eqNullSafe(F.col(f"_hi_{c}")), F.col(c)).otherwise(clash))
    return rows.drop(*[f"_{k}_{c}" for c in meta for k in ("lo", "hi")])


def project(df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] = (), rename: dict[str, str] | None = None) -> DataFrame:
    df = df.select(*keep) if keep else df
    return df.drop(*drop).withColumnsRenamed(rename or {})


def take(df: DataFrame, start: int = 0, stop: int | None = None, step: int = 1, index: str = "idx") -> DataFrame:
    """Rows start, start + step, ... before stop, by the stored index."""
    i = F.col(index)
    cond = (i >= start) & (F.pmod(i - start, F.lit(step)) == 0)
    return df.where(cond & (i < stop) if stop is not None else cond)


def take_list(df: DataFrame, wanted: DataFrame, index: str = "idx") -> DataFrame:
    """Rows by an index list (order column ``slot``); an index may be listed more than once."""
    return wanted.join(df, index)


def chunks(df: DataFrame, k: int, index: str = "idx", out: str = "chunk") -> DataFrame:
    """k equal parts; the row count must be divisible."""
    rows = counted(df, "_n")
    uneven = F.raise_error(F.lit(f"rows are not divisible by {k}")).cast("bigint")
    part = F.floor(F.col(index) * k / F.col("_n")).cast("bigint")
    return rows.withColumn(out, F.when(F.col("_n") % k != 0, uneven).otherwise(part)).drop("_n")


def splits(df: DataFrame, size: int, index: str = "idx", out: str = "split") -> DataFrame:
    """Runs of ``size`` rows, the last one shorter."""
    return df.withColumn(out, F.floor(F.col(index) / size).cast("bigint"))


def dataset_split(df: DataFrame, k: int, index: str = "idx", out: str = "part") -> DataFrame:
    """k equal contiguous parts; the remainder rows are left out."""
    rows = counted(df, "_n").withColumn("_size", F.floor(F.col("_n") / k))
    rows = rows.where(F.col(index) < F.col("_size") * k)
    return rows.withColumn(out, F.floor(F.col(index) / F.col("_size")).cast("bigint")).drop("_n", "_size")


def repeat(df: DataFrame, n: int, interleave: bool = True, index: str = "idx", out: str = "new_idx") -> DataFrame:
    """n copies, row by row or batch by batch."""
    rows = counted(df, "_n").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    place = F.col(index) * n + F.col("copy") if interleave else F.col("copy") * F.col("_n") + F.col(index)
    return rows.withColumn(out, place.cast("bigint")).drop("_n")


def repeat_var(df: DataFrame, times: Column) -> DataFrame:
    """Copies per row; 0 drops the row."""
    return df.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(0), times.cast("int") - 1)).otherwise(F.array().cast("array<int>"))))


def unfold(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """Cut array columns into n equal pieces, one row each; other columns repeat."""
    first = columns[0]
    uneven = F.raise_error(F.lit(f"array length is not divisible by {n}")).cast("int")
    size = F.when(F.size(first) % n != 0, uneven).otherwise((F.size(first) / n).cast("int"))
    rows = df.withColumn("_size", size).withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return rows.withColumns({c: F.slice(c, F.col("piece") * F.col("_size") + 1, F.col("_size")) for c in columns}).drop("_size")


def minibatches(df: DataFrame, size: int, epochs: int, seed: int, key: Column, index: str = "idx") -> DataFrame:
    """Equal mini-batches per epoch in a seeded order (md5 of seed, epoch and row key)."""
    rows = counted(df, "_n").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    uneven = F.raise_error(F.lit(f"rows are not divisible by {size}")).cast("string")
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("epoch").cast("string"), key.cast("string")))
    rows = rows.withColumn("_draw", F.when(F.col("_n") % size != 0, uneven).otherwise(draw)).drop("_n")
    ranks = ranked(rows, ["epoch"], [F.col("_draw")], out="_rank")
    return ranks.withColumn("minibatch", F.floor((F.col("_rank") - 1) / size).cast("bigint")).drop("_draw", "_rank")
