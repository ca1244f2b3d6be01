"""Writers for rollout dumps, merged trajectories, metrics and evaluation tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: columns of merged trajectories
TEACHER_COLUMNS = (
    "messages", "prompt_token_ids", "response_token_ids", "sample_idx", "unique_id", "gt", "enable_thinking",
    "eos_reached", "finish_reason", "gen_len", "data_source",
)


def write_dump(df: DataFrame, folder: str, order: Sequence[str] = ("uid", "session_id", "output_idx")) -> None:
    """JSON lines by step, sorted inside a step. The range shuffle splits a huge step over several files."""
    rows = df.repartitionByRange("step", *order).sortWithinPartitions("step", *order)
    rows.write.mode("overwrite").partitionBy("step").json(folder)


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write a table in hash buckets of ``keys``, sorted inside them, and return it.

    Two tables with equal buckets join and aggregate by these keys without a shuffle, each time they
    are read. A bucket is one file and one task, so choose ``buckets`` by the size of the larger
    table; where one key holds a large part of the rows, join plain tables, whose skewed parts are split.
    The session's catalog keeps the buckets under the name ``table``; other sessions declare them with
    ``read_bucketed``.
    """
    keys = list(keys)
    rows = df.repartition(buckets, *keys)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def read_bucketed(spark: SparkSession, table: str, path: str, schema: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Declare a table that ``write_bucketed`` wrote, in another session."""
    names = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({schema}) USING parquet CLUSTERED BY ({names}) SORTED BY ({names}) INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def write_checked(df: DataFrame, path: str, columns: Sequence[str] = TEACHER_COLUMNS) -> int:
    """Write a fixed column list as parquet and compare the row count with what was read back."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    rows = df.select(*columns)
    rows.write.mode("overwrite").parquet(path)
    expected, written = rows.count(), df.sparkSession.read.parquet(path).count()
    if expected != written:
        raise ValueError(f"wrote {written} of {expected} rows")
    return written


def flat_names(schema: T.StructType, sep: str = "/", prefix: str = "") -> list[tuple[str, str]]:
    """(column path, flat name) of every leaf of nested structs."""
    out = []
    for field in schema:
        path, name = (f"{prefix}.`{field.name}`", field.name) if prefix else (f"`{field.name}`", field.name)
        if isinstance(field.dataType, T.StructType):
            out += [(p, f"{name}{sep}{rest}") for p, rest in flat_names(field.dataType, sep, path)]
        else:
            out.append((path, name))
    return out


def clean_key(key: Column) -> Column:
    """``@`` to ``_at_``, runs of slashes to one, any other unusual character to ``_``."""
    key = F.regexp_replace(key, "@", "_at_")
    key = F.regexp_replace(key, "/+", "/")
    return F.regexp_replace(key, r"[^/\w.\- :]", "_")


def metric_rows(df: DataFrame, step: str = "step") -> DataFrame:
    """A wide or nested metric record per step as (step, key, value) rows with clean keys."""
    leaves = [(p, n) for p, n in flat_names(df.schema) if n != step]
    cells = F.array(*[F.struct(F.lit(n).alias("key"), F.col(p).cast("double").alias("value")) for p, n in leaves])
    rows = df.select(step, F.inline(cells)).where(F.col("value").isNotNull())
    return rows.withColumn("key", clean_key(F.col("key")))


def append_metrics(df: DataFrame, path: str, step: str = "step") -> None:
    metric_rows(df, step).write.mode("append").parquet(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """One line per run, step and benchmark; rates with six decimals, wall time with three."""
    rate = lambda c: F.format_string("%.6f", F.col(c)).alias(c)
    rows = df.select(
        "run", "step", "bench", rate("avg_at_k"), rate("pass_at_1"), rate("pass_at_k"), "n_problems",
        F.format_string("%.3f", F.col("wall_seconds")).alias("wall_seconds"),
    )
    rows.write.mode("overwrite").option("sep", "\t").csv(path)
