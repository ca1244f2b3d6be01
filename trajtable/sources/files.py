"""Readers for prompt files, trace logs, shard outputs and rollout dumps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_rows(spark: SparkSession, files: Sequence[str], schema: str | None = None) -> DataFrame:
    """Parquet, JSON and JSON-lines files by extension, stacked by column name."""

    def one(path: str) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        if path.endswith(".parquet"):
            return reader.parquet(path)
        if path.endswith((".json", ".jsonl")):
            return reader.json(path)
        raise ValueError(f"unsupported file format: {path}")

    if not files:
        raise ValueError("no files")
    return reduce(lambda a, b: a.unionByName(b), map(one, files))


TRACE_SCHEMA = (
    "request_id string, event_no bigint, response_pos int, emit_token_id int, internal_stop_token_id int, "
    "positions array<int>, tokens array<int>"
)


def read_events(spark: SparkSession, path: str, schema: str = TRACE_SCHEMA) -> DataFrame:
    """Event log in JSON lines; blank and undecodable lines and rows without request id are skipped."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows.where(F.coalesce("request_id", F.lit("")) != "")


def read_shards(spark: SparkSession, folder: str, expected: int, schema: str) -> DataFrame:
    """``shard_<n>.jsonl`` outputs with their shard number.

    Fails unless there are ``expected`` shards and every one has a ``shard_<n>.summary.json``.
    """
    number = lambda: F.regexp_extract(F.input_file_name(), r"shard_(\d+)\.", 1).cast("int")
    rows = spark.read.schema(schema).json(f"{folder}/shard_*.jsonl").withColumn("shard", number())
    summaries = spark.read.json(f"{folder}/shard_*.summary.json").withColumn("shard", number())
    found = rows.select("shard").distinct().join(
        summaries.select("shard", F.lit(1).alias("_s")).distinct(), "shard", "left"
    ).agg(F.count(F.lit(1)).alias("n"), F.count("_s").alias("with_summary")).first()
    if found["n"] != expected or found["with_summary"] != expected:
        raise ValueError(f"expected {expected} shards with summaries, found {found['n']} and {found['with_summary']}")
    return rows


def read_dumps(spark: SparkSession, folder: str, pattern: str | None = None, mask: str = "*") -> DataFrame:
    """``<step>.jsonl`` dumps as (step, fields): a map of texts, other values re-encoded as JSON.

    ``pattern`` is masked in every value.
    """
    lines = spark.read.text(f"{folder}/*.jsonl").withColumn("file", F.input_file_name())
    step = F.regexp_extract("file", r"(\d+)\.jsonl", 1).cast("bigint")
    fields = F.from_json("value", "map<string,string>")
    if pattern:
        fields = F.transform_values(fields, lambda _, v: F.regexp_replace(v, pattern, mask))
    return lines.where(F.trim("value") != "").select(step.alias("step"), fields.alias("fields"))
