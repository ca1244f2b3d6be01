"""Streaming state, late rows and stored buckets on small tables that arrive in pieces."""

import datetime as dt
import os

from conftest import rows
from pyspark.sql import functions as F

from trajtable.operators import handoff
from trajtable.session import scratch
from trajtable.sources import sinks
from trajtable.streaming import samples
from trajtable.streaming.state import run_append

DAY = dt.datetime(2024, 1, 1)


def fed(spark, batches, schema):
    """A stream that brings one list of rows in each micro-batch."""
    folder = f"{scratch(spark)}/in"
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def epochs(folder, table):
    return sorted(int(n.split("=")[1]) for n in os.listdir(f"{folder}/{table}") if n.startswith("epoch="))


def test_span_of_a_user_who_returns(spark):
    """After 60 days, with state kept for 5; a late row and one without time count too."""
    at = lambda d: DAY + dt.timedelta(days=d)
    batches = [
        [("a", 3, at(0)), ("b", 1, at(0)), ("b", 1, at(1))], [("c", 5, at(30)), (None, 2, at(30))], [("a", 7, at(60))],
        [("b", 0, at(2)), ("c", 5, None), (None, 4, at(61))],
    ]
    stream = fed(spark, batches, "traj string, version bigint, ts timestamp")
    folder = scratch(spark)
    got = samples.version_span(stream, folder, "traj", "version", "ts", "5 days")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", 3, 7, True), ("b", 0, 1, True), ("c", 5, 5, False), (None, 2, 4, True)], key=str
    )
    # only the last two epochs of the state are there
    assert epochs(folder, "live") == epochs(folder, "merged") == [2, 3]
    assert spark.read.parquet(f"{folder}/live/epoch=3").where("traj = 'c' and newest < timestamp'2024-02-10'").count() == 0


def test_replay_gate_forgets(spark):
    batches = [[(1, 1, "running", 1)], [(1, 1, "success", 2), (2, 2, "success", 3)], [(3, 3, "failure", 4)], [(4, 4, "success", 5)]]
    folder = scratch(spark)
    got = samples.replay_gate(fed(spark, batches, "key bigint, step bigint, status string, seq bigint"), folder, "key", "step", "seq")
    assert rows(got.select("key", "seq"), "key") == [(1, 2), (2, 3), (4, 5)]
    assert epochs(folder, "merged") == epochs(folder, "open") == [2, 3]


def test_late_rows_are_kept_apart(spark):
    """Every row that arrives is kept, a repeat, or late."""
    at = lambda h: DAY + dt.timedelta(hours=h)
    batches = [
        [(1, at(0)), (2, at(1)), (2, at(1))], [(3, at(10)), (1, at(2))], [(4, at(3)), (5, at(9)), (3, at(11))], [(6, at(2)), (7, None), (8, at(12))],
    ]
    folder = scratch(spark)
    stream = fed(spark, batches, "id bigint, ts timestamp")
    kept, late = samples.on_time(stream, f"{folder}/gate", "ts", "2 hours")
    table = run_append(samples.unique_events(kept.where("ts IS NOT NULL"), ["id"], "ts", "2 hours"), folder)
    assert rows(late.select("id"), "id") == [(4,), (6,)]
    found = [r[0] for r in rows(table.select("id"), "id")]
    arrived = sum(map(len, batches))
    on_time = spark.read.parquet(f"{folder}/gate/on_time/epoch=*")
    assert on_time.count() + late.count() == arrived
    assert found == [1, 2, 3, 5, 8]
    repeated = on_time.where("ts IS NOT NULL").count() - len(found)
    assert arrived == len(found) + repeated + late.count() + 1 and repeated == 3  # one row has no time


def test_buckets_join_without_a_shuffle(spark):
    events = spark.range(2000).select((F.col("id") % 97).cast("string").alias("request_id"), F.col("id").alias("event_no"), (F.col("id") % 50).cast("int").alias("response_pos"))
    gens = spark.range(120).select(F.col("id").cast("string").alias("request_id"), (F.col("id") % 40).cast("int").alias("gen_len"))
    base = scratch(spark)
    stored = [sinks.write_bucketed(t, f"test_buckets_{k}", f"{base}/{k}", ["request_id"], 8) for k, t in (("e", events), ("g", gens))]
    joined = handoff.events_per_generation(*stored)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert rows(joined, "request_id") == rows(handoff.events_per_generation(events, gens), "request_id")
    again = sinks.read_bucketed(spark, "test_buckets_again", f"{base}/e", "request_id string, event_no bigint, response_pos int", ["request_id"], 8)
    assert "Exchange" not in handoff.events_per_generation(again, stored[1])._jdf.queryExecution().executedPlan().toString()
    for name in ("test_buckets_e", "test_buckets_g", "test_buckets_again"):
        spark.sql(f"DROP TABLE {name}")
