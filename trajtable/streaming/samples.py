"""Sample queues, staleness, partial rollouts and the replay gate as streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajtable.operators.batch import with_index
from trajtable.plans.skew import ranked
from trajtable.streaming.state import EpochTable, run_epochs


def sample_batches(stream: DataFrame, folder: str, required: int, order: str) -> DataFrame:
    """Cut arriving samples into training batches of ``required``; the last one may still be open."""
    spark = stream.sparkSession
    out = EpochTable(spark, f"{folder}/rows", f"{order} bigint, position bigint")
    seen = EpochTable(spark, f"{folder}/seen", "n bigint")

    def step(rows: DataFrame, epoch: int) -> None:
        past = seen.before(epoch).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_past")).scalar()
        new = with_index(rows.select(order), [F.col(order)], out="_i")
        written = out.write(new.withColumn("position", F.col("_i") + past), epoch)
        seen.write(written.agg((F.count(F.lit(1)) + past).alias("n")), epoch)
        seen.forget(epoch)

    run_epochs(stream, folder, step)
    rows = out.all()
    return rows.withColumn("batch", F.floor(F.col("position") / required).cast("bigint"))


def bounded_queue(stream: DataFrame, folder: str, key: str, order: str, capacity: int) -> tuple[DataFrame, DataFrame]:
    """The newest ``capacity`` samples per key, and how many arrived and were dropped for newer ones.

    Returns the samples kept and the counters per key. The order must be total within a key.
    """
    spark = stream.sparkSession
    queue = EpochTable(spark, f"{folder}/queue", f"{key} string, {order} bigint")
    counters = EpochTable(spark, f"{folder}/counters", f"{key} string, produced bigint")

    def step(rows: DataFrame, epoch: int) -> None:
        fresh = rows.select(key, order)
        merged = queue.before(epoch).unionByName(fresh)
        newest = ranked(merged, [key], [F.col(order).desc()], out="_new")
        queue.write(newest.where(F.col("_new") <= capacity), epoch)
        now = fresh.groupBy(key).agg(F.count(F.lit(1)).alias("produced"))
        total = counters.before(epoch).unionByName(now).groupBy(key).agg(F.sum("produced").alias("produced"))
        counters.write(total, epoch)
        queue.forget(epoch)
        counters.forget(epoch)

    last = run_epochs(stream, folder, step)
    kept = queue.before(last + 1)
    left = kept.groupBy(key).agg(F.count(F.lit(1)).alias("_kept"))
    counts = counters.before(last + 1).join(left, key).withColumn("dropped", F.col("produced") - F.col("_kept")).drop("_kept")
    return kept, counts


def staleness(samples: DataFrame, versions: DataFrame, slot: str, sample_version: str, current: str) -> DataFrame:
    """Version lag of streamed samples against the trainer's version (a static table per slot)."""
    lag = F.col(current) - F.col(sample_version)
    return samples.join(versions, slot).withColumn("lag", lag).withColumn("stale", lag >= 1)


def staleness_cap(required: int, threshold: float, sync_interval: int) -> int:
    """Samples that may be in flight before generation pauses."""
    return int(required * (threshold + 1) * sync_interval)


def staleness_summary(rows: DataFrame, current: str, cap: int) -> DataFrame:
    """Per trainer version: samples, stale ones, whether generation pauses, and how many exceed the cap."""
    n = F.count(F.lit(1))
    return rows.groupBy(current).agg(
        n.alias("samples"), F.count(F.when(F.col("stale"), 1)).alias("stale"), F.max("lag").alias("max_lag"),
        (n >= cap).alias("paused"), F.greatest(n - cap, F.lit(0)).cast("bigint").alias("over_cap"),
    )


def version_span(stream: DataFrame, folder: str, traj: str, version: str, time: str, pause: str) -> DataFrame:
    """Smallest and largest model version of a whole trajectory; partial when they differ.

    The state holds the spans of the trajectories of the last ``pause`` before the newest row. Older ones
    are put away and merged again when the result is read, so one that comes back after any pause is
    still one row. Rows may come late or in any order.
    """
    spark = stream.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    schema = f"{traj} {kinds[traj]}, min_version {kinds[version]}, max_version {kinds[version]}, newest {kinds[time]}"
    merged, live, closed = (EpochTable(spark, f"{folder}/{name}", schema) for name in ("merged", "live", "closed"))
    ends = [F.min("min_version").alias("min_version"), F.max("max_version").alias("max_version"), F.max("newest").alias("newest")]

    def step(rows: DataFrame, epoch: int) -> None:
        new = rows.select(traj, F.col(version).alias("min_version"), F.col(version).alias("max_version"), F.col(time).alias("newest"))
        now = merged.write(live.before(epoch).unionByName(new).groupBy(traj).agg(*ends), epoch)
        last = now.agg(F.max("newest")).scalar()
        recent = F.coalesce(F.col("newest") >= last - F.expr(f"INTERVAL {pause}"), F.lit(True))
        live.write(now.where(recent), epoch)
        closed.write(now.where(~recent), epoch)
        merged.forget(epoch)
        live.forget(epoch)

    last = run_epochs(stream, folder, step)
    spans = closed.all().drop("epoch").unionByName(live.before(last + 1)).groupBy(traj).agg(*ends)
    return spans.select(traj, "min_version", "max_version", (F.col("min_version") != F.col("max_version")).alias("partial"))


def replay_gate(stream: DataFrame, folder: str, key: str, step_column: str, order: str) -> DataFrame:
    """Release the successful rows of a step once none of its rows is running.

    Tags arrive as (key, step, status); later tags replace earlier ones. The state holds the last tag
    of every key of steps not yet released.
    """
    spark = stream.sparkSession
    schema = f"{key} bigint, {step_column} bigint, status string, {order} bigint"
    open_tags, tags_now = EpochTable(spark, f"{folder}/open", schema), EpochTable(spark, f"{folder}/merged", schema)
    released = EpochTable(spark, f"{folder}/released", schema)

    def step(rows: DataFrame, epoch: int) -> None:
        tags = open_tags.before(epoch).unionByName(rows.select(key, step_column, "status", order))
        last = tags.groupBy(key, step_column).agg(F.max_by("status", order).alias("status"), F.max(order).alias(order))
        merged = tags_now.write(last, epoch)
        running = merged.where("status = 'running'").select(step_column).distinct()
        open_tags.write(merged.join(running, step_column, "left_semi"), epoch)
        done = merged.join(running, step_column, "left_anti").where("status = 'success'")
        released.write(done, epoch)
        open_tags.forget(epoch)
        tags_now.forget(epoch)

    run_epochs(stream, folder, step)
    return released.all().drop("epoch")


def on_time(stream: DataFrame, folder: str, time: str, delay: str) -> tuple[DataFrame, DataFrame]:
    """Split a stream into the rows on time, as a stream of its own, and a table of the late ones.

    A row is late when it is older than the newest row of the micro-batches before its own, less
    ``delay``; a null time is on time. A stateful job with the same watermark on the first drops nothing,
    as it reads all that is there as one micro-batch: every row that arrives is in one of the two.
    """
    spark = stream.sparkSession
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stream.schema)
    kept, late = EpochTable(spark, f"{folder}/on_time", schema), EpochTable(spark, f"{folder}/late", schema)
    clock = EpochTable(spark, f"{folder}/clock", f"newest {stream.schema[time].dataType.simpleString()}")

    def step(rows: DataFrame, epoch: int) -> None:
        past = clock.before(epoch)
        edge = past.agg(F.max("newest") - F.expr(f"INTERVAL {delay}")).scalar()
        behind = F.coalesce(F.col(time) < edge, F.lit(False))
        late.write(rows.where(behind), epoch)
        written = kept.write(rows.where(~behind), epoch)
        clock.write(past.unionByName(written.agg(F.max(time).alias("newest"))).agg(F.max("newest").alias("newest")), epoch)
        clock.forget(epoch)

    run_epochs(stream, folder, step)
    again = spark.readStream.schema(stream.schema).parquet(f"{folder}/on_time/epoch=*")
    return again, late.all().drop("epoch")


def unique_events(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Append-only trace events without repeats: an event is known by its keys, whatever its time.

    The watermark bounds what is remembered; rows behind it are left out, unless ``on_time`` has put them aside.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)
