"""Sources, sinks, streaming jobs and the user-defined surface."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from trajtable.operators import batch as bt
from trajtable.operators import handoff, registry
from trajtable.operators import metrics as mt
from trajtable.operators import validation as va
from trajtable.plans.catalog.base import csv, query, r6
from trajtable.plans.catalog.corrections import rounded
from trajtable.plans.catalog.metrics import METRIC_WINDOW_SQL, metric_rows
from trajtable.session import scratch
from trajtable.sources import files, sinks
from trajtable.sources import tables as src
from trajtable.streaming import samples
from trajtable.streaming.state import run_append

# --- sources -------------------------------------------------------------------------------------


@query("src_rl_files", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def src_rl_files(spark, d):
    """Orders written as parquet, json and jsonl, read back as one table."""
    rows = src.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    base = scratch(spark)
    parts = {f"{base}/a.parquet": 0, f"{base}/b.json": 1, f"{base}/c.jsonl": 2}
    for path, k in parts.items():
        part = rows.where(F.col("o_orderkey") % 3 == k)
        part.write.parquet(path) if path.endswith("parquet") else part.write.json(path)
    return files.read_rows(spark, list(parts), schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string")


@query(
    "src_jsonl_tolerant",
    "SELECT user_id::VARCHAR AS request_id, event_id AS event_no, (props->>'$.k')::INT AS emit_token_id FROM events WHERE event_type IN ('click', 'view', 'purchase')",
)
def src_jsonl_tolerant(spark, d):
    """Signups become blank or broken lines, errors lose their request id."""
    ev = src.table(spark, d, "events")
    good = F.to_json(F.struct(F.col("user_id").cast("string").alias("request_id"), F.col("event_id").alias("event_no"), F.get_json_object("props", "$.k").cast("int").alias("emit_token_id")))
    line = F.when(F.col("event_type") == "signup", F.when(F.col("event_id") % 2 == 0, "   ").otherwise('{"request_id": "x", broken')).when(
        F.col("event_type") == "error", F.to_json(F.struct(F.col("event_id").alias("event_no")))
    ).otherwise(good)
    path = f"{scratch(spark)}/log.jsonl"
    ev.select(line.alias("value")).write.text(path)
    return files.read_events(spark, path).select("request_id", "event_no", "emit_token_id")


@query("src_shards", "SELECT (o_orderkey % 4)::INT AS shard, o_orderkey AS original_index, o_custkey AS gt FROM orders")
def src_shards(spark, d):
    base = scratch(spark)
    rows = src.table(spark, d, "orders").select(F.col("o_orderkey").alias("original_index"), F.col("o_custkey").alias("gt"))
    for k in range(4):
        part = rows.where(F.col("original_index") % 4 == k)
        part.write.json(f"{base}/shard_{k}.jsonl")
        part.agg(F.count(F.lit(1)).alias("rows")).write.json(f"{base}/shard_{k}.summary.json")
    return files.read_shards(spark, base, 4, "original_index bigint, gt bigint").select("shard", "original_index", "gt")


@query(
    "src_rollout_dumps",
    "SELECT o_orderkey // 4096 AS step, 'in ' || o_orderkey AS input, o_custkey::VARCHAR AS score, '[masked]-' || o_orderstatus AS output FROM orders",
)
def src_rollout_dumps(spark, d):
    base = scratch(spark)
    key = F.col("o_orderkey")
    rows = src.table(spark, d, "orders").select(
        F.floor(key / 4096).cast("bigint").alias("step"), F.concat(F.lit("in "), key.cast("string")).alias("input"), F.col("o_custkey").alias("score"),
        F.concat(F.lit("secret-"), "o_orderstatus").alias("output"),
    )
    name = F.concat(F.col("step").cast("string"), F.lit(".jsonl"))
    rows.withColumn("file", name).drop("step").write.partitionBy("file").json(base)
    f = F.col("fields")
    return files.read_dumps(spark, base, "secret", "[masked]").select("step", f["input"].alias("input"), f["score"].alias("score"), f["output"].alias("output"))


# --- sinks ---------------------------------------------------------------------------------------


@query("sink_rollout_dump", "SELECT l_orderkey // 1000 AS step, l_orderkey AS uid, round(score, 6) + 0.0 AS score, pred FROM (SELECT l_orderkey, round(l_discount * 100) / 97 AS score, l_returnflag || l_linestatus AS pred FROM lineitem)")
def sink_rollout_dump(spark, d):
    rows = src.rollouts(spark, d, index=True).select("step", "uid", F.col("line").alias("session_id"), F.col("sample_idx").alias("output_idx"), "score", "pred")
    path = f"{scratch(spark)}/dump"
    sinks.write_dump(rows, path)
    back = spark.read.schema("uid bigint, session_id int, output_idx bigint, score double, pred string, step bigint").json(path)
    return back.select("step", "uid", r6("score").alias("score"), "pred")


@query(
    "sink_bucketed_trace",
    """WITH e AS (SELECT request_id, count(*) AS n_events, max(event_no) AS last_event, count(*) FILTER (WHERE pos < gen_len) AS inside
  FROM single JOIN gens USING (request_id) GROUP BY request_id)
SELECT g.request_id, gen_len, n_events, last_event, inside FROM gens g JOIN e ON e.request_id = g.request_id""",
    ("trace",),
)
def sink_bucketed_trace(spark, d):
    """Events and generations stored by request, then joined and counted without moving either."""
    events = handoff.expand_events(src.event_log(spark, d)).where("response_pos IS NOT NULL")
    users = _events(spark, d, "user_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    gens = users.select(F.col("user_id").cast("string").alias("request_id"), (F.col("n") % 60 + 10).cast("int").alias("gen_len"))
    name = f"bucketed_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = [sinks.write_bucketed(t, f"{name}_{k}", f"{scratch(spark)}/{k}", ["request_id"], buckets) for k, t in (("events", events), ("gens", gens))]
    return handoff.events_per_generation(*stored)


@query("sink_offline_parquet", "SELECT doc_id::VARCHAR AS unique_id, len(response_ids)::INT AS gen_len, coalesce(array_to_string(response_ids, ','), '') AS response FROM words", ("words",))
def sink_offline_parquet(spark, d):
    w = src.words(spark, d)
    rows = w.select(
        F.array(F.struct(F.lit("user").alias("role"), F.col("lang").alias("content"))).alias("messages"), F.col("prompt_ids").alias("prompt_token_ids"),
        F.col("response_ids").alias("response_token_ids"), F.lit(0).alias("sample_idx"), F.col("doc_id").cast("string").alias("unique_id"), F.lit("").alias("gt"),
        F.lit(False).alias("enable_thinking"), F.lit(True).alias("eos_reached"), F.lit("stop").alias("finish_reason"), F.size("response_ids").alias("gen_len"),
        F.col("source").alias("data_source"),
    )
    path = f"{scratch(spark)}/merged"
    sinks.write_checked(rows, path)
    return spark.read.parquet(path).select("unique_id", "gen_len", csv("response_token_ids").alias("response"))


@query(
    "sink_metrics",
    """WITH s AS (SELECT l_orderkey // 1000 AS step, avg(l_discount) AS a, max(l_quantity) AS m, count(*) AS n FROM lineitem GROUP BY 1)
SELECT step, 'val/mean_at_4' AS key, round(a, 6) + 0.0 AS value FROM s UNION ALL SELECT step, 'val/max_x', m FROM s UNION ALL SELECT step, 'perf/n_rows', n::DOUBLE FROM s""",
)
def sink_metrics(spark, d):
    s = src.table(spark, d, "lineitem").groupBy(F.floor(F.col("l_orderkey") / 1000).cast("bigint").alias("step")).agg(
        F.avg("l_discount").alias("a"), F.max("l_quantity").alias("m"), F.count(F.lit(1)).alias("n")
    )
    nested = s.select("step", F.struct(F.col("a").alias("mean@4"), F.col("m").alias("/max#x")).alias("val"), F.struct(F.col("n").alias("n_rows")).alias("perf"))
    path = f"{scratch(spark)}/metrics"
    sinks.append_metrics(nested.where("step % 2 = 0"), path)
    sinks.append_metrics(nested.where("step % 2 = 1"), path)
    return rounded(spark.read.parquet(path), "step", "key")


@query(
    "sink_eval_tsv",
    """WITH per AS (SELECT data_source, uid, avg(acc) AS a, arg_min(acc, sample_idx) AS f, max(acc) AS m FROM rollouts GROUP BY data_source, uid)
SELECT 'run' AS run, 7 AS step, data_source AS bench, printf('%.6f', avg(a)) AS avg_at_k, printf('%.6f', avg(f)) AS pass_at_1, printf('%.6f', avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END)) AS pass_at_k,
  count(*) AS n_problems, '12.500' AS wall_seconds FROM per GROUP BY data_source""",
    ("rollouts",),
)
def sink_eval_tsv(spark, d):
    rows = src.rollouts(spark, d, source=True, index=True).withColumnRenamed("data_source", "bench")
    out = va.bench_summary(rows, ["bench"], "uid", "acc", "sample_idx").withColumns({"run": F.lit("run"), "step": F.lit(7), "wall_seconds": F.lit(12.5)})
    path = f"{scratch(spark)}/eval"
    sinks.write_tsv(out, path)
    schema = "run string, step int, bench string, avg_at_k string, pass_at_1 string, pass_at_k string, n_problems bigint, wall_seconds string"
    return spark.read.schema(schema).option("sep", "\t").csv(path)


# --- streaming -----------------------------------------------------------------------------------


FILES = 2  # files of an arrival


def _feed(spark, rows, order: str, job, parts: int = 4, sentinel=None):
    """Let rows arrive in order, a quarter in each micro-batch, and run the streaming job over them.

    Every arrival is written as FILES files, and a micro-batch takes that many.
    """
    base = scratch(spark)
    staged = bt.counted(bt.with_index(rows, [F.col(order)], out="_i"), "_n")
    staged = staged.withColumn("_part", F.floor(F.col("_i") * parts / F.col("_n")).cast("int"))
    for p in range(parts):
        staged.where(F.col("_part") == p).select(*rows.columns).repartition(FILES).write.mode("append").parquet(f"{base}/in")
    if sentinel is not None:
        sentinel.select(*rows.columns).coalesce(1).write.mode("append").parquet(f"{base}/in")
    return job(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES).parquet(f"{base}/in"))


def _events(spark, d, *columns):
    events = src.table(spark, d, "events")
    return events.withColumn("ts", F.col("ts").cast("timestamp")).select(*columns)


@query("st_sample_stream", "SELECT event_id, event_id AS position, event_id // 256 AS batch FROM (SELECT row_number() OVER (ORDER BY event_id) - 1 AS event_id FROM events)")
def st_sample_stream(spark, d):
    folder = scratch(spark)
    out = _feed(spark, _events(spark, d, "event_id"), "event_id", lambda stream: samples.sample_batches(stream, folder, 256, "event_id"))
    return out.select("event_id", "position", "batch")


@query(
    "st_bounded_queue",
    """WITH r AS (SELECT event_type AS queue, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS rk FROM events)
SELECT queue, count(*) AS produced, count(*) FILTER (WHERE rk > 100) AS dropped, count(*) FILTER (WHERE rk <= 100) AS queued,
  min(event_id) FILTER (WHERE rk <= 100) AS oldest FROM r GROUP BY queue""",
)
def st_bounded_queue(spark, d):
    """The newest hundred samples per queue."""
    rows = _events(spark, d, F.col("event_type").alias("queue"), "event_id")
    folder = scratch(spark)
    queue, counters = _feed(spark, rows, "event_id", lambda stream: samples.bounded_queue(stream, folder, "queue", "event_id", 100))
    left = queue.groupBy("queue").agg(F.count(F.lit(1)).alias("queued"), F.min("event_id").alias("oldest"))
    return counters.join(left, "queue").select("queue", "produced", "dropped", "queued", "oldest")


@query(
    "st_staleness",
    """WITH v AS (SELECT event_id // 500 AS slot, max(event_id) // 400 AS current FROM events GROUP BY 1),
s AS (SELECT current, current - (event_id // 400 - event_id % 2) AS lag FROM events JOIN v ON event_id // 500 = slot)
SELECT current, count(*) AS samples, count(*) FILTER (WHERE lag >= 1) AS stale, max(lag) AS max_lag, count(*) >= 450 AS paused, greatest(count(*) - 450, 0) AS over_cap FROM s GROUP BY current""",
)
def st_staleness(spark, d):
    e = F.col("event_id")
    rows = _events(spark, d, "event_id", F.floor(e / 500).cast("bigint").alias("slot"), (F.floor(e / 400) - e % 2).cast("bigint").alias("version"))
    versions = rows.groupBy("slot").agg(F.floor(F.max("event_id") / 400).cast("bigint").alias("current"))
    folder = scratch(spark)
    table = _feed(spark, rows, "event_id", lambda stream: run_append(samples.staleness(stream, versions, "slot", "version", "current"), folder))
    return samples.staleness_summary(table, "current", samples.staleness_cap(100, 0.5, 3))


def _sentinel(rows, time: str):
    """One row far behind the last event; it closes the windows before it."""
    last = rows.agg(F.max_by(F.struct(*rows.columns), time).alias("r")).select("r.*")
    return last.withColumn(time, F.col(time) + F.expr("INTERVAL 90 DAYS"))


@query(
    "st_partial_span",
    "SELECT user_id, min(event_id // 700) AS min_version, max(event_id // 700) AS max_version, min(event_id // 700) <> max(event_id // 700) AS partial FROM events GROUP BY user_id",
)
def st_partial_span(spark, d):
    """A user's events are one trajectory; spans without news for 5 days leave the state."""
    rows = _events(spark, d, "event_id", "ts", "user_id", F.floor(F.col("event_id") / 700).cast("bigint").alias("version"))
    folder = scratch(spark)
    return _feed(spark, rows, "event_id", lambda stream: samples.version_span(stream, folder, "user_id", "version", "ts", "5 days"))


@query(
    "st_replay_gate",
    """WITH t AS (SELECT user_id * 1000 + event_id % 7 AS key, user_id AS step, event_id AS seq, CASE event_type WHEN 'view' THEN 'running' WHEN 'error' THEN 'failure' ELSE 'success' END AS status,
  (row_number() OVER (ORDER BY event_id) - 1) * 4 // count(*) OVER () AS part FROM events),
p AS (SELECT DISTINCT part FROM t),
l0 AS (SELECT key, step, arg_max(status, seq) AS status, max(seq) AS seq FROM t WHERE part = 0 GROUP BY key, step), o0 AS (SELECT * FROM l0 WHERE step IN (SELECT step FROM l0 WHERE status = 'running')),
l1 AS (SELECT key, step, arg_max(status, seq) AS status, max(seq) AS seq FROM (SELECT * FROM o0 UNION ALL SELECT key, step, status, seq FROM t WHERE part = 1) GROUP BY key, step), o1 AS (SELECT * FROM l1 WHERE step IN (SELECT step FROM l1 WHERE status = 'running')),
l2 AS (SELECT key, step, arg_max(status, seq) AS status, max(seq) AS seq FROM (SELECT * FROM o1 UNION ALL SELECT key, step, status, seq FROM t WHERE part = 2) GROUP BY key, step), o2 AS (SELECT * FROM l2 WHERE step IN (SELECT step FROM l2 WHERE status = 'running')),
l3 AS (SELECT key, step, arg_max(status, seq) AS status, max(seq) AS seq FROM (SELECT * FROM o2 UNION ALL SELECT key, step, status, seq FROM t WHERE part = 3) GROUP BY key, step),
a AS (SELECT 0 AS e, * FROM l0 UNION ALL SELECT 1, * FROM l1 UNION ALL SELECT 2, * FROM l2 UNION ALL SELECT 3, * FROM l3)
SELECT key, step, seq FROM a WHERE status = 'success' AND (e, step) NOT IN (SELECT e, step FROM a WHERE status = 'running')""",
)
def st_replay_gate(spark, d):
    status = F.when(F.col("event_type") == "view", "running").when(F.col("event_type") == "error", "failure").otherwise("success")
    rows = _events(spark, d, (F.col("user_id") * 1000 + F.col("event_id") % 7).alias("key"), F.col("user_id").alias("step"), status.alias("status"), F.col("event_id").alias("seq"))
    folder = scratch(spark)
    return _feed(spark, rows, "seq", lambda stream: samples.replay_gate(stream, folder, "key", "step", "seq")).select("key", "step", "seq")


@query("st_metric_window", METRIC_WINDOW_SQL.replace("event_id // 1000 AS win", "strftime(date_trunc('day', ts), '%Y-%m-%d') AS win"))
def st_metric_window(spark, d):
    rows = metric_rows(spark, d).drop("win").join(_events(spark, d, "event_id", "ts"), "event_id")
    folder = scratch(spark)

    def job(stream):
        stats = mt.window_stats(stream.withWatermark("ts", "1 hour"), [F.window("ts", "1 day")], step="event_id")
        return run_append(stats.withColumn("win", F.date_format("window.start", "yyyy-MM-dd")).drop("window"), folder)

    table = _feed(spark, rows, "event_id", job, sentinel=_sentinel(rows, "ts"))
    return rounded(mt.window_finish(table, ["win"], 8), "win", "key")


@query("st_trace_ingest", """WITH u AS (SELECT request_id, count(*) AS n_events FROM single GROUP BY request_id)
SELECT t.request_id, response_pos, emit_token_id, n_events FROM trace t JOIN u USING (request_id)""", ("trace",))
def st_trace_ingest(spark, d):
    """Every third event is delivered twice, the second time with a later time; the repeats are recognised by id."""
    log = src.event_log(spark, d).join(_events(spark, d, F.col("event_id").alias("event_no"), "ts"), "event_no")
    copies = F.when(F.col("event_no") % 3 == 0, 2).otherwise(1)
    sent = bt.repeat_var(log, copies).withColumn("ts", F.col("ts") + F.make_dt_interval(mins=F.col("copy").cast("int"))).drop("copy")
    folder = scratch(spark)

    def job(stream):
        kept, _ = samples.on_time(stream, f"{folder}/gate", "ts", "40 days")
        return run_append(samples.unique_events(kept, ["request_id", "event_no"], "ts", "40 days"), folder)

    table = _feed(spark, sent, "event_no", job)
    rows = handoff.expand_events(table).where("response_pos IS NOT NULL")
    users = _events(spark, d, "user_id").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    gens = users.select(F.col("user_id").cast("string").alias("request_id"), (F.col("n") % 60 + 10).cast("int").alias("gen_len"))
    counts = rows.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_events"))
    return handoff.trace_tokens(rows, gens).join(counts, "request_id").select("request_id", "response_pos", "emit_token_id", "n_events")


# --- user-defined surface ------------------------------------------------------------------------


@query(
    "ext_reward_fn",
    "SELECT gen_id, round(length(hash_text) % 10 / 10.0, 6)::DOUBLE + 0.0 AS score, CASE WHEN ends_with(hash_text, truth) THEN 1.0 ELSE 0.0 END::DOUBLE AS acc FROM generations",
    ("generations",),
)
def ext_reward_fn(spark, d):
    """A user's scorer, called on Arrow batches with fixed keyword arguments."""
    def scorer(data_source, solution, truth, extra, base=10):
        return {"score": len(solution) % base / 10.0, "acc": float(solution.endswith(truth))}

    fn = registry.reward_function(scorer, base=10)
    rows = src.generations(spark, d).select("gen_id", "data_source", "hash_text", "truth", F.lit("{}").alias("extra"))
    out = rows.select("gen_id", fn("data_source", "hash_text", "truth", "extra").alias("r"))
    return out.select("gen_id", r6("r.score").alias("score"), "r.acc")


@query("ext_explode", "SELECT request_id, event_no, in_event, pos AS response_pos FROM single", ("trace",))
def ext_explode(spark, d):
    """One event to many rows through a user-defined table function."""
    log = src.event_log(spark, d).where("request_id <> '' AND (response_pos IS NOT NULL OR positions IS NOT NULL)")
    single = F.when(F.col("positions").isNotNull(), F.col("positions")).otherwise(F.array("response_pos"))
    fn = registry.explode_function()
    spark.udtf.register("explode_positions", fn)
    view = f"event_log_{uuid.uuid4().hex}"
    log.select("request_id", "event_no", single.alias("positions")).createOrReplaceTempView(view)
    return spark.sql(f"SELECT request_id, event_no, x.in_event, x.response_pos FROM {view}, LATERAL explode_positions(positions) x")


@query(
    "ext_registry",
    """WITH g AS (SELECT *, CASE WHEN count(*) OVER w = 1 THEN 0.0 ELSE avg(score) OVER w END AS mu, count(*) OVER w AS n FROM rollouts WINDOW w AS (PARTITION BY step, uid))
SELECT uid, line, problem_id, 'rloo' AS rule, round(CASE WHEN n > 1 THEN (score - mu) * n / (n - 1) ELSE score END, 6) + 0.0 AS advantage FROM g
UNION ALL SELECT uid, line, problem_id, 'centred', round(score - mu, 6) + 0.0 FROM g""",
    ("rollouts",),
)
def ext_registry(spark, d):
    """Advantage rules looked up by name, one of them registered by the user."""
    from trajtable.operators import advantage as adv

    rules = registry.Registry("advantage", registry.ADVANTAGES)
    rules.register("centred", lambda df: adv.grpo(df, by_std=False))
    parts = [rules.get(n)(src.rollouts(spark, d)).withColumn("rule", F.lit(n)) for n in ("rloo", "centred")]
    both = parts[0].unionByName(parts[1])
    return both.select("uid", "line", "problem_id", "rule", r6("advantage").alias("advantage"))
