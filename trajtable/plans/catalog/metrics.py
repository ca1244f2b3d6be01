"""Metric and validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajtable.operators import metrics as mt
from trajtable.operators import validation as va
from trajtable.plans.catalog.base import query, r6
from trajtable.plans.catalog.corrections import _cells, rounded
from trajtable.sources import tables as src

T, G = ("tokens",), ("rollouts",)


# --- derived metric inputs -----------------------------------------------------------------------

# fixed values: metric names given to the events in turn
NAMES = (
    "perf/time_per_step", "perf/total_num_tokens", "perf/throughput", "timing_s/gen", "timing_s/step",
    "global_seqlen/max", "global_seqlen/min", "global_seqlen/minmax_diff", "training/global_step",
    "actor/loss_weighted_avg", "actor/lr", "critic/score/sum",
)
METRIC_SQL = f"""m AS (SELECT event_id // 1000 AS win, event_id // 100 AS step, event_id, value,
  ({list(NAMES)!r})[(event_id % 12 + 1)::INT] AS key FROM events)"""


def metric_rows(spark, d):
    ev = src.table(spark, d, "events").select("event_id", "value")
    names = F.array(*map(F.lit, NAMES))
    return ev.select(
        F.floor(F.col("event_id") / 1000).cast("bigint").alias("win"),
        F.floor(F.col("event_id") / 100).cast("bigint").alias("step"),
        "event_id", "value", F.element_at(names, (F.col("event_id") % 12 + 1).cast("int")).alias("key"),
    )


@query(
    "metric_reduce",
    f"""WITH {METRIC_SQL} SELECT step, key, round(CASE WHEN key LIKE '%max%' THEN max(value) WHEN key LIKE '%min%' THEN min(value)
  WHEN key = 'critic/score/sum' THEN sum(value) ELSE avg(value) END, 6) + 0.0 AS value FROM m GROUP BY step, key""",
)
def metric_reduce(spark, d):
    rows = metric_rows(spark, d).withColumn("declared", F.when(F.col("key") == "critic/score/sum", "sum"))
    return rounded(mt.metric_reduce(rows, ["step"], declared="declared"), "step", "key")


@query(
    "metric_dp",
    """WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings),
k AS (SELECT vec_id AS key, (['sum', 'mean', 'min', 'max'])[(vec_id % 4 + 1)::INT] AS rule, p // 16 AS rank, p % 16 AS i, v FROM e),
s AS (SELECT key, rule, i, avg(v) AS m, min(v) AS lo, max(v) AS hi FROM k GROUP BY key, rule, i)
SELECT key, rule, round(CASE rule WHEN 'sum' THEN sum(m) WHEN 'mean' THEN avg(m) WHEN 'min' THEN min(lo) ELSE max(hi) END, 6) + 0.0 AS value
FROM s GROUP BY key, rule""",
)
def metric_dp(spark, d):
    emb = src.table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "v"))
    rules = F.array(*map(F.lit, ("sum", "mean", "min", "max")))
    rows = emb.select(
        F.col("vec_id").alias("key"), F.element_at(rules, (F.col("vec_id") % 4 + 1).cast("int")).alias("rule"),
        F.floor(F.col("p") / 16).alias("rank"), (F.col("p") % 16).alias("i"), F.col("v").cast("double").alias("value"),
    )
    return rounded(mt.metric_dp(rows), "key", "rule")


_RULE = """CASE WHEN key = 'perf/time_per_step' THEN 'sum' WHEN key = 'training/global_step' THEN 'last'
  WHEN key LIKE '%timing_s/%' THEN 'sum' WHEN key LIKE '%mean%' OR key LIKE '%avg%' THEN 'avg' WHEN key LIKE '%max%' THEN 'max'
  WHEN key LIKE '%min%' THEN 'min' WHEN key LIKE '%sum%' OR key LIKE '%total%' THEN 'sum' ELSE 'avg' END"""
METRIC_WINDOW_SQL = f"""WITH {METRIC_SQL}, r AS (SELECT *, {_RULE} AS rule FROM m),
a AS (SELECT win, key, CASE rule WHEN 'sum' THEN sum(value) WHEN 'max' THEN max(value) WHEN 'min' THEN min(value)
  WHEN 'last' THEN arg_max(value, event_id) ELSE avg(value) END AS value FROM r GROUP BY win, key, rule),
p AS (PIVOT a ON key IN ({", ".join(repr(n) for n in NAMES)}) USING max(value) GROUP BY win),
x AS (SELECT win, key, value FROM a WHERE key NOT IN ('global_seqlen/minmax_diff', 'perf/throughput') UNION ALL
  SELECT win, 'global_seqlen/minmax_diff', "global_seqlen/max" - "global_seqlen/min" FROM p UNION ALL
  SELECT win, 'perf/throughput', "perf/total_num_tokens" / ("perf/time_per_step" * 8) FROM p UNION ALL
  SELECT win, 'fully_async/trainer/idle_ratio', "timing_s/gen" / "timing_s/step" FROM p)
SELECT win, key, round(value, 6) + 0.0 AS value FROM x"""


@query("metric_window", METRIC_WINDOW_SQL)
def metric_window(spark, d):
    return rounded(mt.metric_window(metric_rows(spark, d), ["win"], 8, step="event_id"), "win", "key")


@query(
    "async_batch_stats",
    """WITH b AS (SELECT l_orderkey // 1000 AS step, l_extendedprice / 1000 AS secs, l_quantity AS calls, l_linenumber AS v0,
  l_linenumber + CASE WHEN l_partkey % 3 = 0 THEN l_suppkey % 4 ELSE 0 END AS v1 FROM lineitem)
SELECT step, """
    + _cells({
        "processing_time_mean": "avg(secs)", "processing_time_max": "max(secs)", "processing_time_min": "min(secs)",
        "tool_calls_mean": "avg(calls)", "tool_calls_max": "max(calls)", "tool_calls_min": "min(calls)",
        "partial_ratio": "avg(CASE WHEN v1 <> v0 THEN 1.0 ELSE 0.0 END)", "tp50": "quantile_cont(secs, 0.5)",
        "tp95": "quantile_cont(secs, 0.95)", "tp99": "quantile_cont(secs, 0.99)",
    })
    + """, count(*) FILTER (WHERE v1 <> v0) AS partial_num, max(abs(v1 - v0))::BIGINT AS max_partial_span,
  count(DISTINCT v1) AS version_diversity FROM b GROUP BY step""",
)
def async_batch_stats(spark, d):
    li = src.table(spark, d, "lineitem").select(
        F.floor(F.col("l_orderkey") / 1000).cast("bigint").alias("step"), (F.col("l_extendedprice") / 1000).alias("secs"),
        F.col("l_quantity").alias("calls"), F.col("l_linenumber").cast("bigint").alias("v0"),
        (F.col("l_linenumber") + F.when(F.col("l_partkey") % 3 == 0, F.col("l_suppkey") % 4).otherwise(0)).cast("bigint").alias("v1"),
    )
    out = mt.async_batch_stats(li, ["step"], "secs", "calls", "v0", "v1")
    return rounded(out, "step", "partial_num", "max_partial_span", "version_diversity")


# --- per-step training metrics -------------------------------------------------------------------


@query(
    "data_metrics",
    """WITH r AS (SELECT step, uid, seq_id, sum(mask) AS len, sum(reward) AS score, sum(reward - 0.01 * (old_lp - ref_lp)) AS rew,
  (uid % 7 + 5) AS prompt_len, count(*) FILTER (WHERE event_type = 'signup') AS turns, count(*) FILTER (WHERE event_type = 'click') AS calls
  FROM tokens GROUP BY step, uid, seq_id),
t AS (SELECT step, """
    + _cells({
        **{f"{n}_{k}": f"{k.replace('mean', 'avg')}({c}) FILTER (WHERE mask > 0)" for n, c in (("advantages", "adv"), ("returns", "value + adv / 2"), ("values", "value")) for k in ("mean", "max", "min")},
        "explained_var": "1 - (var_samp(adv / 2) FILTER (WHERE mask > 0)) / ((var_samp(value + adv / 2) FILTER (WHERE mask > 0)) + 1e-5)",
    })
    + """ FROM tokens GROUP BY step)
SELECT * FROM t JOIN (SELECT step, """
    + _cells({
        **{f"{n}_{k}": f"{k.replace('mean', 'avg')}({c})" for n, c in (("response_length", "len"), ("prompt_length", "prompt_len"), ("num_turns", "turns"), ("tool_calls", "calls")) for k in ("mean", "max", "min")},
        **{f"{n}_{k}": f"{k.replace('mean', 'avg')}({c}) FILTER (WHERE len > 0)" for n, c in (("score", "score"), ("reward", "rew"), ("response_length_alive", "len")) for k in ("mean", "max", "min")},
        "response_length_clip_ratio": "avg(CASE WHEN len = 50 THEN 1.0 ELSE 0.0 END)",
        "response_length_alive_clip_ratio": "avg(CASE WHEN len = 50 THEN 1.0 ELSE 0.0 END) FILTER (WHERE len > 0)",
        "aborted_ratio": "avg(CASE WHEN len = 0 THEN 1.0 ELSE 0.0 END)",
        "prompt_length_clip_ratio": "avg(CASE WHEN prompt_len = 11 THEN 1.0 ELSE 0.0 END)",
    })
    + " FROM r GROUP BY step) USING (step)",
    T,
)
def data_metrics(spark, d):
    tok = src.tokens(spark, d).withColumns({
        "score": F.col("reward"), "reward": F.col("reward") - 0.01 * (F.col("old_lp") - F.col("ref_lp")),
        "returns": F.col("value") + F.col("adv") / 2,
    })
    keys = ["step", "uid", "seq_id"]
    rows = mt.response_rows(tok, keys)
    count = lambda kind: F.count(F.when(F.col("event_type") == kind, 1))
    extra = tok.groupBy(*keys).agg(count("signup").alias("num_turns"), count("click").alias("tool_calls"))
    rows = rows.join(extra, keys).withColumn("prompt_len", F.col("uid") % 7 + 5)
    return rounded(mt.data_metrics(rows, 11, 50), "step")


@query(
    "filter_aborted",
    """WITH r AS (SELECT step, score, CASE WHEN resp_len <= 3 THEN 0 ELSE resp_len END AS len FROM rollouts)
SELECT step, count(*) FILTER (WHERE len > 0) AS alive, round(avg(score) FILTER (WHERE len > 0), 6) + 0.0 AS score_mean,
  round(max(score) FILTER (WHERE len > 0), 6) + 0.0 AS score_max, round(avg(CASE WHEN len = 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS aborted
FROM r GROUP BY step""",
    G,
)
def filter_aborted(spark, d):
    """Responses of three tokens or fewer play the aborted ones (length 0)."""
    alive = F.col("resp_len") > 3
    return src.rollouts(spark, d).groupBy("step").agg(
        F.count(F.when(alive, 1)).alias("alive"), r6(F.avg(F.when(alive, F.col("score")))).alias("score_mean"),
        r6(F.max(F.when(alive, F.col("score")))).alias("score_max"), r6(F.avg((~alive).cast("double"))).alias("aborted"),
    )


@query(
    "filter_padding_samples",
    """WITH r AS (SELECT step, score, line > 2 OR step % 5 = 4 AS pad FROM rollouts),
a AS (SELECT step, bool_and(pad) AS all_pad FROM r GROUP BY step)
SELECT step, count(*) AS used, round(avg(score), 6) + 0.0 AS score_mean FROM r JOIN a USING (step) WHERE NOT pad OR all_pad GROUP BY step""",
    G,
)
def filter_padding_samples(spark, d):
    from trajtable.operators.prep import drop_padding

    rows = src.rollouts(spark, d).withColumn("pad", (F.col("line") > 2) | (F.col("step") % 5 == 4))
    return drop_padding(rows, "pad", ["step"]).groupBy("step").agg(
        F.count(F.lit(1)).alias("used"), r6(F.avg("score")).alias("score_mean")
    )


# fixed values: stage names that the timing table cycles through
STAGES = ("gen", "ref", "values", "adv", "update_actor", "step", "testing")
TIMING_SQL = f"""s AS (SELECT step, sum(resp_len) AS resp, sum(resp_len + prompt_len) AS total FROM rollouts GROUP BY step),
g AS (SELECT step, ({list(STAGES)!r})[(line - 1) % 7 + 1] AS name, sum(score) AS seconds FROM rollouts GROUP BY ALL)"""


def _timing(rows):
    names = F.array(*map(F.lit, STAGES))
    stage = F.element_at(names, ((F.col("line") - 1) % 7 + 1).cast("int"))
    return rows.groupBy("step", stage.alias("name")).agg(F.sum("score").alias("seconds"))


@query(
    "timing_metrics",
    f"""WITH {TIMING_SQL} SELECT step, name, round(seconds, 6) + 0.0 AS timing_s, round(CASE WHEN name = 'gen' THEN seconds * 1000 / resp
  WHEN name IN ('ref', 'values', 'adv', 'update_critic', 'update_actor') THEN seconds * 1000 / total END, 6) + 0.0 AS timing_per_token_ms
FROM g JOIN s USING (step)""",
    G,
)
def timing_metrics(spark, d):
    rows = src.rollouts(spark, d)
    return rounded(mt.timing_metrics(rows, _timing(rows)), "step", "name")


@query(
    "throughput_metrics",
    f"""WITH {TIMING_SQL} SELECT step, total::BIGINT AS total_num_tokens, round(seconds, 6) + 0.0 AS time_per_step,
  round(total / (seconds * 8), 6) + 0.0 AS throughput FROM g JOIN s USING (step) WHERE name = 'step'""",
    G,
)
def throughput_metrics(spark, d):
    rows = src.rollouts(spark, d)
    return rounded(mt.throughput(rows, _timing(rows), 8), "step", "total_num_tokens")


@query(
    "variance_proxy",
    """WITH k AS (SELECT *, 1 - 2 * exp(old_lp) + sum_pi2 AS w, least(exp(old_lp - rollout_lp) * mask, 1.5) AS rho FROM tokens),
r AS (SELECT step, seq_id, sum(adv * mask) / (sum(mask) + 1e-8) AS a, sum(w * rho * rho * mask) AS w, sum(w * mask) AS w0,
  sum(rho * mask) / (sum(mask) + 1e-8) AS rho FROM k GROUP BY step, seq_id)
SELECT step, """
    + _cells({
        "signal_strength": "max(0.25::DOUBLE)", "total_power": "avg(rho * rho * a * a * greatest(w0, 0))",
        "pure_noise": "greatest((avg(rho * rho * a * a * greatest(w0, 0)) - 0.25) / (count(*) - 1), 0)",
        "expected_a_squared": "avg(a * a)", "expected_w": "avg(w)",
    })
    + " FROM r GROUP BY step",
    T,
)
def variance_proxy(spark, d):
    from trajtable.operators.correction import is_weights

    rows = is_weights(src.tokens(spark, d), "token", 1.5)
    return rounded(mt.variance_proxy(rows, "is_weight", 0.5), "step")


@query(
    "kl_logprob_debug",
    "SELECT step, 1 AS valid, "
    + _cells({
        "diff_max": "max(abs(exp(old_lp) - exp(rollout_lp))) FILTER (WHERE mask > 0)", "diff_mean": "avg(abs(exp(old_lp) - exp(rollout_lp))) FILTER (WHERE mask > 0)",
        "diff_std": "stddev_samp(abs(exp(old_lp) - exp(rollout_lp))) FILTER (WHERE mask > 0)",
        "pearson": "corr(exp(old_lp), exp(rollout_lp)) FILTER (WHERE mask > 0)",
    })
    + " FROM tokens GROUP BY step",
    T,
)
def kl_logprob_debug(spark, d):
    return rounded(mt.logprob_debug(src.tokens(spark, d)), "step", "valid")


@query(
    "token_diff_count",
    "SELECT seq_id, count(*) FILTER (WHERE mask = 1 AND tok <> (tok * 3 + t) % 100) AS diff FROM tokens GROUP BY seq_id",
    T,
)
def token_diff_count(spark, d):
    other = (F.col("tok") * 3 + F.col("t")) % 100
    return mt.token_diff_rows(src.tokens(spark, d), F.col("tok"), other, F.col("mask"), ["seq_id"])


@query(
    "spec_decode_metrics",
    """SELECT step, round(avg(CASE WHEN resp_len - 1 > 0 THEN line * 1.0 / (resp_len - 1) ELSE 0 END), 6) + 0.0 AS accept_rate,
  round(avg(CASE WHEN worker % 5 > 0 THEN 1.0 + line / (worker % 5)::DOUBLE ELSE 0 END), 6) + 0.0 AS accept_length
FROM rollouts WHERE NOT pred = 'RF' GROUP BY step""",
    G,
)
def spec_decode_metrics(spark, d):
    rows = src.rollouts(spark, d).select(
        "step", (F.col("resp_len") - 1).alias("drafted"), F.col("line").alias("accepted"),
        (F.col("worker") % 5).alias("verified"), (F.col("pred") == "RF").alias("padding"),
    )
    return rounded(mt.spec_decode(rows, padding="padding"), "step")


@query(
    "trigger_stop_metrics",
    """WITH r AS (SELECT *, (['yes', 'no', 'TRUE', '0', 'on', 'x', 'Y'])[line::INT] IN ('yes', 'TRUE', 'on', 'Y') AS flag FROM rollouts)
SELECT step, count(*) FILTER (WHERE flag) AS n, """
    + _cells({
        "ratio": "avg(CASE WHEN flag THEN 1.0 ELSE 0.0 END)", "length_mean": "avg(resp_len) FILTER (WHERE flag)",
        "pos_mean": "avg(resp_len // 2) FILTER (WHERE flag AND worker % 3 > 0)",
    })
    + """, max(resp_len) FILTER (WHERE flag) AS length_max, min(resp_len) FILTER (WHERE flag) AS length_min,
  (max(resp_len // 2) FILTER (WHERE flag AND worker % 3 > 0))::INT AS pos_max FROM r GROUP BY step""",
    G,
)
def trigger_stop_metrics(spark, d):
    words = F.array(*map(F.lit, ("yes", "no", "TRUE", "0", "on", "x", "Y")))
    rows = src.rollouts(spark, d).select(
        "step", "resp_len", F.get(words, F.col("line") - 1).alias("stopped"),
        F.when(F.col("worker") % 3 > 0, F.floor(F.col("resp_len") / 2).cast("string")).otherwise("none").alias("stop_pos"),
    )
    out = mt.trigger_stop_metrics(rows)
    return rounded(out, "step", "n", "length_max", "length_min", "pos_max")


@query(
    "relay_mask_metrics",
    """WITH r AS (SELECT step, seq_id, sum(mask) AS n, count(*) FILTER (WHERE mask > 0 AND tok % 23 = 0) AS k FROM tokens GROUP BY step, seq_id)
SELECT step, """
    + _cells({"token_ratio": "sum(k) / greatest(sum(n), 1)", "seq_ratio": "avg(k / greatest(n, 1))", "seq_any": "avg(CASE WHEN k > 0 THEN 1.0 ELSE 0.0 END)"})
    + " FROM r GROUP BY step",
    T,
)
def teacher_mask_metrics(spark, d):
    rows = src.tokens(spark, d).withColumn("teacher_mask", (F.col("tok") % 23 == 0).cast("int"))
    return rounded(mt.teacher_mask_metrics(rows), "step")


@query(
    "source_token_stats",
    """SELECT uid, count(*) FILTER (WHERE tok % 5 > 0) AS student_tokens, count(*) FILTER (WHERE tok % 5 = 0) AS teacher_tokens,
  count(*) AS emitted_tokens, count(*) FILTER (WHERE tok % 7 > 2) AS drafted_tokens, count(*) FILTER (WHERE tok % 7 > 4) AS accepted_tokens,
  round(count(*) FILTER (WHERE tok % 5 = 0) / count(*), 6) + 0.0 AS teacher_ratio FROM tokens GROUP BY uid""",
    T,
)
def source_token_stats(spark, d):
    rows = src.tokens(spark, d).withColumns({
        "source": F.when(F.col("tok") % 5 == 0, "teacher").otherwise("student"),
        "drafted": (F.col("tok") % 7 > 2).cast("int"), "accepted": (F.col("tok") % 7 > 4).cast("int"),
    })
    out = mt.source_token_stats(rows, ["uid"])
    return out.withColumn("teacher_ratio", r6("teacher_ratio"))


@query(
    "merge_summary",
    """SELECT count(*) AS n_rows, round(avg(resp_len), 6) + 0.0 AS mean_gen_tokens, max(resp_len) AS max_gen_tokens,
  round(avg(CASE WHEN pred LIKE '%F' THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS eos_rate FROM rollouts""",
    G,
)
def merge_summary(spark, d):
    return src.rollouts(spark, d).agg(
        F.count(F.lit(1)).alias("n_rows"), r6(F.avg("resp_len")).alias("mean_gen_tokens"), F.max("resp_len").alias("max_gen_tokens"),
        r6(F.avg(F.col("pred").endswith("F").cast("double"))).alias("eos_rate"),
    )


@query(
    "case_score",
    """SELECT uid, round(coalesce(avg(acc) FILTER (WHERE sample_idx < 10), 0), 6) + 0.0 AS score,
  round(coalesce(avg(acc) FILTER (WHERE sample_idx < 10), 0), 6) + 0.0 AS pass_rate, min(acc) AS strict FROM rollouts GROUP BY uid""",
    G,
)
def case_score(spark, d):
    rows = src.rollouts(spark, d, index=True).withColumn("passed", F.col("acc") > 0)
    part = mt.case_score(rows, ["uid"], "passed", "sample_idx", continuous=True)
    strict = mt.case_score(rows, ["uid"], "passed", "sample_idx").select("uid", F.col("score").alias("strict"))
    return rounded(part.join(strict, "uid"), "uid")


@query(
    "gdpo_component_stats",
    "SELECT step, " + _cells({f"{c}_{k}": f"{f}({c})" for c in ("score", "score2") for k, f in (("mean", "avg"), ("std", "stddev_pop"), ("max", "max"), ("min", "min"))}) + " FROM rollouts GROUP BY step",
    G,
)
def gdpo_component_stats(spark, d):
    return rounded(mt.component_stats(src.rollouts(spark, d), ["score", "score2"]), "step")


@query(
    "group_factorise",
    """WITH l AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 's:' || lpad((event_id % 70)::VARCHAR, 4, '0')
  WHEN event_id % 3 = 1 THEN 'n:' || (event_id % 70)::VARCHAR ELSE 's:' || (event_id % 70)::VARCHAR END AS label FROM events)
SELECT event_id, dense_rank() OVER (ORDER BY label) - 1 AS group_id FROM l""",
)
def group_factorise(spark, d):
    e = F.col("event_id")
    small = (e % 70).cast("string")
    rows = src.table(spark, d, "events").select(
        e, F.when(e % 3 == 0, F.lpad(small, 4, "0")).when(e % 3 == 1, F.concat(small, F.lit(".0000001"))).otherwise(small).alias("label"),
        F.when(e % 3 == 1, "n").otherwise("s").alias("kind"),
    )
    return mt.label_ids(rows, "label", "kind").select("event_id", "group_id")


# --- benchmarks and validation -------------------------------------------------------------------

BENCH = """per AS (SELECT data_source, uid, avg(acc) AS a, arg_min(acc, sample_idx) AS f, max(acc) AS m, count(*) AS n FROM rollouts GROUP BY data_source, uid)"""


@query(
    "bench_summary",
    f"""WITH {BENCH} SELECT data_source, count(*) AS n_problems, max(n) AS n_samples, round(avg(a), 6) + 0.0 AS avg_at_k,
  round(avg(f), 6) + 0.0 AS pass_at_1, round(avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS pass_at_k FROM per GROUP BY data_source""",
    G,
)
def bench_summary(spark, d):
    rows = src.rollouts(spark, d, source=True, index=True)
    return rounded(va.bench_summary(rows, ["data_source"], "uid", "acc", "sample_idx"), "data_source", "n_problems", "n_samples")


@query(
    "bench_pool",
    """WITH per AS (SELECT data_source, uid % 4 AS shard, uid, avg(acc) AS a, arg_min(acc, sample_idx) AS f, max(acc) AS m, sum(score) AS w FROM rollouts GROUP BY data_source, uid),
s AS (SELECT data_source, shard, count(*) AS n, avg(a) AS a, avg(f) AS f, avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END) AS p, sum(w) AS wall FROM per GROUP BY data_source, shard)
SELECT data_source, sum(n)::BIGINT AS n_problems, round(sum(a * n) / sum(n), 6) + 0.0 AS avg_at_k, round(sum(f * n) / sum(n), 6) + 0.0 AS pass_at_1,
  round(sum(p * n) / sum(n), 6) + 0.0 AS pass_at_k, round(max(wall), 6) + 0.0 AS wall_seconds FROM s GROUP BY data_source""",
    G,
)
def bench_pool(spark, d):
    rows = src.rollouts(spark, d, source=True, index=True).withColumn("shard", F.col("uid") % 4)
    shards = va.bench_summary(rows, ["data_source", "shard"], "uid", "acc", "sample_idx")
    wall = rows.groupBy("data_source", "shard").agg(F.sum("score").alias("wall_seconds"))
    return rounded(va.bench_pool(shards.join(wall, ["data_source", "shard"]), ["data_source"]), "data_source", "n_problems")


STATUS_SQL = """s AS (SELECT step, data_source AS bench, CASE WHEN uid % 4 = 3 AND step % 2 = 0 THEN NULL ELSE uid % 4 END AS shard,
    avg(acc) AS a, count(DISTINCT uid) AS n, sum(resp_len) AS bytes FROM rollouts GROUP BY ALL),
h AS (SELECT *, CASE WHEN shard IS NOT NULL AND (step + shard) % 6 = 0 THEN NULL ELSE a END AS v,
    CASE WHEN step % 4 = 2 THEN 0 ELSE bytes END AS logged FROM s),
st AS (SELECT step, bench, coalesce(bool_or(shard IS NULL AND v IS NOT NULL), false) OR (coalesce(bool_or(shard IS NOT NULL AND v IS NOT NULL), false)
    AND NOT coalesce(bool_or(shard IS NOT NULL AND v IS NULL AND logged > 0), false)) AS done,
  sum(v * greatest(n, 1)) / sum(greatest(n, 1)) FILTER (WHERE v IS NOT NULL) AS avg_at_k FROM h GROUP BY step, bench)"""


def _status(spark, d):
    rows = src.rollouts(spark, d, source=True)
    part = F.when((F.col("uid") % 4 == 3) & (F.col("step") % 2 == 0), None).otherwise(F.col("uid") % 4)
    per = rows.withColumn("shard", part).groupBy("step", F.col("data_source").alias("bench"), "shard", "uid").agg(
        F.sum("acc").alias("a"), F.count(F.lit(1)).alias("k"), F.sum("resp_len").alias("b")
    )
    shards = per.groupBy("step", "bench", "shard").agg(
        (F.sum("a") / F.sum("k")).alias("avg_at_k"), F.count(F.lit(1)).alias("n_problems"), F.sum("b").alias("log_bytes")
    )
    lost = F.col("shard").isNotNull() & ((F.col("step") + F.col("shard")) % 6 == 0)
    shards = shards.withColumn("avg_at_k", F.when(~lost, F.col("avg_at_k"))).withColumn(
        "log_bytes", F.when(F.col("step") % 4 == 2, 0).otherwise(F.col("log_bytes"))
    )
    return va.bench_status(shards, ["step", "bench"])


@query("bench_status", f"WITH {STATUS_SQL} SELECT step, bench, done, round(avg_at_k, 6) + 0.0 AS avg_at_k FROM st", G)
def bench_status(spark, d):
    return rounded(_status(spark, d), "step", "bench", "done")


@query(
    "best_step",
    f"""WITH {STATUS_SQL}, r AS (SELECT step, count(*) AS k, 100 * sum(avg_at_k) / 4 AS a FROM st
  WHERE done AND bench IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') GROUP BY step HAVING count(*) = 4)
SELECT 'run' AS run, (SELECT step FROM r ORDER BY a DESC, step LIMIT 1) AS peak_step, round(max(a), 6) + 0.0 AS peak_avg, count(*) AS steps_done FROM r""",
    G,
)
def best_step(spark, d):
    out = va.best_step(_status(spark, d).withColumn("run", F.lit("run")), ["run"], ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"])
    return rounded(out, "run", "peak_step", "steps_done")


@query("score_by_source", "SELECT data_source, round(avg(m), 6) + 0.0 AS score FROM (SELECT data_source, uid, avg(score) AS m FROM rollouts GROUP BY data_source, uid) GROUP BY data_source", G)
def score_by_source(spark, d):
    rows = src.rollouts(spark, d, source=True).groupBy("data_source", "uid").agg(F.avg("score").alias("m"))
    return rows.groupBy("data_source").agg(r6(F.avg("m")).alias("score"))


@query(
    "val_majority",
    """WITH v AS (SELECT uid, pred, count(*) AS n, min(sample_idx) AS f, arg_min(score, sample_idx) AS s FROM rollouts GROUP BY uid, pred),
r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY n DESC, f) AS rk, sum(n) OVER (PARTITION BY uid) AS total FROM v)
SELECT uid, pred AS majority, round(s, 6) + 0.0 AS value, n AS votes, round(n / total, 6) + 0.0 AS agreement FROM r WHERE rk = 1""",
    G,
)
def val_majority(spark, d):
    out = va.majority(src.rollouts(spark, d, index=True), ["uid"], "pred", "score", "sample_idx")
    return rounded(out, "uid", "majority", "votes")


POINT = """p AS (SELECT data_source, uid, count(*) AS n, avg(score) AS sm, stddev_pop(score) AS ss, avg(acc) AS am, stddev_pop(acc) AS asd FROM rollouts GROUP BY data_source, uid),
l AS (SELECT data_source, uid, 'score' AS variable, 'mean@' || n AS metric, sm AS value FROM p UNION ALL
  SELECT data_source, uid, 'score', 'std@' || n, ss FROM p WHERE n > 1 UNION ALL
  SELECT data_source, uid, 'acc', 'mean@' || n, am FROM p UNION ALL SELECT data_source, uid, 'acc', 'std@' || n, asd FROM p WHERE n > 1),
m AS (SELECT data_source, variable, metric, avg(value) AS value FROM l GROUP BY data_source, variable, metric)"""


@query("val_mean_std", f"WITH {POINT} SELECT data_source, variable, metric, round(value, 6) + 0.0 AS value FROM m", G)
def val_mean_std(spark, d):
    rows = va.point_metrics(src.rollouts(spark, d, source=True), ["score", "acc"])
    out = rows.groupBy("data_source", "variable", "metric").agg(F.avg("value").alias("value"))
    return rounded(out, "data_source", "variable", "metric")


@query(
    "val_sections",
    f"""WITH {POINT}, x AS (SELECT *, max(split_part(metric, '@', 2)::INT) OVER (PARTITION BY data_source, variable) AS n_max FROM m)
SELECT CASE WHEN variable = 'acc' AND metric LIKE 'mean%' AND metric LIKE '%@' || n_max || '%' THEN 'val-core/' ELSE 'val-aux/' END
  || data_source || '/' || variable || '/' || metric AS key, round(value, 6) + 0.0 AS value FROM x
UNION ALL SELECT 'val-aux/num_turns/min', min(line)::DOUBLE FROM rollouts UNION ALL SELECT 'val-aux/num_turns/max', max(line)::DOUBLE FROM rollouts
UNION ALL SELECT 'val-aux/num_turns/mean', round(avg(line), 6) + 0.0 FROM rollouts""",
    G,
)
def val_sections(spark, d):
    rows = src.rollouts(spark, d, source=True)
    per = va.point_metrics(rows, ["score", "acc"]).groupBy("data_source", "variable", "metric").agg(F.avg("value").alias("value"))
    return rounded(va.val_sections(per).unionByName(va.turn_stats(rows, "line")), "key")


SIZES = "list_filter([2, 4, 8, 16, 32, 64, 128, 256, 512, 1024], lambda x: x < n) || [n]"
DRAWN = "(floor(('0x' || substr(md5('42:' || n || ':' || size || ':' || k), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE * n) + 1)::BIGINT"


def _bootstrap_sql() -> str:
    """Best and worst from ranks, the majority from the same draws, for score and acc."""
    moments = lambda kind, v, one, two, source: (
        f"SELECT data_source, uid, '{v}' AS variable, '{kind}@' || size || '/mean' AS metric, {one} AS value FROM {source} UNION ALL "
        f"SELECT data_source, uid, '{v}', '{kind}@' || size || '/std', sqrt(greatest({two} - {one} * {one}, 0)) FROM {source}"
    )
    ctes = ["s AS (SELECT *, sample_idx + 1 AS i, count(*) OVER (PARTITION BY data_source, uid) AS n FROM rollouts)", f"z AS (SELECT *, unnest({SIZES}) AS size FROM s WHERE n > 1)"]
    out = []
    for v in ("score", "acc"):
        ctes.append(f"r_{v} AS (SELECT *, row_number() OVER (PARTITION BY data_source, uid, size ORDER BY {v}, i)::DOUBLE AS r, {v} AS x FROM z)")
        best, worst = "(pow(r / n, size) - pow((r - 1) / n, size))", "(pow((n - r + 1) / n, size) - pow((n - r) / n, size))"
        ctes.append(f"e_{v} AS (SELECT data_source, uid, size, sum({best} * x) AS b1, sum({best} * x * x) AS b2, sum({worst} * x) AS w1, sum({worst} * x * x) AS w2 FROM r_{v} GROUP BY ALL)")
        out += [moments("best", v, "b1", "b2", f"e_{v}"), moments("worst", v, "w1", "w2", f"e_{v}"), moments("maj", v, f"{v}_1", f"{v}_2", "mm")]
    cdf = "list_transform(range(0, m), lambda k: list_sum(list_transform(range(0, k + 1), lambda j: exp(lgamma(m + 1) - lgamma(j + 1) - lgamma(m - j + 1) + j * ln(a / (a + b)::DOUBLE) + (m - j) * ln(b / (a + b)::DOUBLE)))))"
    ctes += [
        # answers by count, the most frequent first; prompts with equal counts share their draws
        "ac AS (SELECT data_source, uid, pred, count(*) AS c, avg(score) AS score_1, avg(score * score) AS score_2, avg(acc) AS acc_1, avg(acc * acc) AS acc_2 FROM s WHERE n > 1 GROUP BY ALL)",
        "bc AS (SELECT data_source, uid, c, count(*) AS answers, sum(score_1) AS score_1, sum(score_2) AS score_2, sum(acc_1) AS acc_1, sum(acc_2) AS acc_2 FROM ac GROUP BY ALL)",
        "sh AS (SELECT data_source, uid, string_agg(c || 'x' || answers, ',' ORDER BY c DESC) AS shape FROM bc GROUP BY ALL)",
        "one AS (SELECT shape, list(c ORDER BY c DESC) AS counts, sum(c)::BIGINT AS n FROM (SELECT shape, c FROM ac JOIN (SELECT shape, min(uid) AS uid FROM sh GROUP BY shape) USING (uid)) GROUP BY shape)",
        f"job AS (SELECT shape, counts, n, unnest({SIZES}) AS size FROM one)",
        "top_n AS (SELECT coalesce(max(n), 0) AS top FROM one)",
        f"cdf AS MATERIALIZED (SELECT m, a, b, {cdf} AS f FROM (SELECT unnest(range(1, top + 1)) AS m FROM top_n), (SELECT unnest(range(1, top + 1)) AS a FROM top_n), (SELECT unnest(range(1, top + 1)) AS b FROM top_n) WHERE a + b <= (SELECT top FROM top_n))",
        # one answer after the other: how often it is drawn, given the answers before it
        """walk AS (SELECT shape, counts, size, r, 1 AS i, size AS m_left, n AS w_left, []::BIGINT[] AS got FROM job, range(1000) AS rounds(r)
  UNION ALL SELECT shape, counts, size, r, i + 1, m_left - g, w_left - counts[i], got || [g] FROM (
    SELECT walk.*, CASE WHEN w_left = counts[i] OR m_left = 0 THEN m_left
      ELSE len(list_filter(f, lambda x: x < ('0x' || substr(md5('42:' || shape || ':' || size || ':' || r || ':' || (i - 1)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)) END AS g
    FROM walk LEFT JOIN cdf ON m = m_left AND a = counts[i] AND b = w_left - counts[i] WHERE i <= len(counts)))""",
        "won AS (SELECT shape, size, r, unnest(counts) AS c, unnest(got) AS g, list_max(got) AS top, len(list_filter(got, lambda x: x = list_max(got))) AS ties FROM walk WHERE i > len(counts))",
        "w AS (SELECT shape, size, c, sum(CASE WHEN g = top THEN 1.0::DOUBLE / ties ELSE 0 END) / 1000.0::DOUBLE AS share FROM won GROUP BY ALL)",
        # the share of all answers with a count, over the number of these answers
        "mm AS (SELECT data_source, uid, size, sum(share / answers * score_1) AS score_1, sum(share / answers * score_2) AS score_2, sum(share / answers * acc_1) AS acc_1, sum(share / answers * acc_2) AS acc_2 FROM bc JOIN sh USING (data_source, uid) JOIN w USING (shape, c) GROUP BY ALL)",
        "boot AS (" + " UNION ALL ".join(out) + ")",
    ]
    return ", ".join(ctes)


def _up(rows):
    """Shares of 1,000 draws end on halves at the seventh decimal, which sums in another order would round down."""
    return rows.withColumn("value", F.col("value") + 1e-9)


@query("val_bootstrap", f"WITH RECURSIVE {_bootstrap_sql()} SELECT data_source, uid, variable, metric, round(value + 1e-9, 6) + 0.0 AS value FROM boot", G)
def val_bootstrap(spark, d):
    """Best and worst in closed form and the resampled majority, per prompt."""
    rows = src.rollouts(spark, d, source=True)
    return rounded(_up(va.bootstrap_metrics(rows, ["score", "acc"])), "data_source", "uid", "variable", "metric")


@query(
    "val_metrics",
    f"""WITH RECURSIVE {_bootstrap_sql()}, {POINT.replace("m AS (", "point AS (")},
every AS (SELECT data_source, variable, metric, value FROM l UNION ALL SELECT data_source, variable, metric, value FROM boot)
SELECT data_source, variable, metric, round(avg(value) + 1e-9, 6) + 0.0 AS value FROM every GROUP BY ALL""",
    G,
)
def val_metrics(spark, d):
    rows = src.rollouts(spark, d, source=True)
    return rounded(_up(va.val_metrics(rows, ["score", "acc", "pred"])), "data_source", "variable", "metric")


@query(
    "ext_group_reducer",
    f"""WITH s AS (SELECT uid, score, sample_idx + 1 AS i, count(*) OVER (PARTITION BY uid) AS n FROM rollouts),
d AS (SELECT n, k // 4 AS round, {DRAWN.replace("size", "4")} AS i FROM (SELECT n, unnest(range(400)) AS k FROM (SELECT DISTINCT n FROM s))),
r AS (SELECT uid, round, median(score) AS m, max(score) - min(score) AS g FROM d JOIN s USING (n, i) GROUP BY ALL)
SELECT uid, round(avg(m), 6) + 0.0 AS median_mean, round(stddev_pop(m), 6) + 0.0 AS median_std, round(avg(g), 6) + 0.0 AS range_mean, round(stddev_pop(g), 6) + 0.0 AS range_std FROM r GROUP BY uid""",
    G,
)
def ext_group_reducer(spark, d):
    """Caller-supplied reducers (median, range) over resampled scores of each prompt."""
    import numpy as np

    rows = src.rollouts(spark, d, index=True)
    out = va.group_reduce(rows, ["uid"], "score", "sample_idx", {"median": np.median, "range": np.ptp}, size=4)
    return rounded(out, "uid")
