"""Training metrics: per-step aggregates, metric tables and their reduction rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.operators.masked import masked_mean, masked_sum
from trajtable.operators.batch import with_index
from trajtable.plans.skew import quantiles



def rows_n() -> Column:
    return F.count(F.lit(1))


def spread(col: Column, name: str, kinds: Sequence[str] = ("mean", "max", "min")) -> list[Column]:
    make = {"mean": F.avg, "max": F.max, "min": F.min, "std": F.stddev_pop, "sum": F.sum}
    return [F.coalesce(make[k](col).cast("double"), F.lit(float("nan"))).alias(f"{name}_{k}") for k in kinds]


def response_rows(tokens: DataFrame, keys=("step", "uid", "seq_id")) -> DataFrame:
    """One row per response: sums of scores and masked moments needed by ``data_metrics``."""
    on = F.col("mask") > 0
    cells = [F.sum("mask").alias("resp_len"), F.sum("score").alias("score"), F.sum("reward").alias("reward")]
    parts = {"adv": F.col("adv"), "returns": F.col("returns")}
    if "value" in tokens.columns:  # a critic
        parts |= {"value": F.col("value"), "diff": F.col("returns") - F.col("value")}
    for c, x in parts.items():
        v = F.when(on, x)
        cells += [F.sum(v).alias(f"{c}_sum"), F.sum(v * v).alias(f"{c}_sq"), F.max(v).alias(f"{c}_max"), F.min(v).alias(f"{c}_min")]
    return tokens.groupBy(*keys).agg(*cells)


def data_metrics(rows: DataFrame, max_prompt: int, max_response: int, batch=("step",)) -> DataFrame:
    """Score, reward, advantage, return, value and length statistics; NaN where nothing is valid.

    Without a critic, that is without value columns, values and explained variance are left out.
    """
    critic = "value_sum" in rows.columns
    alive = F.col("resp_len") > 0
    n = F.sum("resp_len")
    nan = F.lit(float("nan"))

    def token(c: str, name: str) -> list[Column]:
        return [
            F.coalesce(F.sum(f"{c}_sum") / n, nan).alias(f"{name}_mean"),
            F.coalesce(F.max(f"{c}_max"), nan).alias(f"{name}_max"),
            F.coalesce(F.min(f"{c}_min"), nan).alias(f"{name}_min"),
        ]

    def var(c: str) -> Column:
        return (F.sum(f"{c}_sq") - F.sum(f"{c}_sum") * F.sum(f"{c}_sum") / n) / (n - 1)

    length = F.col("resp_len")
    at = lambda c, limit: F.avg((c == limit).cast("double"))
    out = [
        *spread(F.when(alive, F.col("score")), "score"),
        *spread(F.when(alive, F.col("reward")), "reward"),
        *token("adv", "advantages"),
        *token("returns", "returns"),
        *(token("value", "values") if critic else []),
        *([(1.0 - var("diff") / (var("returns") + 1e-5)).alias("explained_var")] if critic else []),
        *spread(length, "response_length"),
        at(length, max_response).alias("response_length_clip_ratio"),
        *spread(F.when(alive, length), "response_length_alive"),
        F.coalesce(F.avg(F.when(alive, (length == max_response).cast("double"))), nan).alias("response_length_alive_clip_ratio"),
        F.avg((~alive).cast("double")).alias("aborted_ratio"),
        *spread(F.col("prompt_len"), "prompt_length"),
        at(F.col("prompt_len"), max_prompt).alias("prompt_length_clip_ratio"),
    ]
    for extra in ("num_turns", "tool_calls"):
        if extra in rows.columns:
            out += spread(F.col(extra), extra)
    return rows.groupBy(*batch).agg(*out)


# fixed values: stages whose time is divided by all tokens; generation counts response tokens only
ALL_TOKEN_STAGES = ("ref", "values", "adv", "update_critic", "update_actor")


def timing_metrics(rows: DataFrame, timing: DataFrame, batch=("step",)) -> DataFrame:
    """``timing`` holds (step, name, seconds); adds milliseconds per token where a count is defined."""
    sizes = rows.groupBy(*batch).agg(F.sum("resp_len").alias("_resp"), F.sum(F.col("resp_len") + F.col("prompt_len")).alias("_all"))
    count = F.when(F.col("name") == "gen", F.col("_resp")).when(F.col("name").isin(*ALL_TOKEN_STAGES), F.col("_all"))
    return timing.join(sizes, list(batch)).select(
        *batch, "name", F.col("seconds").alias("timing_s"), (F.col("seconds") * 1000 / count).alias("timing_per_token_ms")
    )


def throughput(rows: DataFrame, timing: DataFrame, gpus: int, batch=("step",)) -> DataFrame:
    sizes = rows.groupBy(*batch).agg(F.sum(F.col("resp_len") + F.col("prompt_len")).alias("total_num_tokens"))
    steps = timing.where(F.col("name") == "step").select(*batch, F.col("seconds").alias("time_per_step"))
    return sizes.join(steps, list(batch)).withColumn(
        "throughput", F.col("total_num_tokens") / (F.col("time_per_step") * gpus)
    )


def variance_proxy(
    tokens: DataFrame, weight: str | None = None, gradient_norm: float | None = None, traj=("seq_id",), batch=("step",)
) -> DataFrame:
    """Signal strength, total power and noise proxies of the batch gradient."""
    m = F.col("mask")
    w = 1 - 2 * F.exp("old_lp") + F.col("sum_pi2")
    cells = [masked_mean(F.col("adv"), m).alias("a")]
    if weight:
        used = w * F.col(weight) * F.col(weight)
        original = used / F.greatest(F.col(weight) * F.col(weight), F.lit(1e-10))
        cells += [masked_sum(used, m).alias("w"), masked_sum(original, m).alias("w0"), masked_mean(F.col(weight), m).alias("rho")]
    else:
        cells += [masked_sum(w, m).alias("w"), masked_sum(w, m).alias("w0"), F.lit(1.0).alias("rho")]
    per_row = tokens.groupBy(*batch, *traj).agg(*cells)
    power = F.avg(F.col("rho") * F.col("rho") * F.col("a") * F.col("a") * F.greatest("w0", F.lit(0.0)))
    signal = gradient_norm * gradient_norm if gradient_norm is not None else None
    noise = F.lit(0.0)
    if signal is not None:
        noise = F.when(rows_n() > 1, F.greatest((power - signal) / (rows_n() - 1), F.lit(0.0))).otherwise(0.0)
    return per_row.groupBy(*batch).agg(
        F.max(F.lit(signal if signal is not None else 0.0)).alias("signal_strength"),
        power.alias("total_power"),
        noise.alias("pure_noise"),
        F.avg(F.col("a") * F.col("a")).alias("expected_a_squared"),
        F.avg("w").alias("expected_w"),
    )


# --- metric tables -------------------------------------------------------------------------------


def metric_reduce(df: DataFrame, keys: Sequence[str], key: str = "key", declared: str | None = None) -> DataFrame:
    """Declared aggregation first, then by name: ``max``, then ``min``, else mean."""
    named = F.when(F.col(key).contains("max"), "max").when(F.col(key).contains("min"), "min").otherwise("mean")
    rule = F.coalesce(F.col(declared), named) if declared else named
    rows = df.withColumn("_rule", rule)
    stats = rows.groupBy(*keys, key, "_rule").agg(
        F.max("value").alias("_max"), F.min("value").alias("_min"), F.avg("value").alias("_mean"), F.sum("value").alias("_sum")
    )
    value = (
        F.when(F.col("_rule") == "max", F.col("_max")).when(F.col("_rule") == "min", F.col("_min"))
        .when(F.col("_rule") == "sum", F.col("_sum")).otherwise(F.col("_mean"))
    )
    return stats.select(*keys, key, value.alias("value"))


def metric_dp(df: DataFrame, key: str = "key", rule: str = "rule", rank: str = "rank", index: str = "i") -> DataFrame:
    """Combine ranks: sum and mean average over ranks first; ranks must report equally often."""
    sizes = df.groupBy(key, rank).agg(rows_n().alias("_n")).groupBy(key).agg(F.min("_n").alias("_lo"), F.max("_n").alias("_hi"))
    per_index = df.groupBy(key, rule, index).agg(F.avg("value").alias("_m"), F.min("value").alias("_lo_v"), F.max("value").alias("_hi_v"))
    total = per_index.groupBy(key, rule).agg(
        F.sum("_m").alias("_sum"), F.avg("_m").alias("_mean"), F.min("_lo_v").alias("_min"), F.max("_hi_v").alias("_max")
    )
    unequal = F.raise_error(F.lit("ranks report different numbers of values")).cast("double")
    value = (
        F.when(F.col("_lo") != F.col("_hi"), unequal).when(F.col(rule) == "sum", F.col("_sum"))
        .when(F.col(rule) == "mean", F.col("_mean")).when(F.col(rule) == "min", F.col("_min")).otherwise(F.col("_max"))
    )
    return total.join(sizes, key).select(key, rule, value.alias("value"))


# fixed values: metrics with an explicit rule when several steps are combined
WINDOW_RULES = {
    "sum": ["perf/time_per_step"],
    "min": ["timing_s/agent_loop/tool_calls/min"],
    "avg": ["timing_s/agent_loop/tool_calls/mean"],
    "max": ["timing_s/agent_loop/tool_calls/max"],
    "last": [
        "fully_async/count/total_generated_samples",
        "fully_async/count/stale_samples_processed",
        "fully_async/count/stale_trajectory_processed",
        "fully_async/count/current_param_version",
        "fully_async/count/dropped_stale_samples",
        "training/global_step",
    ],
}


def window_rule(key: Column) -> Column:
    """Rule for combining a metric over steps. A weighted_avg name already matches avg."""
    rule = None
    for name, keys in WINDOW_RULES.items():
        rule = rule.when(key.isin(*keys), name) if rule is not None else F.when(key.isin(*keys), name)
    low = F.lower(key)
    return (
        rule.when(low.contains("timing_s/"), "sum")
        .when(low.rlike("mean|avg|average"), "avg")
        .when(low.contains("max"), "max")
        .when(low.contains("min"), "min")
        .when(low.rlike("sum|total"), "sum")
        .otherwise("avg")
    )


def window_stats(df: DataFrame, keys: Sequence, step: str = "step") -> DataFrame:
    """The one aggregation behind ``metric_window``; also runs on a stream with a window among the keys."""
    rows = df.withColumn("_rule", window_rule(F.col("key")))
    return rows.groupBy(*keys, "key", "_rule").agg(
        F.sum("value").alias("sum"), F.avg("value").alias("avg"), F.max("value").alias("max"),
        F.min("value").alias("min"), F.max_by("value", step).alias("last"),
    )


def window_finish(stats: DataFrame, keys: Sequence[str], gpus: int) -> DataFrame:
    """Pick the value each rule asks for, then recompute the metrics derived from others."""
    keys = list(keys)
    value = F.col("avg")
    for name in ("sum", "max", "min", "last"):
        value = F.when(F.col("_rule") == name, F.col(name)).otherwise(value)
    plain = stats.select(*keys, "key", value.alias("value"))
    get = lambda k: F.max(F.when(F.col("key") == k, F.col("value")))
    special = plain.groupBy(*keys).agg(
        F.when(get("global_seqlen/minmax_diff").isNotNull(), get("global_seqlen/max") - get("global_seqlen/min")).alias("_diff"),
        F.when(get("perf/throughput").isNotNull(), get("perf/total_num_tokens") / (get("perf/time_per_step") * gpus)).alias("_tp"),
        (get("timing_s/gen") / get("timing_s/step")).alias("_idle"),
    )
    fixed = special.select(
        *keys,
        F.inline(F.array(*[
            F.struct(F.lit(k).alias("key"), F.col(c).alias("value"))
            for k, c in {"global_seqlen/minmax_diff": "_diff", "perf/throughput": "_tp", "fully_async/trainer/idle_ratio": "_idle"}.items()
        ])),
    ).where(F.col("value").isNotNull())
    kept = plain.join(fixed.select(*keys, "key"), [*keys, "key"], "left_anti")
    return kept.unionByName(fixed)


def metric_window(df: DataFrame, keys: Sequence[str], gpus: int, step: str = "step") -> DataFrame:
    """Combine (window, step, key, value) rows per window by the rule of each metric name."""
    return window_finish(window_stats(df, keys, step), keys, gpus)


def async_batch_stats(df: DataFrame, batch: Sequence[str], seconds: str, calls: str, start: str, end: str) -> DataFrame:
    """Processing-time and tool-call statistics and the spread of model versions per batch."""
    span = F.abs(F.col(end) - F.col(start))
    plain = df.groupBy(*batch).agg(
        *spread(F.col(seconds), "processing_time"),
        *spread(F.col(calls), "tool_calls"),
        F.count(F.when(span > 0, 1)).alias("partial_num"),
        F.avg((span > 0).cast("double")).alias("partial_ratio"),
        F.max(span).alias("max_partial_span"),
    )
    versions = df.select(*batch, end).distinct().groupBy(*batch).agg(rows_n().alias("version_diversity"))
    tails = quantiles(df, batch, seconds, {"tp50": 0.5, "tp95": 0.95, "tp99": 0.99})
    return plain.join(versions, list(batch)).join(tails, list(batch))


def logprob_debug(tokens: DataFrame, batch=("step",)) -> DataFrame:
    """Difference and correlation of actor and rollout probabilities over masked tokens."""
    on = F.col("mask") > 0
    p, q = F.when(on, F.exp("old_lp")), F.when(on, F.exp("rollout_lp"))
    nan = F.lit(float("nan"))
    diff = F.abs(p - q)
    return tokens.groupBy(*batch).agg(
        (F.sum("mask") > 0).cast("int").alias("valid"),
        F.coalesce(F.max(diff), nan).alias("diff_max"),
        F.coalesce(F.avg(diff), nan).alias("diff_mean"),
        F.coalesce(F.stddev_samp(diff), nan).alias("diff_std"),
        F.coalesce(F.corr(p, q), nan).alias("pearson"),
    )


def token_diff_count(a: Column, b: Column, mask: Column) -> Column:
    """Masked count of differing ids of two arrays; 0 when empty."""
    flags = F.zip_with(F.zip_with(a, b, lambda x, y: x != y), mask, lambda d, m: F.when(d & (m == 1), 1).otherwise(0))
    return F.aggregate(flags, F.lit(0), lambda s, x: s + x).cast("bigint")


def token_diff_rows(df: DataFrame, a: Column, b: Column, mask: Column, traj: Sequence[str]) -> DataFrame:
    """``token_diff_count`` on token rows: one count per trajectory."""
    return df.groupBy(*traj).agg(F.count(F.when((a != b) & (mask == 1), 1)).alias("diff"))


def spec_decode(df: DataFrame, batch=("step",), padding: str | None = None) -> DataFrame:
    """Mean accept rate and accept length per request; zero denominators count as 0."""
    rows = df.where(~F.col(padding)) if padding else df
    d, a, v = F.col("drafted"), F.col("accepted"), F.col("verified")
    return rows.groupBy(*batch).agg(
        F.avg(F.when(d > 0, a / d).otherwise(0.0)).alias("accept_rate"),
        F.avg(F.when(v > 0, 1.0 + a / v).otherwise(0.0)).alias("accept_length"),
    )


# fixed values: texts that count as true
TRUE_WORDS = ("1", "true", "yes", "y", "on")


def trigger_stop_metrics(df: DataFrame, batch=("step",), flag: str = "stopped") -> DataFrame:
    on = F.coalesce(F.lower(F.col(flag)).isin(*TRUE_WORDS), F.lit(False))
    length, position = F.when(on, F.col("resp_len")), F.when(on, F.col("stop_pos").try_cast("int"))
    return df.groupBy(*batch).agg(
        F.avg(on.cast("double")).alias("ratio"),
        F.count(F.when(on, 1)).alias("n"),
        F.avg(length).alias("length_mean"), F.max(length).alias("length_max"), F.min(length).alias("length_min"),
        F.avg(position).alias("pos_mean"), F.max(position).alias("pos_max"),
    )


def teacher_mask_metrics(tokens: DataFrame, teacher: str = "teacher_mask", traj=("seq_id",), batch=("step",)) -> DataFrame:
    """Teacher token ratio, mean ratio per sequence, share of sequences with any teacher token."""
    hit = (F.col(teacher) > 0) & (F.col("mask") > 0)
    per_row = tokens.groupBy(*batch, *traj).agg(F.sum("mask").alias("n"), F.count(F.when(hit, 1)).alias("k"))
    return per_row.groupBy(*batch).agg(
        (F.sum("k") / F.greatest(F.sum("n"), F.lit(1))).alias("token_ratio"),
        F.avg(F.col("k") / F.greatest("n", F.lit(1))).alias("seq_ratio"),
        F.avg((F.col("k") > 0).cast("double")).alias("seq_any"),
    )


def source_token_stats(tokens: DataFrame, batch: Sequence[str], source: str = "source", accepted: str = "accepted") -> DataFrame:
    """Counters over the emitted log: drafted, emitted, student, teacher, accepted; teacher share."""
    count = lambda cond: F.count(F.when(cond, 1))
    teacher, student = count(F.col(source) == "teacher"), count(F.col(source) == "student")
    return tokens.groupBy(*batch).agg(
        count(F.col(source) == "student").alias("student_tokens"),
        teacher.alias("teacher_tokens"),
        rows_n().alias("emitted_tokens"),
        count(F.col("drafted") > 0).alias("drafted_tokens"),
        count(F.col(accepted) > 0).alias("accepted_tokens"),
        F.when(teacher + student > 0, teacher / (teacher + student)).alias("teacher_ratio"),
    )


def component_stats(df: DataFrame, components: Sequence[str], batch=("step",)) -> DataFrame:
    cells = [c for name in components for c in spread(F.col(name), name, ("mean", "std", "max", "min"))]
    return df.groupBy(*batch).agg(*cells)


def case_score(cases: DataFrame, keys: Sequence[str], passed: str, index: str, continuous: bool = False) -> DataFrame:
    """Share of passed test cases; the continuous mode looks at the first ten cases."""
    used = F.col(index) < 10 if continuous else F.lit(True)
    rate = F.coalesce(F.avg(F.when(used, F.col(passed).cast("double"))), F.lit(0.0))
    return cases.groupBy(*keys).agg(rate.alias("score") if continuous else F.min(F.col(passed).cast("double")).alias("score"), rate.alias("pass_rate"))


def label_ids(df: DataFrame, label: str, kind: str, out: str = "group_id") -> DataFrame:
    """Dense ids for group labels, sorted by text; numbers and texts that look alike stay apart.

    ``kind`` names the column that tells numbers (``n``) from texts (``s``); numbers within 1e-6 of
    an integer are rounded to it.
    """
    number = F.col(label).try_cast("double")
    near = F.abs(number - F.round(number)) < 1e-6
    canonical = F.when(
        F.col(kind) == "n", F.concat(F.lit("n:"), F.when(near, F.round(number).cast("bigint").cast("string")).otherwise(number.cast("string")))
    ).otherwise(F.concat(F.lit("s:"), F.col(label)))
    rows = df.withColumn("_label", canonical)
    labels = rows.select("_label").distinct()
    ids = with_index(labels, [F.col("_label")], out=out)
    return rows.join(ids, "_label").drop("_label")
