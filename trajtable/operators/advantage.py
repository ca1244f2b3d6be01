"""Group-relative advantages.

Outcome estimators take one row per response (``score``) and return one scalar per response; the
token advantage is that scalar times the response mask. Token estimators take one row per token.
Groups (``uid``) are aggregated and joined back, so a hot prompt is split by the join. Sums and
recurrences along a trajectory run over bounded pieces of it, so its length does not matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajtable.operators.masked import EPS, masked_mean, whiten
from trajtable.plans.skew import affine, by_position, materialise, running, with_stats

GROUP = ("step", "uid")


def group_mean_std(df: DataFrame, score: str, keys: Sequence[str] = GROUP, eps: float = 0.0) -> DataFrame:
    """Per group mean, sample deviation ``sqrt(max(var, eps))`` and count; a single row gives 0 and 1."""
    single = F.count(F.lit(1)) == 1
    return df.groupBy(*keys).agg(
        F.when(single, 0.0).otherwise(F.avg(score)).alias("mean"),
        F.when(single, 1.0).otherwise(F.sqrt(F.greatest(F.var_samp(score), F.lit(eps)))).alias("std"),
        F.count(F.lit(1)).alias("n"),
    )


def _stats(df: DataFrame, score: str, keys: Sequence[str]) -> DataFrame:
    n = F.count(F.lit(1))
    return with_stats(
        df,
        keys,
        n.alias("_n"),
        F.when(n == 1, 0.0).otherwise(F.avg(score)).alias("_mean"),
        F.when(n == 1, 1.0).otherwise(F.stddev_samp(score)).alias("_std"),
    )


def _normalised(score: Column, by_std: bool, eps: float) -> Column:
    centred = score - F.col("_mean")
    return centred / (F.col("_std") + eps) if by_std else centred


def grpo(
    df: DataFrame, score: str = "score", keys: Sequence[str] = GROUP, out: str = "advantage",
    by_std: bool = True, eps: float = 1e-6,
) -> DataFrame:
    """(score - mean) / (std + eps); a single sample keeps its score (mean 0, std 1)."""
    rows = _stats(df, score, keys)
    return rows.withColumn(out, _normalised(F.col(score), by_std, eps)).drop("_n", "_mean", "_std")


def grpo_from_table(df: DataFrame, score: str = "score", keys: Sequence[str] = GROUP) -> DataFrame:
    """The same rule through ``group_mean_std``."""
    rows = df.join(group_mean_std(df, score, keys), list(keys))
    return rows.withColumn("advantage", (F.col(score) - F.col("mean")) / (F.col("std") + 1e-6)).drop(
        "mean", "std", "n"
    )


def gdpo(
    df: DataFrame, components: Sequence[str], weights: Sequence[float] | None = None,
    tokens: str = "resp_len", keys: Sequence[str] = GROUP, batch: Sequence[str] = ("step",), eps: float = 1e-6,
) -> DataFrame:
    """Normalise every reward component in its group, add them weighted, whiten over the batch."""
    weights = list(weights) if weights is not None else [1.0] * len(components)
    n = F.count(F.lit(1))
    aggregates = []
    for c in components:
        aggregates += [
            F.when(n == 1, 0.0).otherwise(F.avg(c)).alias(f"_mean_{c}"),
            F.when(n == 1, 1.0).otherwise(F.stddev_samp(c)).alias(f"_std_{c}"),
        ]
    rows = with_stats(df, keys, *aggregates)
    total = F.lit(0.0)
    for c, w in zip(components, weights):
        total = total + w * (F.col(c) - F.col(f"_mean_{c}")) / (F.col(f"_std_{c}") + eps)
    drop = [f"_{kind}_{c}" for c in components for kind in ("mean", "std")]
    rows = rows.withColumn("_sum", total).drop(*drop)
    return whiten(rows, "_sum", F.col(tokens), batch, "advantage", weight=F.col(tokens)).drop("_sum")


def top_two(df: DataFrame, keys: Sequence[str], value: str, index: str | None = None) -> DataFrame:
    """Per group: largest value, how many rows share it, its lowest index, the second largest value.

    Rows are first reduced to value counts, so a hot group never meets in one task. ``_second``
    equals ``_max`` when two rows share the maximum and is null for a single row.
    """
    keys = list(keys)
    first = F.min(index) if index else F.lit(None)
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_ties"), first.alias("_first"))
    top = counts.groupBy(*keys).agg(
        F.max(value).alias("_max"),
        F.max_by("_ties", value).alias("_ties"),
        F.max_by("_first", value).alias("_best"),
        F.sum("_ties").alias("_rows"),
    )
    below = (
        counts.select(*keys, F.col(value).alias("_v"))
        .join(top.select(*keys, "_max"), keys)
        .groupBy(*keys)
        .agg(F.max(F.when(F.col("_v") < F.col("_max"), F.col("_v"))).alias("_below"))
    )
    return top.join(below, keys).withColumn(
        "_second", F.when(F.col("_ties") > 1, F.col("_max")).otherwise(F.col("_below"))
    ).drop("_below")


def grpo_passk(
    df: DataFrame, score: str = "score", index: str = "sample_idx", keys: Sequence[str] = GROUP,
    by_std: bool = True, eps: float = 1e-6, single: str = "error",
) -> DataFrame:
    """Only the best sample gets (max - second) / (std + eps); equal scores go to the lowest index.

    Groups of one sample are an error, or null with ``single="null"``.
    """
    keys = list(keys)
    top = top_two(df, keys, score, index)
    spread = df.groupBy(*keys).agg(F.stddev_samp(score).alias("_std"))
    rows = df.join(top.join(spread, keys), keys)
    gain = F.col("_max") - F.col("_second")
    gain = gain / (F.col("_std") + eps) if by_std else gain
    alone = F.raise_error(F.lit("pass@k needs two samples per group")).cast("double")
    value = (
        F.when(F.col("_rows") < 2, alone if single == "error" else F.lit(None).cast("double"))
        .when(F.col(index) == F.col("_best"), gain)
        .otherwise(0.0)
    )
    return rows.withColumn("advantage", value).drop("_max", "_ties", "_best", "_rows", "_second", "_std")


def reinforce_pp_baseline(
    df: DataFrame, score: str = "score", tokens: str = "resp_len", keys: Sequence[str] = GROUP,
    batch: Sequence[str] = ("step",),
) -> DataFrame:
    """Score minus group mean, whitened over the tokens of the batch."""
    rows = grpo(df, score, keys, out="_centred", by_std=False)
    return whiten(rows, "_centred", F.col(tokens), batch, "advantage", weight=F.col(tokens)).drop("_centred")


def rloo(df: DataFrame, score: str = "score", keys: Sequence[str] = GROUP) -> DataFrame:
    """Leave-one-out baseline; a single sample keeps its raw score."""
    n = F.col("_n")
    value = F.when(n > 1, (F.col(score) - F.col("_mean")) * n / (n - 1)).otherwise(F.col(score))
    return _stats(df, score, keys).withColumn("advantage", value).drop("_n", "_mean", "_std")


def rloo_from_sums(df: DataFrame, score: str = "score", keys: Sequence[str] = GROUP) -> DataFrame:
    """(n * score - sum) / max(n - 1, 1): the form in which a single sample gets 0."""
    rows = with_stats(df, keys, F.count(F.lit(1)).alias("_n"), F.sum(score).alias("_sum"))
    value = (F.col("_n") * F.col(score) - F.col("_sum")) / F.greatest(F.col("_n") - 1, F.lit(1))
    return rows.withColumn("advantage", value).drop("_n", "_sum")


def opo(df: DataFrame, score: str = "score", tokens: str = "resp_len", keys: Sequence[str] = GROUP) -> DataFrame:
    """Score less the length-weighted mean score of the group; a single sample keeps its score.

    Divided once, at the end, so that scores that are whole numbers give the exact quotient.
    """
    sums = [F.count(F.lit(1)).alias("_n"), F.sum(tokens).alias("_tokens"), F.sum(F.col(tokens) * F.col(score)).alias("_mass")]
    rows = with_stats(df, keys, *sums)
    centred = (F.col(score) * F.col("_tokens") - F.col("_mass")) / F.col("_tokens")
    return rows.withColumn("advantage", F.when(F.col("_n") == 1, F.col(score)).otherwise(centred)).drop("_n", "_tokens", "_mass")


def gpg(
    df: DataFrame, score: str = "score", keys: Sequence[str] = GROUP, batch: Sequence[str] = ("step",),
    f_norm: float = 1.0,
) -> DataFrame:
    """alpha * (score - mean) / f_norm with alpha = batch rows / rows with a non-zero score.

    alpha always comes from the batch and the deviation is not used.
    """
    nonzero = F.count(F.when(F.col(score) != 0, 1))
    rows = with_stats(
        _stats(df, score, keys), batch, (F.count(F.lit(1)) / F.greatest(nonzero, F.lit(1))).alias("_alpha")
    )
    value = F.col("_alpha") * (F.col(score) - F.col("_mean")) / f_norm
    return rows.withColumn("advantage", value).drop("_n", "_mean", "_std", "_alpha")


def multi_output(
    df: DataFrame, score: str = "score", session: str = "session_id", index: str = "output_idx",
    keys: Sequence[str] = GROUP,
) -> DataFrame:
    """Score the last output of each session and give the result to every output of the session."""
    sess = [*keys, session]
    final = df.groupBy(*sess).agg(F.max_by(score, index).alias("_final"))
    scored = grpo(final, "_final", keys).drop("_final")
    return df.join(scored, sess)


# --- token rows -------------------------------------------------------------------------------


def returns_to_go(df: DataFrame, reward: str = "reward", mask: str = "mask", traj=("seq_id",), t: str = "t", out: str = "returns") -> DataFrame:
    """Sum of the masked rewards from each token on."""
    return running(by_position(df, t), traj, [F.col(t)], ahead={out: F.col(reward) * F.col(mask)})


def remax(df: DataFrame, baseline: str = "baseline", traj=("seq_id",), t: str = "t") -> DataFrame:
    """Return-to-go minus the greedy baseline on masked tokens."""
    rows = returns_to_go(df, traj=traj, t=t)
    return rows.withColumn("advantage", F.col("returns") - F.col(baseline) * F.col("mask"))


def reinforce_pp(df: DataFrame, gamma: float = 1.0, traj=("seq_id",), t: str = "t", batch=("step",)) -> DataFrame:
    """Reverse discounted return that restarts at every mask-0 token; whitened and masked advantage.

    The token after passes on its return only where its mask is on: with y the masked return,
    ``y = mask * (reward + gamma * y_next)``, an affine step.
    """
    mask = F.col("mask")
    rows = affine(df, traj, t, gamma * mask, mask * F.col("reward"), "_y", "_next")
    rows = rows.withColumn("returns", F.col("reward") + gamma * F.col("_next")).drop("_y", "_next")
    white = whiten(rows, "returns", mask, batch, "_white")
    return white.withColumn("advantage", F.col("_white") * mask).drop("_white")


def gae(df: DataFrame, gamma: float = 1.0, lam: float = 1.0, traj=("seq_id",), t: str = "t", batch=("step",)) -> DataFrame:
    """Generalised advantage estimate; mask-0 tokens hold the state of the token after them.

    With gamma = lam = 1 the recursion telescopes to rewards-to-go minus the value; other settings are
    an affine step per token, the identity where the mask is off. Returns are advantage + value before
    whitening, and the whitened advantage is not masked again.
    """
    on = F.col("mask") > 0
    value, reward = F.col("value"), F.col("reward")
    later = {"_after": F.when(on, value)}  # the value of the next token that is on
    rows = by_position(df, t)
    if gamma == 1.0 and lam == 1.0:
        rows = running(rows, traj, [F.col(t)], ahead={"_sum": reward * F.col("mask")}, upcoming=later)
        held = F.when(on, value).otherwise(F.coalesce("_after", F.lit(0.0)))
        rows = materialise(rows.withColumn("_raw", F.col("_sum") - held).drop("_sum", "_after"))
    else:
        rows = running(rows, traj, [F.col(t)], upcoming=later)
        delta = reward + gamma * F.coalesce("_after", F.lit(0.0)) - value
        rows = affine(rows, traj, t, F.when(on, gamma * lam).otherwise(1.0), F.when(on, delta).otherwise(0.0), "_raw").drop("_after")
    rows = rows.withColumn("returns", F.col("_raw") + F.col("value"))
    return whiten(rows, "_raw", F.col("mask"), batch, "advantage").drop("_raw")


def token_baseline(
    df: DataFrame, traj=("seq_id",), t: str = "t", keys: Sequence[str] = GROUP, weight: str | None = None,
    packed: bool = False, zero_tail: bool = True,
) -> DataFrame:
    """Variance-optimal baseline per group and position: sum(R * W) / (sum(W) + 1e-8).

    W accumulates 1 - 2p + sum(p^2) along a trajectory (times ``weight`` squared). A group of one
    has baseline 0, and the only longest trajectory has baseline 0 beyond the second longest.
    ``packed`` counts positions over masked tokens only and leaves out trajectories without any.
    """
    traj, keys = list(traj), list(keys)
    proxy = 1 - 2 * F.exp("old_lp") + F.col("sum_pi2")
    if weight:
        proxy = proxy * F.col(weight) * F.col(weight)
    sums = {"_w": proxy * F.col("mask")} | ({"_pos": F.col("mask").cast("bigint")} if packed else {})
    rows = running(by_position(df, t), traj, [F.col(t)], behind=sums, ahead={"returns": F.col("reward") * F.col("mask")})
    rows = materialise(rows.withColumn("_pos", F.col("_pos") - 1 if packed else F.col(t).cast("bigint")))  # read three times
    on = rows.where(F.col("mask") > 0)
    lengths = rows.groupBy(*keys, *traj).agg(F.sum("mask").alias("_len"))
    if packed:
        lengths = lengths.where(F.col("_len") > 0)
    group = top_two(lengths, keys, "_len").select(
        *keys, F.col("_rows").alias("_n"), F.col("_max").alias("_longest"), "_second"
    )
    base = on.groupBy(*keys, "_pos").agg(
        (F.sum(F.col("returns") * F.col("_w")) / (F.sum("_w") + EPS)).alias("_base")
    )
    per_traj = lengths.join(group, keys)
    tail = (F.col("_len") == F.col("_longest")) & (F.col("_longest") > F.col("_second"))
    zero_from = F.when(F.col("_n") == 1, 0).when(F.lit(zero_tail) & tail, F.col("_second"))
    per_traj = per_traj.select(*keys, *traj, zero_from.alias("_zero_from"))
    joined = rows.join(base, [*keys, "_pos"], "left").join(per_traj, [*keys, *traj], "left")
    baseline = F.when(F.col("_pos") >= F.col("_zero_from"), 0.0).otherwise(F.coalesce("_base", F.lit(0.0)))
    return joined.withColumn("advantage", (F.col("returns") - baseline) * F.col("mask")).drop(
        "_w", "_pos", "_base", "_zero_from"
    )


# --- rewards ------------------------------------------------------------------------------------


def kl_in_reward(df: DataFrame, kl: Column, beta: float, score: str = "reward") -> DataFrame:
    """Token reward = score - beta * kl * mask."""
    return df.withColumn("kl", kl * F.col("mask")).withColumn(
        "token_reward", F.col(score) - beta * F.col("kl")
    )


def mean_row_kl(df: DataFrame, kl: str = "kl", traj=("seq_id",), batch=("step",)) -> DataFrame:
    """The logged KL: mean over trajectories of the trajectory's masked mean."""
    rows = df.groupBy(*batch, *traj).agg(masked_mean(F.col(kl), F.col("mask")).alias("_kl"))
    return rows.groupBy(*batch).agg(F.avg("_kl").alias("current_kl"), F.count(F.lit(1)).alias("n"))


def adaptive_kl(
    steps: DataFrame, init: float, target: float, horizon: float, run: str = "run", step: str = "step"
) -> DataFrame:
    """KL coefficient after each step: a running product over the steps of a run."""
    error = F.greatest(F.least(F.col("current_kl") / target - 1, F.lit(0.2)), F.lit(-0.2))
    factor = 1 + error * F.col("n") / horizon
    so_far = Window.partitionBy(run).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumn("beta", init * F.exp(F.sum(F.log(factor)).over(so_far)))


def overlong_penalty(length: Column, max_len: int, buffer: int, factor: float = 1.0) -> Column:
    """Linear penalty inside the last ``buffer`` tokens of the allowance, never positive."""
    over = length - (max_len - buffer)
    return F.least(-over / buffer * factor, F.lit(0.0))


def assemble_scores(mask: Column, score: Column, empty: str = "skip") -> Column:
    """Token rewards: the score at the last valid token, zeros elsewhere.

    A response without valid tokens gets nothing, or the score at its last position with
    ``empty="last"`` (the older behaviour, an index of -1).
    """
    valid = F.aggregate(mask, F.lit(0), lambda a, x: a + x.cast("int"))
    target = F.when(valid > 0, valid - 1)
    if empty == "last":
        target = F.coalesce(target, F.size(mask) - 1)
    return F.transform(mask, lambda _, i: F.when(i == target, score).otherwise(F.lit(0.0)))


def place_scores(
    df: DataFrame, score: str = "score", mask: str = "mask", traj=("seq_id",), t: str = "t", empty: str = "skip", out: str = "token_score",
) -> DataFrame:
    """``assemble_scores`` on token rows: the score of the trajectory at its last valid token."""
    rows = with_stats(df, list(traj), F.sum(mask).alias("_valid"), F.count(F.lit(1)).alias("_n"))
    target = F.when(F.col("_valid") > 0, F.col("_valid") - 1)
    if empty == "last":
        target = F.coalesce(target, F.col("_n") - 1)
    return rows.withColumn(out, F.when(F.col(t) == target, F.col(score)).otherwise(F.lit(0.0))).drop("_valid", "_n")
