"""Off-policy correction on token rows: weights, rejection masks and drift metrics.

``log_ratio = old_lp - rollout_lp``. Per-trajectory statistics are aggregates that are joined back to the
tokens; batch metrics are two aggregations, trajectory then step, and do not go back to the tokens.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.functions.divergence import clamp
from trajtable.operators.masked import EPS, masked_mean, masked_sum
from trajtable.plans.skew import with_stats

# fixed values: rejection options and the bound on log ratios
TOKEN_OPTIONS = ("token_k1", "token_k2", "token_k3")
SEQUENCE_OPTIONS = (
    "seq_sum_k1", "seq_sum_k2", "seq_sum_k3", "seq_mean_k1", "seq_mean_k2", "seq_mean_k3",
    "seq_max_k2", "seq_max_k3",
)
BOUND = 20.0

LR = "log_ratio"


def limits(spec: str | float) -> tuple[float | None, float]:
    """``"u"`` is an upper bound, ``"l_u"`` a pair."""
    if isinstance(spec, bool):
        raise ValueError("a threshold is a number or 'lower_upper'")
    parts = [float(p) for p in str(spec).split("_")]
    if len(parts) == 1:
        low, high = None, parts[0]
    elif len(parts) == 2:
        low, high = parts
        if not 0 < low <= high:
            raise ValueError(f"bounds must satisfy 0 < lower <= upper: {spec}")
    else:
        raise ValueError(f"cannot read threshold {spec}")
    if high <= 0:
        raise ValueError(f"threshold must be positive: {spec}")
    return low, high


def with_log_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn(LR, F.col("old_lp") - F.col("rollout_lp"))


def is_weights(
    df: DataFrame, level: str = "token", threshold: str | float = 2.0, normalise: bool = False,
    traj=("seq_id",), batch=("step",), out: str = "is_weight",
) -> DataFrame:
    """Importance weights: clamped to the upper bound, or zero outside a ``lower_upper`` pair.

    ``normalise`` divides by the batch mean weight (of tokens, or of trajectories).
    """
    if level not in ("token", "sequence"):
        raise ValueError(f"unknown level {level}")
    low, high = limits(threshold)
    mask = F.col("mask")
    rows = with_log_ratio(df)
    if level == "token":
        rows = rows.withColumn("raw_log", F.col(LR))
    else:
        rows = with_stats(rows.drop("raw_log"), traj, F.sum(F.col(LR) * mask).alias("raw_log"))
    rows = rows.withColumn("raw_weight", F.exp(clamp(F.col("raw_log"), -BOUND, BOUND)) * mask)
    raw = F.col("raw_weight")
    weight = F.least(raw, F.lit(high)) if low is None else F.when((raw >= low) & (raw <= high), raw).otherwise(0.0)
    rows = rows.withColumn(out, weight)
    if not normalise:
        return rows
    if level == "token":
        rows = with_stats(rows, batch, masked_mean(F.col(out), mask).alias("_m"))
    else:
        per_row = rows.groupBy(*batch, *traj).agg(masked_mean(F.col(out), mask).alias("_w"), F.sum("mask").alias("_k"))
        on = F.col("_k") > 0
        mean = per_row.groupBy(*batch).agg(
            (F.sum(F.when(on, F.col("_w")).otherwise(0.0)) / F.greatest(F.count(F.when(on, 1)), F.lit(EPS))).alias("_m")
        )
        rows = rows.join(mean, list(batch))
    return rows.withColumn("norm_factor", F.when(F.col("_m") > EPS, F.col("_m")).otherwise(1.0)).withColumn(
        out, F.col(out) / F.col("norm_factor")
    ).drop("_m")


def is_metrics(
    df: DataFrame, level: str = "token", threshold: str | float = 2.0, traj=("seq_id",), batch=("step",)
) -> DataFrame:
    """Weight statistics per batch, before any normalisation."""
    low, high = limits(threshold)
    low_used = 1.0 / high if low is None else low
    rows = is_weights(df, level, threshold, False, traj, batch)
    w, raw, on = F.col("is_weight"), F.col("raw_weight"), F.col("mask") > 0
    n = F.sum("mask")
    clipped = clamp(w, 0.0, high)
    per_row = rows.groupBy(*batch, *traj).agg(
        n.alias("n"),
        masked_sum(w, F.col("mask")).alias("s"),
        masked_sum(clipped, F.col("mask")).alias("c"),
        masked_sum(clipped * clipped, F.col("mask")).alias("c2"),
        F.max(F.when(on, w)).alias("top"),
        F.min(F.when(on, w)).alias("bottom"),
        F.count(F.when(on & (raw > high), 1)).alias("above"),
        F.count(F.when(on & (raw < low_used), 1)).alias("below"),
        F.first("raw_log").alias("log_sum"),
    )
    per_row = per_row.withColumn("mean_w", F.col("s") / (F.col("n") + EPS))
    total = F.sum("n") + EPS
    mean_c = F.sum("c") / total
    if level == "sequence":
        top, bottom = F.exp(F.least(F.max("log_sum"), F.lit(BOUND))), F.exp(F.min("log_sum"))
        high_share = F.avg((F.col("log_sum") > math.log(high)).cast("double"))
        low_share = F.avg((F.col("log_sum") < math.log(low_used)).cast("double"))
    else:
        top, bottom = F.max("top"), F.min("bottom")
        high_share, low_share = F.sum("above") / total, F.sum("below") / total
    rows_n = F.count(F.lit(1))
    out = {
        "mean": F.sum("s") / total,
        "max": top,
        "min": bottom,
        "ratio_fraction_high": high_share,
        "ratio_fraction_low": low_share,
        "std": F.when(F.sum("n") > 1, F.sqrt(F.greatest(F.sum("c2") / total - mean_c * mean_c, F.lit(0.0)))).otherwise(0.0),
        "eff_sample_size": (mean_c + EPS) * (mean_c + EPS) * total / F.sum("c2"),
        "seq_mean": F.avg("mean_w"),
        "seq_std": F.when(rows_n > 1, F.stddev_samp("mean_w")).otherwise(0.0),
        "seq_max": F.max("mean_w"),
        "seq_min": F.min("mean_w"),
        "seq_max_deviation": F.max(F.abs(F.col("mean_w") - 1.0)),
        "seq_fraction_high": F.avg((F.col("mean_w") > high).cast("double")),
        "seq_fraction_low": F.avg((F.col("mean_w") < low_used).cast("double")),
    }
    if low is not None:
        out["oob_ratio"] = (F.sum("above") + F.sum("below")) / total
    return per_row.groupBy(*batch).agg(*[c.alias(f"rollout_is_{k}") for k, c in out.items()])


def _divergence(option: str) -> Column:
    """The divergence of one token that an option looks at."""
    x = clamp(F.col(LR), -BOUND, BOUND)
    return {"k1": -x, "k2": 0.5 * x * x, "k3": F.exp(x) - 1.0 - x}[option[-2:]]


def _statistic(option: str) -> Column:
    """The statistic of a trajectory that an option looks at, as an aggregate of its tokens."""
    on = F.when(F.col("mask") > 0, _divergence(option))
    total = F.coalesce(F.sum(on), F.lit(0.0))
    if option.startswith("seq_sum"):
        return total
    if option.startswith("seq_mean"):
        return total / (F.sum("mask") + EPS)
    return F.coalesce(F.max(on), F.lit(0.0))


def _kept(value: Column, low: float | None, high: float) -> Column:
    return value <= high if low is None else (value <= high) & (value >= low)


def rejection_limits(options: Mapping[str, str | float]) -> dict[str, tuple[float | None, float]]:
    """Bounds on the statistic; k1 options take a ratio pair and compare logarithms."""
    out = {}
    for name, spec in options.items():
        if name not in TOKEN_OPTIONS + SEQUENCE_OPTIONS:
            raise ValueError(f"unknown rejection option {name}")
        low, high = limits(spec)
        if name.endswith("k1"):
            out[name] = (math.log(1.0 / high if low is None else low), math.log(high))
        else:
            out[name] = (None, high)
    return out


def reject(df: DataFrame, options: Mapping[str, str | float], traj=("seq_id",)) -> DataFrame:
    """Attach ``stat_<option>`` and ``keep_<option>`` per option and the combined ``new_mask``."""
    bounds = rejection_limits(options)
    rows = with_log_ratio(df)
    whole = [_statistic(o).alias(f"stat_{o}") for o in bounds if o in SEQUENCE_OPTIONS]
    if whole:
        rows = with_stats(rows.drop(*[f"stat_{o}" for o in bounds]), traj, *whole)
    rows = rows.withColumns({f"stat_{o}": _divergence(o) for o in bounds if o in TOKEN_OPTIONS})
    keep = F.lit(True)
    for o, (low, high) in bounds.items():
        ok = _kept(F.col(f"stat_{o}"), low, high)
        rows = rows.withColumn(f"keep_{o}", ok)
        keep = keep & ok
    return rows.withColumn("new_mask", F.when(keep, F.col("mask")).otherwise(0))


def rs_metrics(df: DataFrame, options: Mapping[str, str | float], traj=("seq_id",), batch=("step",)) -> DataFrame:
    """Masked fractions and statistics for every option, one row per batch.

    The tokens are read once: a trajectory's own statistics count for all its tokens.
    """
    bounds = rejection_limits(options)
    mask, on = F.col("mask"), F.col("mask") > 0
    tokens_kept = F.lit(True)
    inner = [F.sum("mask").alias("n")]
    for o, (low, high) in bounds.items():
        if o in SEQUENCE_OPTIONS:
            inner.append(_statistic(o).alias(f"any_{o}"))
            continue
        s = _divergence(o)
        c = clamp(s, 0.0 if low is None else low, high)
        tokens_kept = tokens_kept & _kept(s, low, high)
        inner += [
            masked_sum(s, mask).alias(f"s_{o}"), masked_sum(c, mask).alias(f"c_{o}"), masked_sum(c * c, mask).alias(f"c2_{o}"),
            F.max(F.when(on, s)).alias(f"top_{o}"), F.min(F.when(on, s)).alias(f"bottom_{o}"),
            F.count(F.when(on & (s > high), 1)).alias(f"above_{o}"),
            F.count(F.when(on & (s < (0.0 if low is None else low)), 1)).alias(f"below_{o}"),
            F.count(F.when(on & ~_kept(s, low, high), 1)).alias(f"gone_{o}"),
        ]
    inner += [F.count(F.when(on, 1)).alias("on"), F.count(F.when(on & ~tokens_kept, 1)).alias("gone")]
    rows = with_log_ratio(df).groupBy(*batch, *traj).agg(*inner)
    whole_kept = F.lit(True)
    for o, (low, high) in bounds.items():
        if o in SEQUENCE_OPTIONS:
            s = F.col(f"any_{o}")
            c = clamp(s, 0.0 if low is None else low, high)
            whole_kept = whole_kept & _kept(s, low, high)
            rows = rows.withColumns({
                f"s_{o}": s * F.col("on"), f"c_{o}": c * F.col("on"), f"c2_{o}": c * c * F.col("on"),
                f"gone_{o}": F.when(_kept(s, low, high), 0).otherwise(F.col("on")),
            })
    per_row = rows.withColumn("gone", F.when(whole_kept, F.col("gone")).otherwise(F.col("on")))
    total, valid = F.sum("n") + EPS, F.col("n") > 0
    share = lambda cond: F.coalesce(F.avg(F.when(valid, cond.cast("double"))), F.lit(0.0))
    out = [
        (F.sum("gone") / total).alias("rollout_rs_masked_fraction"),
        F.avg((F.col("gone") > 0).cast("double")).alias("rollout_rs_seq_masked_fraction"),
    ]
    for o, (low, high) in bounds.items():
        seq = o in SEQUENCE_OPTIONS
        value = F.col(f"any_{o}") if seq else F.col(f"s_{o}") / (F.col("n") + EPS)
        v = F.when(valid, value)
        low_value = 0.0 if low is None else low
        mean_c = F.sum(f"c_{o}") / total
        cells = {
            "masked_fraction": F.sum(f"gone_{o}") / total,
            "seq_masked_fraction": share(F.col(f"gone_{o}") > 0),
            "mean": F.sum(f"s_{o}") / total,
            "max": F.max(v) if seq else F.max(f"top_{o}"),
            "min": F.min(v) if seq else F.min(f"bottom_{o}"),
            "fraction_high": share(value > high) if seq else F.sum(f"above_{o}") / total,
            "fraction_low": F.lit(0.0) if low is None else (share(value < low) if seq else F.sum(f"below_{o}") / total),
            "std": F.sqrt(F.greatest(F.sum(f"c2_{o}") / total - mean_c * mean_c, F.lit(0.0))),
            "seq_mean": F.coalesce(F.avg(v), F.lit(0.0)),
            "seq_std": F.coalesce(F.stddev_samp(v), F.lit(0.0)),
            "seq_max": F.coalesce(F.max(v), F.lit(0.0)),
            "seq_min": F.coalesce(F.min(v), F.lit(0.0)),
            "seq_max_deviation": F.coalesce(F.max(F.abs(v)), F.lit(0.0)),
            "seq_fraction_high": share(value > high),
        }
        if low is not None:
            cells["seq_fraction_low"] = share(value < low_value)
        out += [c.alias(f"rollout_rs_{o}_{k}") for k, c in cells.items()]
    return per_row.groupBy(*batch).agg(*out)


def offpolicy_metrics(df: DataFrame, traj=("seq_id",), batch=("step",)) -> DataFrame:
    """Perplexities of both policies, KL estimates, chi-square divergences."""
    m = F.col("mask")
    x = F.col(LR)
    rho = F.exp(2.0 * clamp(x, -BOUND, BOUND))
    per_row = with_log_ratio(df).groupBy(*batch, *traj).agg(
        F.sum("mask").alias("n"),
        masked_mean(F.col("old_lp"), m).alias("train"),
        masked_mean(F.col("rollout_lp"), m).alias("roll"),
        masked_sum(x, m).alias("x"),
        masked_sum(F.exp(x) - x - 1, m).alias("k3"),
        masked_sum(rho, m).alias("rho"),
    )
    total = F.sum("n") + EPS
    diff = F.col("roll") - F.col("train")
    out = {
        "training_ppl": F.avg(F.exp(-F.col("train"))),
        "training_log_ppl": F.avg(-F.col("train")),
        "kl": -F.sum("x") / total,
        "k3_kl": F.sum("k3") / total,
        "rollout_ppl": F.avg(F.exp(-F.col("roll"))),
        "rollout_log_ppl": F.avg(-F.col("roll")),
        "log_ppl_diff": F.avg(diff),
        "log_ppl_abs_diff": F.avg(F.abs(diff)),
        "log_ppl_diff_max": F.max(diff),
        "log_ppl_diff_min": F.min(diff),
        "ppl_ratio": F.avg(F.exp(diff)),
        "chi2_token": F.sum("rho") / total - 1.0,
        "chi2_seq": F.avg(F.exp(2.0 * clamp(F.col("x"), -BOUND, BOUND))) - 1.0,
    }
    return per_row.groupBy(*batch).agg(*[c.alias(k) for k, c in out.items()])


def apply_correction(
    df: DataFrame, level: str | None = "token", threshold: str | float = 2.0,
    options: Mapping[str, str | float] | None = None, normalise: bool = False,
) -> DataFrame:
    """Attach the weights, replace the mask; weights are computed with the mask before rejection."""
    rows = is_weights(df, level, threshold, normalise) if level else with_log_ratio(df)
    if options:
        rows = reject(rows, options).withColumn("mask", F.col("new_mask")).drop("new_mask")
    return rows


def correction_metrics(
    df: DataFrame, level: str | None = "token", threshold: str | float = 2.0,
    options: Mapping[str, str | float] | None = None, batch=("step",),
) -> DataFrame:
    """All correction metrics as ``(step, key, value)`` rows, keys prefixed ``rollout_corr/``."""
    parts = [offpolicy_metrics(df)]
    if level:
        parts.append(is_metrics(df, level, threshold))
    if options:
        parts.append(rs_metrics(df, options))
    out = None
    for part in parts:
        names = [c for c in part.columns if c not in batch]
        pairs = F.array(*[F.struct(F.lit(f"rollout_corr/{c}").alias("key"), F.col(c).cast("double").alias("value")) for c in names])
        rows = part.select(*batch, F.inline(pairs))
        out = rows if out is None else out.unionByName(rows)
    return out


def bypass(df: DataFrame) -> DataFrame:
    """Use the rollout log-probabilities as the old ones; they must be there."""
    if "rollout_lp" not in df.columns:
        raise ValueError("bypass mode needs rollout_lp")
    checked = F.when(F.col("rollout_lp").isNull(), F.raise_error(F.lit("rollout_lp is missing")).cast("double"))
    return df.withColumn("old_lp", checked.otherwise(F.col("rollout_lp")))
