"""Objective audit on logged tokens: forward values and clip statistics, no gradients."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.functions.divergence import clamp
from trajtable.operators.masked import EPS, masked_mean, masked_sum
from trajtable.plans.skew import largest, with_stats

MODES = ("token-mean", "seq-mean-token-sum", "seq-mean-token-sum-norm", "seq-mean-token-mean")


def lp() -> Column:
    return F.col("cur_lp")


def old_lp() -> Column:
    return F.col("old_lp")


def adv() -> Column:
    return F.col("adv")


def mask() -> Column:
    return F.col("mask")


def reduce_audit(
    df: DataFrame, loss: Column | None, shares: Mapping[str, Column], mode: str = "token-mean",
    horizon: int = 64, traj=("seq_id",), batch=("step",), name: str = "pg_loss",
) -> DataFrame:
    """Aggregate a loss column by ``mode`` and every other column as masked token mean."""
    if mode not in MODES:
        raise ValueError(f"unknown aggregation {mode}")
    inner = [F.sum("mask").alias("_n")]
    if loss is not None:
        inner.append(masked_sum(loss, mask()).alias("_loss"))
    inner += [masked_sum(c.cast("double"), mask()).alias(k) for k, c in shares.items()]
    per_row = df.groupBy(*batch, *traj).agg(*inner)
    on = F.col("_n") > 0
    if mode == "token-mean":
        value = F.sum("_loss") / F.sum("_n")
    elif mode == "seq-mean-token-mean":
        value = F.avg(F.when(on, F.col("_loss") / (F.col("_n") + EPS)))
    else:
        value = F.avg(F.when(on, F.col("_loss")))
        value = value / horizon if mode.endswith("norm") else value
    out = [value.alias(name)] if loss is not None else []
    out += [(F.sum(k) / (F.sum("_n") + EPS)).alias(k) for k in shares]
    return per_row.groupBy(*batch).agg(*out)


def _log_ratio(bounded: bool = True) -> Column:
    return clamp(lp() - old_lp(), -20, 20) if bounded else lp() - old_lp()


def clip_terms(new: Column, old: Column, a: Column, low: float, high: float, c: float):
    """Loss of the clipped surrogate per token and its clip and KL columns."""
    if c <= 1:
        raise ValueError("the dual clip must be above 1")
    x = clamp(new - old, -20, 20)
    ratio = F.exp(x)
    free, clipped = -a * ratio, -a * clamp(ratio, 1 - low, 1 + high)
    first, bound = F.greatest(free, clipped), -a * c
    loss = F.when(a < 0, F.least(bound, first)).otherwise(first)
    return loss, {"clipfrac": clipped > free, "kl": -x, "clipfrac_lower": (first > bound) & (a < 0)}


def ppo(df: DataFrame, low: float = 0.2, high: float = 0.2, c: float = 3.0, weight: str | None = None, mode="token-mean"):
    """Clipped surrogate with a dual clip for negative advantages."""
    loss, shares = clip_terms(lp(), old_lp(), adv(), low, high, c)
    return reduce_audit(df, loss * F.col(weight) if weight else loss, shares, mode)


def dppo(df: DataFrame, kind: str = "tv", low: float = 0.2, high: float = 0.2, c: float = 20.0, mode="token-mean"):
    """Tokens count only while the probability moved less than the limit (difference or binary KL)."""
    x = _log_ratio()
    ratio, p, q = F.exp(x), F.exp(lp()), F.exp(old_lp())
    if kind == "tv":
        up, down = (p - q) <= high, (p - q) >= -low
    else:
        binary = q * (old_lp() - lp()) + (1 - q) * F.log((1.0 - q + 1e-8) / (1.0 - p + 1e-8))
        up, down = (binary <= high) | (p <= q), (binary <= low) | (p >= q)
    valid = F.when(adv() > 0, up).otherwise(down)
    loss = -adv() * F.least(ratio, F.lit(c)) * lp() * valid.cast("double")
    return reduce_audit(df, loss, {"clipfrac": ~valid, "kl": -x, "clipfrac_lower": (ratio > c) & valid}, mode)


def gspo(df: DataFrame, low: float = 0.2, high: float = 0.2, traj=("seq_id",)):
    """One ratio per trajectory: exp of the mean log ratio, at most exp(10)."""
    x = _log_ratio(False)
    rows = with_stats(df, traj, (F.sum(x * mask()) / F.greatest(F.sum("mask"), F.lit(1))).alias("_x"))
    ratio = F.exp(F.least(F.col("_x"), F.lit(10.0)))
    free, clipped = -adv() * ratio, -adv() * clamp(ratio, 1 - low, 1 + high)
    shares = {"clipfrac": clipped > free, "kl": -x}
    return reduce_audit(rows, F.greatest(free, clipped), shares, "seq-mean-token-mean")


def sapo(df: DataFrame, tau_pos: float = 1.0, tau_neg: float = 1.05):
    """Sigmoid gate around ratio 1, temperature by the sign of the advantage."""
    x = _log_ratio()
    tau = F.when(adv() > 0, tau_pos).otherwise(tau_neg)
    gate = 4.0 / tau / (1 + F.exp(-tau * (F.exp(x) - 1.0)))
    return reduce_audit(df, -gate * adv(), {"kl": -x}, "seq-mean-token-mean")


def gpg(df: DataFrame, weight: str | None = None, mode="token-mean"):
    loss = -lp() * adv()
    return reduce_audit(df, loss * F.col(weight) if weight else loss, {}, mode)


def reinforce(df: DataFrame, weight: str | None = None, mode="token-mean"):
    loss = -lp() * adv()
    return reduce_audit(df, loss * F.col(weight) if weight else loss, {"kl": -_log_ratio(False)}, mode)


def _covariance(df: DataFrame, batch) -> DataFrame:
    rows = with_stats(
        df, batch, masked_mean(adv(), mask()).alias("_a"), masked_mean(lp(), mask()).alias("_l"), F.sum("mask").alias("_n")
    )
    # rounding keeps the ranking independent of the order in which means were summed
    return rows.withColumn("_cov", F.round((adv() - F.col("_a")) * (lp() - F.col("_l")), 9))


def clip_cov(
    df: DataFrame, ratio: float = 0.0002, lb: float = 1.0, ub: float = 5.0, low: float = 0.2, high: float = 0.2,
    seed: int = 42, batch=("step",), traj=("seq_id",), t: str = "t", mode="token-mean",
):
    """Zero a seeded random set of max(int(ratio * tokens), 1) tokens whose covariance lies in (lb, ub).

    The draw orders candidates by the md5 of seed and token key.
    """
    x = _log_ratio(False)
    r = F.exp(x)
    free, clipped = -adv() * r, -adv() * clamp(r, 1 - low, 1 + high)
    rows = _covariance(df, batch)
    eligible = (mask() > 0) & ~(clipped > free) & (F.col("_cov") > lb) & (F.col("_cov") < ub)
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *traj, t))
    # the smallest draws: their first 52 bits as a number, then the text
    number = -F.conv(F.substring("_draw", 1, 13), 16, 10).cast("double")
    candidates = rows.where(eligible).select(*batch, *traj, t, "_n", draw.alias("_draw")).withColumn("_number", number)
    chosen = largest(candidates, batch, "_number", F.greatest(F.floor(F.max("_n") * ratio), F.lit(1)), [F.col("_draw")])
    marked = rows.join(chosen.select(*batch, *traj, t, F.lit(0.0).alias("_zero")), [*batch, *traj, t], "left")
    factor = F.coalesce(F.col("_zero"), F.lit(1.0))
    shares = {"clipfrac": factor == 0, "kl": -x}
    return reduce_audit(marked, F.greatest(free, clipped) * factor, shares, mode, traj=traj, batch=batch)


def kl_cov(
    df: DataFrame, ratio: float = 0.0002, coef: float = 1.0, batch=("step",), traj=("seq_id",), t: str = "t", mode="token-mean",
):
    """The share of valid tokens with the largest covariance gets coef * abs(log ratio) on top."""
    x = _log_ratio(False)
    rows = _covariance(df, batch)
    valid = rows.where(mask() > 0).select(*batch, *traj, t, "_n", "_cov")
    top = largest(valid, batch, "_cov", F.greatest(F.floor(F.max("_n") * ratio), F.lit(1)), [*map(F.col, traj), F.col(t)])
    marked = rows.join(top.select(*batch, *traj, t, F.lit(1.0).alias("_big")), [*batch, *traj, t], "left")
    loss = -adv() * F.exp(x) + F.coalesce(F.col("_big"), F.lit(0.0)) * coef * F.abs(x)
    return reduce_audit(marked, loss, {"kl": F.abs(x)}, mode, traj=traj, batch=batch)


def geo_mean(df: DataFrame, low: float = 0.2, high: float = 0.2, traj=("seq_id",), batch=("step",)):
    """Geometric-mean ratio per trajectory, clipped in log space on the side the advantage favours."""
    x = _log_ratio(False)
    clipped = clamp(x, -low, high)
    sign = F.signum(adv())
    part = sign * F.least(sign * x, sign * clipped)
    outside = x != clipped
    n = F.sum("mask")
    per_row = df.groupBy(*batch, *traj).agg(
        n.alias("n"),
        F.exp(masked_sum(part, mask()) / (n + EPS)).alias("ratio"),
        (masked_sum(adv(), mask()) / (n + EPS)).alias("a"),
        masked_sum(-x, mask()).alias("kl"),
        masked_sum((outside & (adv() > 0)).cast("double"), mask()).alias("hi"),
        masked_sum((outside & (adv() < 0)).cast("double"), mask()).alias("lo"),
    )
    total = F.sum("n") + EPS
    return per_row.groupBy(*batch).agg(
        F.avg(-F.col("a") * F.col("ratio")).alias("pg_loss"),
        (F.sum("hi") / total).alias("clipfrac"),
        (F.sum("kl") / total).alias("kl"),
        (F.sum("lo") / total).alias("clipfrac_lower"),
    )


def cispo(df: DataFrame, low: float = 0.2, high: float = 0.2, mode="token-mean"):
    x = _log_ratio()
    ratio = F.exp(x)
    clipped = clamp(ratio, 1 - low, 1 + high)
    return reduce_audit(df, -clipped * adv() * lp(), {"clipfrac": ratio != clipped, "kl": -x}, mode)


def value_loss(df: DataFrame, clip: float = 0.5, mode="token-mean"):
    """Half the larger of the free and the clipped squared error."""
    v, ret, old = F.col("vpred"), F.col("returns"), F.col("value")
    near = F.greatest(F.least(v, old + clip), old - clip)
    free, held = (v - ret) * (v - ret), (near - ret) * (near - ret)
    return reduce_audit(df, 0.5 * F.greatest(free, held), {"clipfrac": held > free}, mode, name="vf_loss")


def entropy_loss(df: DataFrame, mode="token-mean"):
    return reduce_audit(df, F.col("entropy"), {}, mode, name="entropy_loss")
