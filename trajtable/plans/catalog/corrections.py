"""Off-policy correction and objective audit."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from trajtable.functions import divergence as dv
from trajtable.operators import audit, masked
from trajtable.operators import correction as corr
from trajtable.plans.catalog.base import query, r6
from trajtable.sources import tables as src

T = ("tokens",)


def rounded(df, *keep):
    return df.select(*[F.col(c) if c in keep else r6(c).alias(c) for c in df.columns])


def _cells(pairs: dict[str, str]) -> str:
    return ", ".join(f"round(({v})::DOUBLE, 6) + 0.0 AS {k}" for k, v in pairs.items())


# --- masked reducers -----------------------------------------------------------------------------


@query("masked_sum", "SELECT step, round(sum(reward * mask), 6) + 0.0 AS total FROM tokens GROUP BY step", T)
def masked_sum(spark, d):
    return src.tokens(spark, d).groupBy("step").agg(r6(masked.masked_sum(F.col("reward"), F.col("mask"))).alias("total"))


@query("masked_mean", "SELECT step, seq_id, round(sum(value * mask) / (sum(mask) + 1e-8), 6) + 0.0 AS mean FROM tokens GROUP BY step, seq_id", T)
def masked_mean(spark, d):
    return src.tokens(spark, d).groupBy("step", "seq_id").agg(r6(masked.masked_mean(F.col("value"), F.col("mask"))).alias("mean"))


WHITE = """b AS (SELECT step, sum(mask)::DOUBLE AS n, sum(value * mask) / (sum(mask) + 1e-8) AS m FROM tokens GROUP BY step),
v AS (SELECT step, max(n) AS n, max(m) AS m, sum((value - m) ** 2 * mask) / (max(n) + 1e-8) * max(n) / (max(n) - 1) AS var
      FROM tokens JOIN b USING (step) GROUP BY step)"""


@query("masked_var", f"WITH {WHITE} SELECT step, n, round(m, 6) + 0.0 AS mean, round(var, 6) + 0.0 AS var FROM v", T)
def masked_var(spark, d):
    df = masked.masked_variance(src.tokens(spark, d), F.col("value"), F.col("mask"), ["step"])
    return rounded(df, "step", "n")


@query(
    "masked_whiten",
    f"""WITH {WHITE} SELECT step, seq_id, t, round((value - m) / sqrt(var + 1e-8), 6) + 0.0 AS white,
  round((value - m) / sqrt(var + 1e-8) + m, 6) + 0.0 AS white_keep_mean FROM tokens JOIN v USING (step)""",
    T,
)
def masked_whiten(spark, d):
    df = masked.whiten(src.tokens(spark, d), "value", F.col("mask"), ["step"], "white")
    df = masked.whiten(df, "value", F.col("mask"), ["step"], "white_keep_mean", shift_mean=False)
    return df.select("step", "seq_id", "t", r6("white").alias("white"), r6("white_keep_mean").alias("white_keep_mean"))


# --- correction ----------------------------------------------------------------------------------

LR = "k AS (SELECT *, old_lp - rollout_lp AS lr FROM tokens)"
SEQ = LR + ", s AS (SELECT *, sum(lr * mask) OVER (PARTITION BY seq_id) AS ls FROM k)"


@query(
    "corr_is_token",
    f"""WITH {LR}, w AS (SELECT *, least(exp(greatest(least(lr, 20), -20)) * mask, 1.5) AS w,
  CASE WHEN exp(lr) * mask >= 0.7 AND exp(lr) * mask <= 1.5 THEN exp(lr) * mask ELSE 0.0 END AS z FROM k),
m AS (SELECT step, sum(w * mask) / (sum(mask) + 1e-8) AS m FROM w GROUP BY step)
SELECT step, seq_id, t, round(w, 6) + 0.0 AS weight, round(z, 6) + 0.0 AS weight_pair, round(w / m, 6) + 0.0 AS weight_norm
FROM w JOIN m USING (step)""",
    T,
)
def corr_is_token(spark, d):
    rows = corr.is_weights(src.tokens(spark, d), "token", 1.5, out="weight")
    rows = corr.is_weights(rows, "token", "0.7_1.5", out="weight_pair")
    rows = corr.is_weights(rows, "token", 1.5, normalise=True, out="weight_norm")
    return rounded(rows.select("step", "seq_id", "t", "weight", "weight_pair", "weight_norm"), "step", "seq_id", "t")


@query(
    "corr_is_sequence",
    f"""WITH {SEQ}, w AS (SELECT *, least(exp(greatest(least(ls, 20), -20)) * mask, 3.0) AS w FROM s),
r AS (SELECT step, seq_id, sum(w * mask) / (sum(mask) + 1e-8) AS m, sum(mask) > 0 AS ok FROM w GROUP BY step, seq_id),
m AS (SELECT step, sum(m) FILTER (WHERE ok) / count(*) FILTER (WHERE ok) AS m FROM r GROUP BY step)
SELECT step, seq_id, t, round(w, 6) + 0.0 AS weight, round(w / m, 6) + 0.0 AS weight_norm FROM w JOIN m USING (step)""",
    T,
)
def corr_is_sequence(spark, d):
    rows = corr.is_weights(src.tokens(spark, d), "sequence", 3.0, out="weight")
    rows = corr.is_weights(rows, "sequence", 3.0, normalise=True, out="weight_norm")
    return rounded(rows.select("step", "seq_id", "t", "weight", "weight_norm"), "step", "seq_id", "t")


OPTIONS = {
    "token_k1": "0.6_1.7", "token_k2": 0.12, "token_k3": 0.2, "seq_sum_k1": "0.02_40", "seq_sum_k2": 4.0,
    "seq_sum_k3": 4.5, "seq_mean_k1": "0.93_1.08", "seq_mean_k2": 0.085, "seq_mean_k3": 0.09, "seq_max_k2": 0.23,
    "seq_max_k3": 0.28,
}
_KEEP = {}
for _o, _spec in OPTIONS.items():
    if _o.endswith("k1"):
        _a, _b = (math.log(float(p)) for p in str(_spec).split("_"))
        _KEEP[_o] = (f"({_o} >= {_a!r} AND {_o} <= {_b!r})", _a, _b)
    else:
        _KEEP[_o] = (f"({_o} <= {float(_spec)!r})", None, float(_spec))

STATS = """k0 AS (SELECT *, greatest(least(old_lp - rollout_lp, 20), -20) AS x FROM tokens),
k AS (SELECT *, -x AS token_k1, 0.5 * x * x AS token_k2, exp(x) - 1 - x AS token_k3 FROM k0),
s AS (SELECT *, sum(mask) OVER q AS len, coalesce(sum(token_k1) FILTER (WHERE mask > 0) OVER q, 0) AS seq_sum_k1,
  coalesce(sum(token_k2) FILTER (WHERE mask > 0) OVER q, 0) AS seq_sum_k2,
  coalesce(sum(token_k3) FILTER (WHERE mask > 0) OVER q, 0) AS seq_sum_k3,
  coalesce(max(token_k2) FILTER (WHERE mask > 0) OVER q, 0) AS seq_max_k2,
  coalesce(max(token_k3) FILTER (WHERE mask > 0) OVER q, 0) AS seq_max_k3
  FROM k WINDOW q AS (PARTITION BY seq_id)),
st AS (SELECT *, seq_sum_k1 / (len + 1e-8) AS seq_mean_k1, seq_sum_k2 / (len + 1e-8) AS seq_mean_k2,
  seq_sum_k3 / (len + 1e-8) AS seq_mean_k3 FROM s)"""
_ALL = " AND ".join(v[0] for v in _KEEP.values())


@query(
    "corr_reject_mask",
    f"WITH {STATS} SELECT step, seq_id, t, CASE WHEN {_ALL} THEN mask ELSE 0 END AS new_mask, "
    + ", ".join(f"{v[0]} AS keep_{o}" for o, v in _KEEP.items())
    + " FROM st",
    T,
)
def corr_reject_mask(spark, d):
    rows = corr.reject(src.tokens(spark, d), OPTIONS)
    return rows.select("step", "seq_id", "t", "new_mask", *[f"keep_{o}" for o in OPTIONS])


def _rs_sql() -> str:
    per, out = [], {}
    n = "(sum(n) + 1e-8)"
    out["rollout_rs_masked_fraction"] = f"sum(gone) / {n}"
    out["rollout_rs_seq_masked_fraction"] = "avg(CASE WHEN gone > 0 THEN 1.0 ELSE 0.0 END)"
    for o, (keep, low, high) in _KEEP.items():
        lo = 0.0 if low is None else low
        c = f"greatest(least({o}, {high!r}), {lo!r})"
        per.append(
            f"sum({o}) FILTER (WHERE mask > 0) AS s_{o}, sum({c}) FILTER (WHERE mask > 0) AS c_{o}, "
            f"sum({c} * {c}) FILTER (WHERE mask > 0) AS d_{o}, max({o}) FILTER (WHERE mask > 0) AS x_{o}, "
            f"min({o}) FILTER (WHERE mask > 0) AS m_{o}, any_value({o}) AS a_{o}, "
            f"count(*) FILTER (WHERE mask > 0 AND {o} > {high!r}) AS h_{o}, count(*) FILTER (WHERE mask > 0 AND {o} < {lo!r}) AS l_{o}, "
            f"count(*) FILTER (WHERE mask > 0 AND NOT {keep}) AS g_{o}"
        )
        seq = o.startswith("seq")
        v = f"a_{o}" if seq else f"s_{o} / (n + 1e-8)"
        fil = "FILTER (WHERE n > 0)"
        p = f"rollout_rs_{o}_"
        out[p + "masked_fraction"] = f"sum(g_{o}) / {n}"
        out[p + "seq_masked_fraction"] = f"avg(CASE WHEN g_{o} > 0 THEN 1.0 ELSE 0.0 END) {fil}"
        out[p + "mean"] = f"sum(s_{o}) / {n}"
        out[p + "max"] = f"max({v}) {fil}" if seq else f"max(x_{o})"
        out[p + "min"] = f"min({v}) {fil}" if seq else f"min(m_{o})"
        out[p + "fraction_high"] = f"avg(CASE WHEN {v} > {high!r} THEN 1.0 ELSE 0.0 END) {fil}" if seq else f"sum(h_{o}) / {n}"
        out[p + "fraction_low"] = (
            "0.0::DOUBLE" if low is None else f"avg(CASE WHEN {v} < {low!r} THEN 1.0 ELSE 0.0 END) {fil}" if seq else f"sum(l_{o}) / {n}"
        )
        out[p + "std"] = f"sqrt(greatest(sum(d_{o}) / {n} - (sum(c_{o}) / {n}) ** 2, 0))"
        out[p + "seq_mean"] = f"avg({v}) {fil}"
        out[p + "seq_std"] = f"stddev_samp({v}) {fil}"
        out[p + "seq_max"] = f"max({v}) {fil}"
        out[p + "seq_min"] = f"min({v}) {fil}"
        out[p + "seq_max_deviation"] = f"max(abs({v})) {fil}"
        out[p + "seq_fraction_high"] = f"avg(CASE WHEN {v} > {high!r} THEN 1.0 ELSE 0.0 END) {fil}"
        if low is not None:
            out[p + "seq_fraction_low"] = f"avg(CASE WHEN {v} < {low!r} THEN 1.0 ELSE 0.0 END) {fil}"
    return f"""WITH {STATS}, r AS (SELECT step, seq_id, sum(mask) AS n,
  count(*) FILTER (WHERE mask > 0 AND NOT ({_ALL})) AS gone, {", ".join(per)} FROM st GROUP BY step, seq_id)
SELECT step, {_cells(out)} FROM r GROUP BY step"""


@query("corr_rs_metrics", _rs_sql(), T)
def corr_rs_metrics(spark, d):
    return rounded(corr.rs_metrics(src.tokens(spark, d), OPTIONS), "step")


IS_OUT = {
    "rollout_is_mean": "sum(s) / (sum(n) + 1e-8)",
    "rollout_is_std": "sqrt(greatest(sum(c2) / (sum(n) + 1e-8) - (sum(c) / (sum(n) + 1e-8)) ** 2, 0))",
    "rollout_is_eff_sample_size": "(sum(c) / (sum(n) + 1e-8) + 1e-8) ** 2 * (sum(n) + 1e-8) / sum(c2)",
    "rollout_is_seq_mean": "avg(s / (n + 1e-8))",
    "rollout_is_seq_std": "stddev_samp(s / (n + 1e-8))",
    "rollout_is_seq_max": "max(s / (n + 1e-8))",
    "rollout_is_seq_min": "min(s / (n + 1e-8))",
    "rollout_is_seq_max_deviation": "max(abs(s / (n + 1e-8) - 1))",
}


def _is_sql(level: str, low: float | None, high: float) -> str:
    e = "lr" if level == "token" else "ls"
    raw = f"exp(greatest(least({e}, 20), -20)) * mask"
    w = f"least({raw}, {high})" if low is None else f"CASE WHEN {raw} >= {low} AND {raw} <= {high} THEN {raw} ELSE 0 END"
    lo = 1 / high if low is None else low
    out = dict(IS_OUT)
    out["rollout_is_seq_fraction_high"] = f"avg(CASE WHEN s / (n + 1e-8) > {high} THEN 1.0 ELSE 0.0 END)"
    out["rollout_is_seq_fraction_low"] = f"avg(CASE WHEN s / (n + 1e-8) < {lo!r} THEN 1.0 ELSE 0.0 END)"
    if level == "token":
        out |= {"rollout_is_max": "max(hi)", "rollout_is_min": "min(lo)", "rollout_is_ratio_fraction_high": "sum(above) / (sum(n) + 1e-8)",
                "rollout_is_ratio_fraction_low": "sum(below) / (sum(n) + 1e-8)"}
    else:
        out |= {"rollout_is_max": "exp(least(max(ls), 20))", "rollout_is_min": "exp(min(ls))",
                "rollout_is_ratio_fraction_high": f"avg(CASE WHEN ls > ln({high}) THEN 1.0 ELSE 0.0 END)",
                "rollout_is_ratio_fraction_low": f"avg(CASE WHEN ls < ln({lo!r}) THEN 1.0 ELSE 0.0 END)"}
    if low is not None:
        out["rollout_is_oob_ratio"] = "(sum(above) + sum(below)) / (sum(n) + 1e-8)"
    return f"""WITH {SEQ}, w AS (SELECT *, {raw} AS raw, {w} AS w FROM s),
r AS (SELECT step, seq_id, sum(mask) AS n, sum(w * mask) AS s, sum(least(w, {high}) * mask) AS c,
  sum(least(w, {high}) ** 2 * mask) AS c2, max(w) FILTER (WHERE mask > 0) AS hi, min(w) FILTER (WHERE mask > 0) AS lo,
  count(*) FILTER (WHERE mask > 0 AND raw > {high}) AS above, count(*) FILTER (WHERE mask > 0 AND raw < {lo!r}) AS below,
  any_value(ls) AS ls FROM w GROUP BY step, seq_id)
SELECT step, {_cells(out)} FROM r GROUP BY step"""


@query("corr_is_metrics", _is_sql("token", 0.7, 1.5), T)
def corr_is_metrics(spark, d):
    return rounded(corr.is_metrics(src.tokens(spark, d), "token", "0.7_1.5"), "step")


@query("corr_is_metrics_sequence", _is_sql("sequence", None, 3.0), T)
def corr_is_metrics_sequence(spark, d):
    return rounded(corr.is_metrics(src.tokens(spark, d), "sequence", 3.0), "step")


@query(
    "corr_offpolicy_metrics",
    f"""WITH {LR}, r AS (SELECT step, seq_id, sum(mask) AS n, sum(old_lp * mask) / (sum(mask) + 1e-8) AS a,
  sum(rollout_lp * mask) / (sum(mask) + 1e-8) AS b, sum(lr * mask) AS x, sum((exp(lr) - lr - 1) * mask) AS k3,
  sum(exp(lr) ** 2 * mask) AS rho FROM k GROUP BY step, seq_id)
SELECT step, """
    + _cells(
        {
            "training_ppl": "avg(exp(-a))", "training_log_ppl": "avg(-a)", "kl": "-sum(x) / (sum(n) + 1e-8)",
            "k3_kl": "sum(k3) / (sum(n) + 1e-8)", "rollout_ppl": "avg(exp(-b))", "rollout_log_ppl": "avg(-b)",
            "log_ppl_diff": "avg(b - a)", "log_ppl_abs_diff": "avg(abs(b - a))", "log_ppl_diff_max": "max(b - a)",
            "log_ppl_diff_min": "min(b - a)", "ppl_ratio": "avg(exp(b - a))", "chi2_token": "sum(rho) / (sum(n) + 1e-8) - 1",
            "chi2_seq": "avg(exp(2 * greatest(least(x, 20), -20))) - 1",
        }
    )
    + " FROM r GROUP BY step",
    T,
)
def corr_offpolicy_metrics(spark, d):
    return rounded(corr.offpolicy_metrics(src.tokens(spark, d)), "step")


@query(
    "corr_apply",
    f"""WITH {STATS} SELECT step, seq_id, t, round(least(exp(x) * mask, 1.5), 6) + 0.0 AS is_weight,
  CASE WHEN token_k2 <= 0.12 AND seq_mean_k3 <= 0.09 THEN mask ELSE 0 END AS mask FROM st""",
    T,
)
def corr_apply(spark, d):
    rows = corr.apply_correction(src.tokens(spark, d), "token", 1.5, {"token_k2": 0.12, "seq_mean_k3": 0.09})
    return rows.select("step", "seq_id", "t", r6("is_weight").alias("is_weight"), "mask")


@query("corr_bypass", "SELECT seq_id, t, round(rollout_lp, 6) + 0.0 AS old_lp, 0.0::DOUBLE AS log_ratio FROM tokens", T)
def corr_bypass(spark, d):
    rows = corr.with_log_ratio(corr.bypass(src.tokens(spark, d)))
    return rows.select("seq_id", "t", r6("old_lp").alias("old_lp"), r6("log_ratio").alias("log_ratio"))


# --- log-probability expressions -----------------------------------------------------------------


@query(
    "kl_estimator",
    """SELECT seq_id, t, round(old_lp - ref_lp, 6) + 0.0 AS k1, round(abs(old_lp - ref_lp), 6) + 0.0 AS abs_kl,
  round(0.5 * (old_lp - ref_lp) ** 2, 6) + 0.0 AS k2, round(least(exp(ref_lp - old_lp) - (ref_lp - old_lp) - 1, 10), 6) + 0.0 AS k3,
  round(least(exp(ref_lp - old_lp) - (ref_lp - old_lp) - 1, 10), 6) + 0.0 AS k3_plus FROM tokens""",
    T,
)
def kl_estimator(spark, d):
    a, b = F.col("old_lp"), F.col("ref_lp")
    kinds = {"k1": "k1", "abs_kl": "abs", "k2": "mse", "k3": "low_var_kl", "k3_plus": "k3+"}
    return src.tokens(spark, d).select("seq_id", "t", *[r6(dv.kl(k, a, b)).alias(n) for n, k in kinds.items()])


@query("policy_ratio", "SELECT seq_id, t, round(exp(greatest(least(cur_lp - old_lp, 20), -20)), 6) + 0.0 AS ratio FROM tokens", T)
def policy_ratio(spark, d):
    return src.tokens(spark, d).select("seq_id", "t", r6(dv.policy_ratio(F.col("cur_lp"), F.col("old_lp"))).alias("ratio"))


LOGITS = """e AS (SELECT vec_id, generate_subscripts(student, 1) AS i, unnest(student) AS x FROM logits),
z AS (SELECT vec_id, max(x) AS top, ln(sum(exp(x))) AS lse FROM e GROUP BY vec_id)"""


@query(
    "entropy_logits",
    f"WITH {LOGITS} SELECT vec_id, round(max(lse) - sum(exp(x - lse) * x), 6) + 0.0 AS entropy FROM e JOIN z USING (vec_id) GROUP BY vec_id",
    ("logits",),
)
def entropy_logits(spark, d):
    return src.logits(spark, d).select("vec_id", r6(dv.entropy(F.col("student"))).alias("entropy"))


@query(
    "sum_pi_squared",
    f"WITH {LOGITS} SELECT vec_id, round(sum(exp(x - lse) ** 2), 6) + 0.0 AS sum_pi2 FROM e JOIN z USING (vec_id) GROUP BY vec_id",
    ("logits",),
)
def sum_pi_squared(spark, d):
    return src.logits(spark, d).select("vec_id", r6(dv.sum_pi_squared(F.col("student"))).alias("sum_pi2"))


@query(
    "log_softmax",
    f"WITH {LOGITS} SELECT vec_id, (i - 1)::INT AS token_id, round(x - lse, 6) + 0.0 AS lp FROM e JOIN z USING (vec_id)",
    ("logits",),
)
def log_softmax(spark, d):
    rows = src.logits(spark, d).select("vec_id", F.posexplode(dv.log_softmax(F.col("student"))).alias("token_id", "lp"))
    return rows.select("vec_id", "token_id", r6("lp").alias("lp"))


@query(
    "kl_topk_support",
    """WITH e AS (SELECT vec_id, unnest(student) AS s, unnest(teacher) AS q FROM logits),
z AS (SELECT vec_id, ln(sum(exp(s))) AS zs, ln(sum(exp(q))) AS zq FROM e GROUP BY vec_id)
SELECT vec_id, round(sum(CASE WHEN exp(q - zq) >= 0.01 THEN exp(q - zq) * ((q - zq) - (s - zs)) ELSE 0 END), 6) + 0.0 AS kl
FROM e JOIN z USING (vec_id) GROUP BY vec_id""",
    ("logits",),
)
def kl_topk_support(spark, d):
    """Probabilities below one percent are cut to zero, so they leave the support."""
    rows = src.logits(spark, d).select("vec_id", dv.log_softmax(F.col("teacher")).alias("lp"), dv.log_softmax(F.col("student")).alias("lq"))
    p = F.transform("lp", lambda v: F.when(F.exp(v) >= 0.01, F.exp(v)).otherwise(F.lit(0.0)))
    return rows.select("vec_id", r6(dv.kl_on_support(p, F.col("lp"), F.col("lq"))).alias("kl"))


@query("seq_workload", "SELECT uid, line, problem_id, resp_len, (24576 * (prompt_len + resp_len) + (prompt_len + resp_len) ** 2)::BIGINT AS workload FROM rollouts", ("rollouts",))
def seq_workload(spark, d):
    from trajtable.operators.packing import workload

    return src.rollouts(spark, d).select(
        "uid", "line", "problem_id", "resp_len", workload(F.col("prompt_len") + F.col("resp_len")).alias("workload")
    )


# --- objective audit -----------------------------------------------------------------------------

A = "a AS (SELECT *, greatest(least(cur_lp - old_lp, 20), -20) AS x, exp(greatest(least(cur_lp - old_lp, 20), -20)) AS r FROM tokens)"
TOKEN = {"pg_loss": "sum(loss * mask) / sum(mask)"}


def _share(expr: str) -> str:
    return f"sum({expr} * mask) / (sum(mask) + 1e-8)"


def _flag(cond: str) -> str:
    return _share(f"(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END)")


def _audit(cols: str, out: dict[str, str], extra: str = "", base: str = "a") -> str:
    return f"WITH {A}{extra}, l AS (SELECT *, {cols} FROM {base}) SELECT step, {_cells(out)} FROM l GROUP BY step"


@query(
    "loss_agg",
    """WITH s AS (SELECT step, seq_id, sum(entropy * mask) AS s, sum(mask) AS n FROM tokens GROUP BY step, seq_id)
SELECT step, """
    + _cells({
        "token_mean": "sum(s) / sum(n)", "seq_sum": "sum(s) FILTER (WHERE n > 0) / count(*) FILTER (WHERE n > 0)",
        "seq_sum_norm": "sum(s) FILTER (WHERE n > 0) / count(*) FILTER (WHERE n > 0) / 64",
        "seq_mean": "sum(s / (n + 1e-8)) FILTER (WHERE n > 0) / count(*) FILTER (WHERE n > 0)",
    })
    + " FROM s GROUP BY step",
    T,
)
def loss_agg(spark, d):
    out = None
    for name, mode in zip(("token_mean", "seq_sum", "seq_sum_norm", "seq_mean"), audit.MODES):
        part = audit.reduce_audit(src.tokens(spark, d), F.col("entropy"), {}, mode, name=name)
        out = part if out is None else out.join(part, "step")
    return rounded(out, "step")


PPO_COLS = """-adv * r AS l1, -adv * greatest(least(r, 1.2), 0.8) AS l2, -adv * 3 AS l3,
  CASE WHEN adv < 0 THEN least(-adv * 3, greatest(-adv * r, -adv * greatest(least(r, 1.2), 0.8)))
       ELSE greatest(-adv * r, -adv * greatest(least(r, 1.2), 0.8)) END AS loss"""
PPO_OUT = TOKEN | {"clipfrac": _flag("l2 > l1"), "kl": _share("-x"), "clipfrac_lower": _flag("greatest(l1, l2) > l3 AND adv < 0")}


@query("audit_ppo", _audit(PPO_COLS, PPO_OUT), T)
def audit_ppo(spark, d):
    return rounded(audit.ppo(src.tokens(spark, d)), "step")


def _dppo(up: str, down: str) -> str:
    cols = f"CASE WHEN adv > 0 THEN {up} ELSE {down} END AS ok, -adv * least(r, 1.1) * cur_lp * CASE WHEN (CASE WHEN adv > 0 THEN {up} ELSE {down} END) THEN 1 ELSE 0 END AS loss"
    return _audit(cols, TOKEN | {"clipfrac": _flag("NOT ok"), "kl": _share("-x"), "clipfrac_lower": _flag("r > 1.1 AND ok")})


@query("audit_dppo_tv", _dppo("exp(cur_lp) - exp(old_lp) <= 0.02", "exp(cur_lp) - exp(old_lp) >= -0.02"), T)
def audit_dppo_tv(spark, d):
    return rounded(audit.dppo(src.tokens(spark, d), "tv", 0.02, 0.02, 1.1), "step")


_BKL = "(exp(old_lp) * (old_lp - cur_lp) + (1 - exp(old_lp)) * ln((1 - exp(old_lp) + 1e-8) / (1 - exp(cur_lp) + 1e-8)))"


@query("audit_dppo_kl", _dppo(f"({_BKL} <= 0.002 OR exp(cur_lp) <= exp(old_lp))", f"({_BKL} <= 0.001 OR exp(cur_lp) >= exp(old_lp))"), T)
def audit_dppo_kl(spark, d):
    return rounded(audit.dppo(src.tokens(spark, d), "kl", 0.001, 0.002, 1.1), "step")


SEQ_MEAN = """, q AS (SELECT step, seq_id, sum(loss * mask) / (sum(mask) + 1e-8) AS s, sum(mask) AS n FROM l GROUP BY step, seq_id),
p AS (SELECT step, sum(s) FILTER (WHERE n > 0) / count(*) FILTER (WHERE n > 0) AS pg FROM q GROUP BY step)
SELECT step, """


@query(
    "audit_gspo",
    f"""WITH {A}, g AS (SELECT *, exp(least(sum((cur_lp - old_lp) * mask) OVER w / greatest(sum(mask) OVER w, 1), 10)) AS sr
  FROM a WINDOW w AS (PARTITION BY seq_id)),
l AS (SELECT *, -adv * sr AS l1, -adv * greatest(least(sr, 1.01), 0.99) AS l2, greatest(-adv * sr, -adv * greatest(least(sr, 1.01), 0.99)) AS loss FROM g)"""
    + SEQ_MEAN
    + _cells({"pg_loss": "max(pg)", "clipfrac": _flag("l2 > l1"), "kl": _share("-(cur_lp - old_lp)")})
    + " FROM l JOIN p USING (step) GROUP BY step",
    T,
)
def audit_gspo(spark, d):
    return rounded(audit.gspo(src.tokens(spark, d), 0.01, 0.01), "step")


@query(
    "audit_sapo",
    f"""WITH {A}, l AS (SELECT *, -adv * CASE WHEN adv > 0 THEN 4.0 / 1.0 / (1 + exp(-1.0 * (r - 1)))
  ELSE 4.0 / 1.05 / (1 + exp(-1.05 * (r - 1))) END AS loss FROM a)"""
    + SEQ_MEAN
    + _cells({"pg_loss": "max(pg)", "kl": _share("-x")})
    + " FROM l JOIN p USING (step) GROUP BY step",
    T,
)
def audit_sapo(spark, d):
    return rounded(audit.sapo(src.tokens(spark, d)), "step")


@query("audit_gpg", _audit("-cur_lp * adv AS loss", TOKEN), T)
def audit_gpg(spark, d):
    return rounded(audit.gpg(src.tokens(spark, d)), "step")


@query("audit_reinforce", _audit("-cur_lp * adv * least(exp(old_lp - rollout_lp) * mask, 1.5) AS loss", TOKEN | {"kl": _share("-(cur_lp - old_lp)")}), T)
def audit_reinforce(spark, d):
    return rounded(audit.reinforce(corr.is_weights(src.tokens(spark, d), "token", 1.5), "is_weight"), "step")


COV = """, b AS (SELECT step, sum(adv * mask) / (sum(mask) + 1e-8) AS ma, sum(cur_lp * mask) / (sum(mask) + 1e-8) AS ml, sum(mask) AS n FROM a GROUP BY step),
c AS (SELECT a.*, n, round((adv - ma) * (cur_lp - ml), 9) AS cov, -adv * exp(cur_lp - old_lp) AS l1,
  -adv * greatest(least(exp(cur_lp - old_lp), 1.2), 0.8) AS l2 FROM a JOIN b ON a.step = b.step)"""


@query(
    "audit_clip_cov",
    _audit(
        "greatest(l1, l2) * CASE WHEN pick THEN 0 ELSE 1 END AS loss",
        TOKEN | {"clipfrac": _flag("pick"), "kl": _share("-(cur_lp - old_lp)")},
        COV + """, e AS (SELECT seq_id, t, step, n, row_number() OVER (PARTITION BY step ORDER BY md5('42:' || seq_id || ':' || t)) AS rk
  FROM c WHERE mask > 0 AND NOT l2 > l1 AND cov > 0.5 AND cov < 1.5),
m AS (SELECT c.*, coalesce(e.rk <= greatest(floor(c.n * 0.01), 1), false) AS pick FROM c LEFT JOIN e ON c.seq_id = e.seq_id AND c.t = e.t)""",
        "m",
    ),
    T,
)
def audit_clip_cov(spark, d):
    return rounded(audit.clip_cov(src.tokens(spark, d), 0.01, 0.5, 1.5), "step")


@query(
    "audit_kl_cov",
    _audit(
        "l1 + CASE WHEN rk <= greatest(floor(n * 0.02), 1) AND mask > 0 THEN 0.5 * abs(cur_lp - old_lp) ELSE 0 END AS loss",
        TOKEN | {"kl": _share("abs(cur_lp - old_lp)")},
        COV + ", m AS (SELECT *, row_number() OVER (PARTITION BY step, mask ORDER BY cov DESC, seq_id, t) AS rk FROM c)",
        "m",
    ),
    T,
)
def audit_kl_cov(spark, d):
    return rounded(audit.kl_cov(src.tokens(spark, d), 0.02, 0.5), "step")


@query(
    "audit_geo_mean",
    f"""WITH {A}, c AS (SELECT *, cur_lp - old_lp AS y, greatest(least(cur_lp - old_lp, 0.1), -0.1) AS z FROM a),
g AS (SELECT *, sign(adv) * least(sign(adv) * y, sign(adv) * z) AS part FROM c),
s AS (SELECT step, seq_id, exp(sum(part * mask) / (sum(mask) + 1e-8)) AS ratio, sum(adv * mask) / (sum(mask) + 1e-8) AS ad FROM g GROUP BY step, seq_id),
p AS (SELECT step, avg(-ad * ratio) AS pg FROM s GROUP BY step)
SELECT step, """
    + _cells({"pg_loss": "max(pg)", "clipfrac": _flag("y <> z AND adv > 0"), "kl": _share("-y"), "clipfrac_lower": _flag("y <> z AND adv < 0")})
    + " FROM g JOIN p USING (step) GROUP BY step",
    T,
)
def audit_geo_mean(spark, d):
    return rounded(audit.geo_mean(src.tokens(spark, d), 0.1, 0.1), "step")


@query("audit_cispo", _audit("-greatest(least(r, 1.2), 0.8) * adv * cur_lp AS loss", TOKEN | {"clipfrac": _flag("r <> greatest(least(r, 1.2), 0.8)"), "kl": _share("-x")}), T)
def audit_cispo(spark, d):
    return rounded(audit.cispo(src.tokens(spark, d)), "step")


@query(
    "audit_bypass",
    f"""WITH {STATS}, a AS (SELECT * REPLACE (rollout_lp AS old_lp, CASE WHEN k_ok THEN mask ELSE 0 END AS mask), exp(greatest(least(cur_lp - rollout_lp, 20), -20)) AS r,
    greatest(least(cur_lp - rollout_lp, 20), -20) AS y FROM (SELECT *, 0.5 * (cur_lp - rollout_lp) ** 2 <= 0.15 AS k_ok FROM tokens)),
l AS (SELECT *, {PPO_COLS} FROM a) SELECT step, """
    + _cells(TOKEN | {"clipfrac": _flag("l2 > l1"), "kl": _share("-y"), "clipfrac_lower": _flag("greatest(l1, l2) > l3 AND adv < 0")})
    + " FROM l GROUP BY step",
    T,
)
def audit_bypass(spark, d):
    """Rollout log-probabilities as the old ones, rejection by the current policy, then the clip rule."""
    rows = src.tokens(spark, d)
    kept = corr.reject(rows.withColumn("old_lp", F.col("cur_lp")), {"token_k2": 0.15})
    rows = corr.bypass(kept.withColumn("mask", F.col("new_mask")))
    return rounded(audit.ppo(rows), "step")


@query(
    "audit_value",
    """WITH k AS (SELECT *, value + adv AS returns, greatest(least(vpred, value + 0.2), value - 0.2) AS vc FROM tokens)
SELECT step, """
    + _cells({"vf_loss": "0.5 * sum(greatest((vpred - returns) ** 2, (vc - returns) ** 2) * mask) / sum(mask)", "clipfrac": _flag("(vc - returns) ** 2 > (vpred - returns) ** 2")})
    + " FROM k GROUP BY step",
    T,
)
def audit_value(spark, d):
    rows = src.tokens(spark, d).withColumn("returns", F.col("value") + F.col("adv"))
    return rounded(audit.value_loss(rows, 0.2), "step")


@query("audit_entropy", "SELECT step, round(sum(entropy * mask) / sum(mask), 6) + 0.0 AS entropy_loss FROM tokens GROUP BY step", T)
def audit_entropy(spark, d):
    return rounded(audit.entropy_loss(src.tokens(spark, d)), "step")
