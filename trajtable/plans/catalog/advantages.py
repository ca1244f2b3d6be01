"""Group-relative advantages and reward shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajtable.functions.divergence import kl
from trajtable.operators import advantage as adv
from trajtable.plans.catalog.base import csv, query, r6
from trajtable.plans.skew import with_stats
from trajtable.sources import tables as src

ROW = "step, uid, line, problem_id, score"
G = ("rollouts",)
T = ("tokens",)
GROUP_SQL = """SELECT *, count(*) OVER g AS n, CASE WHEN count(*) OVER g = 1 THEN 0.0 ELSE avg(score) OVER g END AS mu,
  CASE WHEN count(*) OVER g = 1 THEN 1.0 ELSE stddev_samp(score) OVER g END AS sd
  FROM rollouts WINDOW g AS (PARTITION BY step, uid)"""


def _rows(df):
    return df.select("step", "uid", "line", "problem_id", r6("score").alias("score"), r6("advantage").alias("advantage"))


def _outcome(value: str) -> str:
    return f"""WITH g AS ({GROUP_SQL})
SELECT step, uid, line, problem_id, round(score, 6) + 0.0 AS score, round({value}, 6) + 0.0 AS advantage FROM g"""


@query("adv_grpo", _outcome("(score - mu) / (sd + 1e-6)"), G)
def adv_grpo(spark, d):
    return _rows(adv.grpo(src.rollouts(spark, d)))


@query("adv_grpo_nostd", _outcome("score - mu"), G)
def adv_grpo_nostd(spark, d):
    return _rows(adv.grpo(src.rollouts(spark, d), by_std=False))


@query("adv_grpo_vectorized", _outcome("(score - mu) / (sd + 1e-6)"), G)
def adv_grpo_vectorized(spark, d):
    return _rows(adv.grpo_from_table(src.rollouts(spark, d)))


@query(
    "group_mean_std",
    """SELECT step, uid, count(*) AS n,
  round(CASE WHEN count(*) = 1 THEN 0.0 ELSE avg(score) END, 6) + 0.0 AS mean,
  round(CASE WHEN count(*) = 1 THEN 1.0 ELSE sqrt(greatest(var_samp(score), 0.0001)) END, 6) + 0.0 AS std
FROM rollouts GROUP BY step, uid""",
    G,
)
def group_mean_std(spark, d):
    df = adv.group_mean_std(src.rollouts(spark, d), "score", eps=1e-4)
    return df.select("step", "uid", "n", r6("mean").alias("mean"), r6("std").alias("std"))


@query(
    "join_group_stats",
    """SELECT step, uid, line, problem_id, count(*) OVER g AS group_n, round(max(score) OVER g, 6) + 0.0 AS group_best,
  round(avg(acc) OVER g, 6) + 0.0 AS group_acc FROM rollouts WINDOW g AS (PARTITION BY step, uid)""",
    G,
)
def join_group_stats(spark, d):
    df = adv.with_stats(
        src.rollouts(spark, d), adv.GROUP, F.count(F.lit(1)).alias("group_n"),
        F.max("score").alias("b"), F.avg("acc").alias("a"),
    )
    return df.select("step", "uid", "line", "problem_id", "group_n", r6("b").alias("group_best"), r6("a").alias("group_acc"))


@query(
    "adv_gdpo",
    """WITH g AS (SELECT *, CASE WHEN count(*) OVER w = 1 THEN 0.0 ELSE avg(score) OVER w END AS m1,
  CASE WHEN count(*) OVER w = 1 THEN 1.0 ELSE stddev_samp(score) OVER w END AS s1,
  CASE WHEN count(*) OVER w = 1 THEN 0.0 ELSE avg(score2) OVER w END AS m2,
  CASE WHEN count(*) OVER w = 1 THEN 1.0 ELSE stddev_samp(score2) OVER w END AS s2
  FROM rollouts WINDOW w AS (PARTITION BY step, uid)),
a AS (SELECT *, 0.75 * (score - m1) / (s1 + 1e-6) + 0.25 * (score2 - m2) / (s2 + 1e-6) AS x FROM g),
b AS (SELECT step, sum(resp_len)::DOUBLE AS n, sum(resp_len * x) / (sum(resp_len) + 1e-8) AS mu FROM a GROUP BY step),
v AS (SELECT a.step, sum(resp_len * (x - mu) ** 2) / (max(n) + 1e-8) * max(n) / (max(n) - 1) AS var
      FROM a JOIN b USING (step) GROUP BY a.step)
SELECT step, uid, line, problem_id, round(score, 6) + 0.0 AS score,
  round((x - mu) / sqrt(var + 1e-8), 6) + 0.0 AS advantage FROM a JOIN b USING (step) JOIN v USING (step)""",
    G,
)
def adv_gdpo(spark, d):
    return _rows(adv.gdpo(src.rollouts(spark, d), ["score", "score2"], [0.75, 0.25]))


@query(
    "adv_grpo_passk",
    """WITH r AS (SELECT *, count(*) OVER g AS n, stddev_samp(score) OVER g AS sd,
  row_number() OVER (PARTITION BY step, uid ORDER BY score DESC, sample_idx) AS rk,
  max(score) OVER g AS top FROM rollouts WINDOW g AS (PARTITION BY step, uid)),
s AS (SELECT step, uid, max(score) AS second FROM r WHERE rk = 2 GROUP BY step, uid)
SELECT r.step, r.uid, sample_idx, round(score, 6) + 0.0 AS score,
  CASE WHEN n < 2 THEN NULL WHEN rk = 1 THEN round((top - second) / (sd + 1e-6), 6) + 0.0 ELSE 0.0::DOUBLE END AS advantage
FROM r LEFT JOIN s ON r.step = s.step AND r.uid = s.uid""",
    G,
)
def adv_grpo_passk(spark, d):
    df = adv.grpo_passk(src.rollouts(spark, d, index=True), single="null")
    return df.select("step", "uid", "sample_idx", r6("score").alias("score"), r6("advantage").alias("advantage"))


@query(
    "adv_reinforce_pp_baseline",
    f"""WITH g AS ({GROUP_SQL}), a AS (SELECT *, score - mu AS x FROM g),
b AS (SELECT step, sum(resp_len)::DOUBLE AS tok, sum(resp_len * x) / (sum(resp_len) + 1e-8) AS m FROM a GROUP BY step),
v AS (SELECT a.step, sum(resp_len * (x - m) ** 2) / (max(tok) + 1e-8) * max(tok) / (max(tok) - 1) AS var
      FROM a JOIN b USING (step) GROUP BY a.step)
SELECT step, uid, line, problem_id, round(score, 6) + 0.0 AS score,
  round((x - m) / sqrt(var + 1e-8), 6) + 0.0 AS advantage FROM a JOIN b USING (step) JOIN v USING (step)""",
    G,
)
def adv_reinforce_pp_baseline(spark, d):
    return _rows(adv.reinforce_pp_baseline(src.rollouts(spark, d)))


@query("adv_rloo", _outcome("CASE WHEN n > 1 THEN score * n / (n - 1) - mu * n / (n - 1) ELSE score END"), G)
def adv_rloo(spark, d):
    return _rows(adv.rloo(src.rollouts(spark, d)))


@query(
    "adv_rloo_vectorized",
    _outcome("CASE WHEN n > 1 THEN (n * score - n * mu) / (n - 1) ELSE 0.0 END"),
    G,
)
def adv_rloo_vectorized(spark, d):
    return _rows(adv.rloo_from_sums(src.rollouts(spark, d)))


@query(
    "adv_opo",
    """WITH r AS (SELECT * EXCLUDE (score), round(score * 97) AS score FROM rollouts),
g AS (SELECT *, count(*) OVER w AS n, sum(resp_len) OVER w AS len, sum(resp_len * score) OVER w AS mass FROM r WINDOW w AS (PARTITION BY step, uid))
SELECT step, uid, line, problem_id, round(score, 6) + 0.0 AS score, round(CASE WHEN n = 1 THEN score ELSE (score * len - mass) / len END, 6) + 0.0 AS advantage FROM g""",
    G,
)
def adv_opo(spark, d):
    """Scores in whole cents: sums are exact, and so is a quotient that ends on a half."""
    return _rows(adv.opo(src.rollouts(spark, d).withColumn("score", F.round(F.col("score") * 97))))


@query(
    "adv_gpg",
    f"""WITH g AS ({GROUP_SQL}), a AS (SELECT step, count(*)::DOUBLE / greatest(count(*) FILTER (WHERE score <> 0), 1) AS alpha
  FROM rollouts GROUP BY step)
SELECT step, uid, line, problem_id, round(score, 6) + 0.0 AS score,
  round(alpha * (score - mu), 6) + 0.0 AS advantage FROM g JOIN a USING (step)""",
    G,
)
def adv_gpg(spark, d):
    return _rows(adv.gpg(src.rollouts(spark, d)))


@query(
    "adv_multi_output",
    """WITH f AS (SELECT step, uid, line, arg_max(score, sample_idx) AS s FROM rollouts GROUP BY step, uid, line),
a AS (SELECT *, CASE WHEN count(*) OVER w = 1 THEN s / (1 + 1e-6)
  ELSE (s - avg(s) OVER w) / (stddev_samp(s) OVER w + 1e-6) END AS adv FROM f WINDOW w AS (PARTITION BY step, uid))
SELECT r.step, r.uid, r.line AS session_id, sample_idx, round(score, 6) + 0.0 AS score, round(adv, 6) + 0.0 AS advantage
FROM rollouts r JOIN a ON r.step = a.step AND r.uid = a.uid AND r.line = a.line""",
    G,
)
def adv_multi_output(spark, d):
    rows = src.rollouts(spark, d, index=True).withColumnRenamed("line", "session_id")
    df = adv.multi_output(rows, index="sample_idx")
    return df.select("step", "uid", "session_id", "sample_idx", r6("score").alias("score"), r6("advantage").alias("advantage"))


# --- token estimators ---------------------------------------------------------------------------

WHITE = """, b AS (SELECT step, sum(mask)::DOUBLE AS n, sum(raw * mask) / (sum(mask) + 1e-8) AS m FROM a GROUP BY step),
v AS (SELECT a.step, sum((raw - m) ** 2 * mask) / (max(n) + 1e-8) * max(n) / (max(n) - 1) AS var
      FROM a JOIN b USING (step) GROUP BY a.step)"""


def _gae_sql(gamma: float, lam: float) -> str:
    delta = f"(k.reward + {gamma} * w.ahead - k.value + {gamma * lam!r} * w.held)"
    return f"""WITH RECURSIVE k AS MATERIALIZED (SELECT * FROM tokens),
walk AS (
  SELECT k.step, k.seq_id, k.t, k.mask, k.value,
    CASE WHEN k.mask > 0 THEN k.reward - k.value ELSE 0.0 END AS held, CASE WHEN k.mask > 0 THEN k.value ELSE 0.0 END AS ahead
  FROM k JOIN (SELECT seq_id, max(t) AS t FROM k GROUP BY seq_id) l ON k.seq_id = l.seq_id AND k.t = l.t
  UNION ALL
  SELECT k.step, k.seq_id, k.t, k.mask, k.value, CASE WHEN k.mask > 0 THEN {delta} ELSE w.held END,
    CASE WHEN k.mask > 0 THEN k.value ELSE w.ahead END
  FROM walk w JOIN k ON k.seq_id = w.seq_id AND k.t = w.t - 1),
a AS (SELECT *, held AS raw FROM walk){WHITE}
SELECT step, seq_id, t, round((raw - m) / sqrt(var + 1e-8), 6) + 0.0 AS advantage,
  round(raw + value, 6) + 0.0 AS returns FROM a JOIN b USING (step) JOIN v USING (step)"""


def _tok(df):
    return df.select("step", "seq_id", "t", r6("advantage").alias("advantage"), r6("returns").alias("returns"))


@query("adv_gae", _gae_sql(1.0, 1.0), T)
def adv_gae(spark, d):
    return _tok(adv.gae(src.tokens(spark, d)))


@query("adv_gae_discounted", _gae_sql(0.97, 0.9), T)
def adv_gae_discounted(spark, d):
    return _tok(adv.gae(src.tokens(spark, d), 0.97, 0.9))


def _rpp_sql(gamma: float) -> str:
    return f"""WITH RECURSIVE k AS MATERIALIZED (SELECT * FROM tokens),
walk AS (
  SELECT k.step, k.seq_id, k.t, k.mask, k.reward AS raw
  FROM k JOIN (SELECT seq_id, max(t) AS t FROM k GROUP BY seq_id) l ON k.seq_id = l.seq_id AND k.t = l.t
  UNION ALL
  SELECT k.step, k.seq_id, k.t, k.mask, k.reward + {gamma} * w.raw * w.mask
  FROM walk w JOIN k ON k.seq_id = w.seq_id AND k.t = w.t - 1),
a AS (SELECT * FROM walk){WHITE}
SELECT step, seq_id, t, round((raw - m) / sqrt(var + 1e-8) * mask, 6) + 0.0 AS advantage,
  round(raw, 6) + 0.0 AS returns FROM a JOIN b USING (step) JOIN v USING (step)"""


@query("adv_reinforce_pp", _rpp_sql(1.0), T)
def adv_reinforce_pp(spark, d):
    return _tok(adv.reinforce_pp(src.tokens(spark, d)))


@query("adv_reinforce_pp_discounted", _rpp_sql(0.93), T)
def adv_reinforce_pp_discounted(spark, d):
    return _tok(adv.reinforce_pp(src.tokens(spark, d), 0.93))


@query(
    "adv_remax",
    """WITH s AS (SELECT uid, seq_id, sum(reward * mask) AS r FROM tokens GROUP BY uid, seq_id),
base AS (SELECT uid, arg_min(r, seq_id) AS baseline FROM s GROUP BY uid),
k AS (SELECT *, sum(reward * mask) OVER (PARTITION BY seq_id ORDER BY t DESC) AS ret FROM tokens JOIN base USING (uid))
SELECT step, seq_id, t, round(ret - baseline * mask, 6) + 0.0 AS advantage, round(ret, 6) + 0.0 AS returns FROM k""",
    T,
)
def adv_remax(spark, d):
    tokens = src.tokens(spark, d)
    per_row = tokens.groupBy("uid", "seq_id").agg(F.sum(F.col("reward") * F.col("mask")).alias("r"))
    base = per_row.groupBy("uid").agg(F.min_by("r", "seq_id").alias("baseline"))
    return _tok(adv.remax(tokens.join(base, "uid")))


def _otb_sql(weight: str, packed: bool) -> str:
    pos = "sum(mask) OVER (PARTITION BY seq_id ORDER BY t) - 1" if packed else "t"
    drop_empty = "WHERE len > 0" if packed else ""
    return f"""WITH k AS (SELECT *, sum(reward * mask) OVER (PARTITION BY seq_id ORDER BY t DESC) AS ret,
  sum((1 - 2 * exp(old_lp) + sum_pi2) * mask{weight}) OVER (PARTITION BY seq_id ORDER BY t) AS w, {pos} AS pos FROM tokens),
l0 AS (SELECT step, uid, seq_id, sum(mask) AS len FROM tokens GROUP BY step, uid, seq_id),
l AS (SELECT *, count(*) OVER (PARTITION BY step, uid) AS n,
  row_number() OVER (PARTITION BY step, uid ORDER BY len DESC, seq_id) AS rk FROM l0 {drop_empty}),
two AS (SELECT step, uid, max(CASE WHEN rk = 1 THEN len END) AS m1, max(CASE WHEN rk = 2 THEN len END) AS m2 FROM l GROUP BY step, uid),
b AS (SELECT step, uid, pos, sum(ret * w) / (sum(w) + 1e-8) AS base FROM k WHERE mask > 0 GROUP BY step, uid, pos)
SELECT k.step, k.seq_id, k.t, round(CASE WHEN k.mask = 0 THEN 0 WHEN l.n = 1 THEN ret
  WHEN l.len = m1 AND m1 > m2 AND k.pos >= m2 THEN ret ELSE ret - coalesce(base, 0) END, 6) + 0.0 AS advantage,
  round(ret, 6) + 0.0 AS returns
FROM k LEFT JOIN l ON k.seq_id = l.seq_id LEFT JOIN two ON k.step = two.step AND k.uid = two.uid
LEFT JOIN b ON k.step = b.step AND k.uid = b.uid AND k.pos = b.pos"""


@query("adv_otb", _otb_sql("", False), T)
def adv_otb(spark, d):
    return _tok(adv.token_baseline(src.tokens(spark, d)))


@query("adv_otb_weighted", _otb_sql(" * exp(2 * (old_lp - rollout_lp))", False), T)
def adv_otb_weighted(spark, d):
    rows = src.tokens(spark, d).withColumn("is_w", F.exp(F.col("old_lp") - F.col("rollout_lp")))
    return _tok(adv.token_baseline(rows, weight="is_w"))


@query("adv_tir_otb", _otb_sql("", True), T)
def adv_tir_otb(spark, d):
    return _tok(adv.token_baseline(src.tokens(spark, d), packed=True))


# --- rewards ------------------------------------------------------------------------------------


@query(
    "kl_in_reward",
    """WITH k AS (SELECT *, greatest(least(exp(greatest(least(ref_lp - old_lp, 20), -20)) - greatest(least(ref_lp - old_lp, 20), -20) - 1, 10), -10) * mask AS kl FROM tokens),
s AS (SELECT step, seq_id, sum(kl * mask) / (sum(mask) + 1e-8) AS m FROM k GROUP BY step, seq_id),
m AS (SELECT step, avg(m) AS current_kl FROM s GROUP BY step)
SELECT k.step, seq_id, t, round(reward - 0.05 * kl, 6) + 0.0 AS token_reward, round(current_kl, 6) + 0.0 AS current_kl
FROM k JOIN m USING (step)""",
    T,
)
def kl_in_reward(spark, d):
    rows = adv.kl_in_reward(src.tokens(spark, d), kl("k3", F.col("old_lp"), F.col("ref_lp")), 0.05)
    stats = adv.mean_row_kl(rows).drop("n")
    return rows.join(stats, "step").select(
        "step", "seq_id", "t", r6("token_reward").alias("token_reward"), r6("current_kl").alias("current_kl")
    )


@query(
    "adaptive_kl",
    """WITH RECURSIVE s AS (SELECT uid, seq_id, sum((old_lp - ref_lp) * mask) / (sum(mask) + 1e-8) AS m FROM tokens GROUP BY uid, seq_id),
k AS (SELECT uid AS step, avg(m) AS kl, count(*) AS n, row_number() OVER (ORDER BY uid) AS i FROM s GROUP BY uid),
w AS (SELECT step, kl, n, i, 0.2::DOUBLE * (1 + greatest(least(kl / 0.1 - 1, 0.2), -0.2) * n / 100) AS beta FROM k WHERE i = 1
  UNION ALL SELECT k.step, k.kl, k.n, k.i, w.beta * (1 + greatest(least(k.kl / 0.1 - 1, 0.2), -0.2) * k.n / 100)
  FROM w JOIN k ON k.i = w.i + 1)
SELECT step, n, round(kl, 6) + 0.0 AS current_kl, round(beta, 6) + 0.0 AS beta FROM w""",
    T,
)
def adaptive_kl(spark, d):
    """Each prompt group plays one step here, so that the controller sees a longer run."""
    rows = src.tokens(spark, d).withColumn("kl", F.col("old_lp") - F.col("ref_lp"))
    steps = adv.mean_row_kl(rows.drop("step").withColumnRenamed("uid", "step"))
    out = adv.adaptive_kl(steps.withColumn("run", F.lit("run")), 0.2, 0.1, 100)
    return out.select("step", "n", r6("current_kl").alias("current_kl"), r6("beta").alias("beta"))


@query(
    "token_reward",
    "SELECT seq_id, t, round(reward - 0.1 * (old_lp - ref_lp), 6) + 0.0 AS token_reward FROM tokens",
    T,
)
def token_reward(spark, d):
    lp = F.col("old_lp") - F.col("ref_lp")
    return src.tokens(spark, d).select("seq_id", "t", r6(F.col("reward") - 0.1 * lp).alias("token_reward"))


@query(
    "assemble_scores",
    """WITH k AS (SELECT seq_id, count(*) AS width, sum(mask)::INT AS len FROM tokens GROUP BY seq_id),
p AS (SELECT t.seq_id, t.t, CASE WHEN t.t = len - 1 THEN len / 7.0::DOUBLE ELSE 0.0::DOUBLE END AS s,
  CASE WHEN t.t = (CASE WHEN len = 0 THEN width ELSE len END) - 1 THEN len / 7.0::DOUBLE ELSE 0.0::DOUBLE END AS o FROM tokens t JOIN k USING (seq_id))
SELECT seq_id, t, round(s, 6) + 0.0 AS token_score, round(o, 6) + 0.0 AS token_score_old FROM p""",
    T,
)
def assemble_scores(spark, d):
    rows = with_stats(src.tokens(spark, d), ["seq_id"], (F.sum("mask") / 7.0).alias("score"))
    rows = adv.place_scores(adv.place_scores(rows, out="s"), out="o", empty="last")
    return rows.select("seq_id", "t", r6("s").alias("token_score"), r6("o").alias("token_score_old"))


@query(
    "reward_rows",
    """WITH l AS (SELECT uid, line, max(sample_idx) AS sample_idx FROM rollouts GROUP BY uid, line)
SELECT r.uid, r.line AS session_id, round(score, 6) + 0.0 AS score,
  CASE WHEN line % 2 = 0 THEN acc ELSE round(score, 6) + 0.0 END AS acc, CASE WHEN line % 2 = 0 THEN pred END AS pred
FROM rollouts r JOIN l USING (uid, line, sample_idx)""",
    G,
)
def reward_rows(spark, d):
    """Scorer results as JSON: an object gives score and extras, a number is score and acc."""
    from trajtable.operators.rewards import reward_rows as rows

    df = src.rollouts(spark, d, index=True)
    detail = F.to_json(F.struct("score", "acc", "pred"))
    result = F.when(F.col("line") % 2 == 0, detail).otherwise(F.col("score").cast("string"))
    out = rows(df.withColumn("result", result), ["uid", "line"], "sample_idx")
    return out.select("uid", F.col("line").alias("session_id"), r6("score").alias("score"), r6("acc").alias("acc"), "pred")


@query(
    "overlong_penalty",
    """SELECT step, uid, line, problem_id, round(least(-(resp_len - 24) / 16.0 * 0.5, 0), 6) + 0.0 AS penalty,
  round(score + least(-(resp_len - 24) / 16.0 * 0.5, 0), 6) + 0.0 AS reward,
  least(-(resp_len - 24) / 16.0 * 0.5, 0) < 0 AS overlong FROM rollouts""",
    G,
)
def overlong_penalty(spark, d):
    p = adv.overlong_penalty(F.col("resp_len"), 40, 16, 0.5)
    return src.rollouts(spark, d).select(
        "step", "uid", "line", "problem_id", r6(p).alias("penalty"), r6(F.col("score") + p).alias("reward"), (p < 0).alias("overlong")
    )


@query(
    "reward_on_error",
    """SELECT uid, line, problem_id, CASE WHEN resp_len > 40 OR pred = 'NO' THEN 0.0 ELSE round(score, 6) + 0.0 END AS reward,
  CASE WHEN resp_len > 40 OR pred = 'NO' THEN 0.0 ELSE acc END AS acc,
  resp_len > 40 AS timed_out, resp_len <= 40 AND pred = 'NO' AS failed FROM rollouts""",
    G,
)
def reward_on_error(spark, d):
    """A scorer that ran too long, or whose answer cannot be read, gives 0 with a flag."""
    from trajtable.operators.rewards import reward_on_error as guard

    df = src.rollouts(spark, d).withColumn(
        "raw", F.when(F.col("pred") == "NO", F.lit("error")).otherwise(F.col("score").cast("string"))
    )
    out = guard(df, "raw", seconds=F.col("resp_len"), limit=40)
    return out.select("uid", "line", "problem_id", r6("reward").alias("reward"), "acc", "timed_out", "failed")
