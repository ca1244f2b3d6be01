"""Distillation statistics and hand-off analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajtable.functions import divergence as dv
from trajtable.operators import distill, handoff
from trajtable.plans.catalog.base import csv, query, r6
from trajtable.plans.catalog.corrections import PPO_COLS, _cells, _flag, _share, rounded
from trajtable.plans.skew import with_stats
from trajtable.sources import tables as src

T, L, P, E = ("tokens",), ("logits",), ("logits", "positions"), ("trace",)

# --- top-k ---------------------------------------------------------------------------------------

EXPLODED = """e AS (SELECT vec_id, generate_subscripts(student, 1) - 1 AS i, unnest(student) AS s, unnest(teacher) AS q FROM logits),
z AS (SELECT vec_id, ln(sum(exp(s))) AS zs, ln(sum(exp(q))) AS zq FROM e GROUP BY vec_id),
lp AS (SELECT vec_id, i, s - zs AS s, q - zq AS q, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, i) AS rs,
  row_number() OVER (PARTITION BY vec_id ORDER BY q DESC, i) AS rq FROM e JOIN z USING (vec_id))"""


@query(
    "topk_per_position",
    f"WITH {EXPLODED} SELECT vec_id, (rs - 1)::INT AS rank, i::INT AS token_id FROM lp WHERE rs <= 8",
    L,
)
def topk_per_position(spark, d):
    rows = src.logits(spark, d).select("vec_id", F.posexplode(dv.top_ids(F.col("student"), 8)).alias("rank", "token_id"))
    return rows.select("vec_id", "rank", "token_id")


@query(
    "topk_overlap_join",
    f"WITH {EXPLODED} SELECT vec_id, count(*) FILTER (WHERE rs <= 8 AND rq <= 8) AS overlap FROM lp GROUP BY vec_id",
    L,
)
def topk_overlap_join(spark, d):
    a, b = dv.top_ids(F.col("student"), 8), dv.top_ids(F.col("teacher"), 8)
    return src.logits(spark, d).select("vec_id", F.size(F.array_intersect(a, b)).cast("bigint").alias("overlap"))


@query("topk_gather", f"WITH {EXPLODED} SELECT vec_id, i::INT AS token_id, round(s, 6) + 0.0 AS student_lp FROM lp WHERE rq <= 8", L)
def topk_gather(spark, d):
    rows = src.logits(spark, d).select("vec_id", dv.top_ids(F.col("teacher"), 8).alias("ids"), dv.log_softmax(F.col("student")).alias("s"))
    pairs = rows.select("vec_id", F.inline(F.arrays_zip("ids", dv.gather(F.col("s"), F.col("ids")).alias("lp"))))
    return pairs.select("vec_id", F.col("ids").alias("token_id"), r6("lp").alias("student_lp"))


def _topk_sql(renorm: bool) -> str:
    q = "ln(exp(q) / sum(exp(q)) OVER (PARTITION BY vec_id))" if renorm else "q"
    return f"""WITH {EXPLODED}, k AS (SELECT vec_id, i, s, {q} AS q, rs FROM lp WHERE rq <= 8),
c AS (SELECT *, greatest(s, -6.0) AS s2, greatest(q, -3.5) AS q2, greatest(s, -3.5) AS s3 FROM k)
SELECT vec_id, """ + _cells({
        "student_mass": "sum(exp(s))", "teacher_mass": "sum(exp(q))", "loss": "greatest(sum(exp(q2) * (q2 - s3)), 0)",
        "overlap_advantage": "coalesce(-sum(exp(q2) * (q2 - s3)) FILTER (WHERE rs <= 8) / greatest(count(*) FILTER (WHERE rs <= 8), 1), 0)",
    }) + ", (count(*) FILTER (WHERE rs <= 8))::INT AS overlap FROM c GROUP BY vec_id"


COLS = ("vec_id", "student_mass", "teacher_mass", "loss", "overlap_advantage", "overlap")


@query("distill_fkl_topk", _topk_sql(False), L)
def distill_fkl_topk(spark, d):
    return rounded(distill.topk_tables(src.logits(spark, d), 8, floor=-3.5).select(*COLS), "vec_id", "overlap")


@query("distill_fkl_renorm", _topk_sql(True), L)
def distill_fkl_renorm(spark, d):
    return rounded(distill.topk_tables(src.logits(spark, d), 8, floor=-3.5, renorm=True).select(*COLS), "vec_id", "overlap")


@query(
    "distill_overlap",
    f"""WITH {EXPLODED}, k AS (SELECT vec_id, sum(exp(s)) AS sm, sum(exp(q)) AS tm, count(*) FILTER (WHERE rs <= 8) AS n,
  coalesce(-sum(exp(q) * (q - s)) FILTER (WHERE rs <= 8), 0) AS g FROM lp WHERE rq <= 8 GROUP BY vec_id),
p AS (SELECT k.*, vec_id // 50 AS batch, label FROM k JOIN embeddings USING (vec_id) WHERE label % 7 <> 6)
SELECT batch, """ + _cells({
        "student_mass": "avg(sm)", "student_mass_min": "min(sm)", "student_mass_max": "max(sm)", "teacher_mass": "avg(tm)",
        "teacher_mass_min": "min(tm)", "teacher_mass_max": "max(tm)", "overlap_ratio": "avg(n) / 8",
        "overlap_token_advantage": "coalesce(avg(g / n) FILTER (WHERE n > 0), 0)",
    }) + " FROM p GROUP BY batch",
    L,
)
def distill_overlap(spark, d):
    rows = src.logits(spark, d).withColumns({
        "mask": F.when(F.col("label") % 7 == 6, 0).otherwise(1), "batch": F.floor(F.col("vec_id") / 50).cast("bigint"),
    })
    return rounded(distill.topk_metrics(distill.topk_tables(rows, 8), 8, ["batch"]), "batch")


@query(
    "distill_rkl",
    "WITH k AS (SELECT *, cur_lp - teacher_lp AS loss FROM tokens) SELECT step, "
    + _cells({"abs_loss": "avg(abs(loss)) FILTER (WHERE mask > 0)", "loss_min": "min(loss) FILTER (WHERE mask > 0)", "loss_max": "max(loss) FILTER (WHERE mask > 0)"})
    + " FROM k GROUP BY step",
    T,
)
def distill_rkl(spark, d):
    rows = distill.reverse_kl(src.tokens(spark, d))
    return rounded(rows.groupBy("step").agg(*distill.loss_range(F.col("loss"), F.col("mask"))), "step")


def _clip(adv: str, prefix: str) -> str:
    """The clip rule with another advantage, as SQL columns l1, l2, l3 and loss."""
    return PPO_COLS.replace("adv", adv).replace(" AS l1", f" AS {prefix}1").replace(" AS l2", f" AS {prefix}2").replace(" AS l3", f" AS {prefix}3").replace(" AS loss", f" AS {prefix}loss")


RATIO = "r0 AS (SELECT *, greatest(least(cur_lp - old_lp, 20), -20) AS x, exp(greatest(least(cur_lp - old_lp, 20), -20)) AS r FROM tokens)"


@query(
    "distill_combine",
    f"""WITH {RATIO}, k AS (SELECT *, -greatest(least(cur_lp - teacher_lp, 0.3), -0.3) AS da FROM r0),
l AS (SELECT *, {_clip("da", "d")}, {_clip("adv", "p")} FROM k),
s AS (SELECT step, sum(dloss * mask) / sum(mask) AS dl, sum(ploss * mask) / sum(mask) AS pl, {_flag("d2 > d1")} AS cf, {_share("-x")} AS kl,
  {_flag("greatest(d1, d2) > d3 AND da < 0")} AS lo FROM l GROUP BY step)
SELECT step, """ + _cells({"distill_loss": "dl", "policy_loss": "pl", "loss": "pl + 0.4 * dl", "clipfrac": "cf", "kl": "kl", "clipfrac_lower": "lo"}) + " FROM s",
    T,
)
def distill_combine(spark, d):
    rows = distill.reverse_kl(src.tokens(spark, d)).withColumnRenamed("loss", "d")
    return rounded(distill.combine(rows, "d", max_clamp=0.3, task_rewards=True, coef=0.4), "step")


TEACHER = "mask > 0 AND tok % 23 = 0"
OBJ = f"""WITH {RATIO}, k AS (SELECT *, {TEACHER} AS te, mask > 0 AND NOT tok % 23 = 0 AS st FROM r0),"""


@query(
    "relay_objective",
    OBJ + f""" d AS (SELECT *, -greatest(least(cur_lp - CASE WHEN te THEN ref_lp ELSE teacher_lp END, 2.0), -2.0) AS da FROM k),
l AS (SELECT *, {_clip("da", "d")} FROM d) SELECT step, """ + _cells({
        "loss": "sum(dloss * mask) / sum(mask)", "teacher_ratio": "count(*) FILTER (WHERE te) / sum(mask)", "student_ratio": "count(*) FILTER (WHERE st) / sum(mask)",
        "pg_loss": _share("dloss"), "teacher_pg_loss": "coalesce(sum(dloss) FILTER (WHERE te), 0) / (count(*) FILTER (WHERE te) + 1e-8)",
        "action_coverage": "count(*) FILTER (WHERE te) / greatest(count(*) FILTER (WHERE te), 1)", "abs_loss": "avg(abs(da)) FILTER (WHERE mask > 0)",
        "adv_mean_student": "avg(da) FILTER (WHERE st)", "adv_std_student": "stddev_pop(da) FILTER (WHERE st)", "clipfrac": _flag("d2 > d1"), "kl": _share("-x"),
        "clipfrac_lower": _flag("greatest(d1, d2) > d3 AND da < 0"),
        "action_mismatch": "coalesce(avg(CASE WHEN (tok * 7 + t) % 100 <> tok THEN 1.0 ELSE 0.0 END) FILTER (WHERE te), 0)",
    }) + " FROM l GROUP BY step",
    T,
)
def mixed_objective(spark, d):
    """Reverse-KL form with the student's draft actions on teacher tokens."""
    rows = src.tokens(spark, d).withColumns({
        "teacher_mask": (F.col("tok") % 23 == 0).cast("int"), "action_mask": F.lit(1), "action_lp": F.col("ref_lp"),
        "action_id": (F.col("tok") * 7 + F.col("t")) % 100,
    })
    return rounded(distill.mixed_objective(rows, "rkl", "student_draft", max_clamp=2.0), "step")


@query(
    "relay_objective_fkl",
    OBJ + f""" d AS (SELECT *, -(cur_lp - teacher_lp) AS da, least(greatest((value + 0.2), 0), 0.9) AS f FROM k),
l AS (SELECT *, {_clip("da", "d")} FROM d) SELECT step, """ + _cells({
        "loss": "sum(CASE WHEN st THEN dloss WHEN te THEN 0.5 * f ELSE 0 END) / sum(mask)", "teacher_ratio": "count(*) FILTER (WHERE te) / sum(mask)",
        "student_ratio": "count(*) FILTER (WHERE st) / sum(mask)", "pg_loss": "sum(dloss) FILTER (WHERE st) / (count(*) FILTER (WHERE st) + 1e-8)",
        "teacher_pg_loss": "coalesce(sum(dloss) FILTER (WHERE te), 0) / (count(*) FILTER (WHERE te) + 1e-8)", "action_coverage": "0.0",
        "abs_loss": "avg(abs(da)) FILTER (WHERE mask > 0)", "adv_mean_student": "avg(da) FILTER (WHERE st)", "adv_std_student": "stddev_pop(da) FILTER (WHERE st)",
        "clipfrac": "count(*) FILTER (WHERE st AND d2 > d1) / (count(*) FILTER (WHERE st) + 1e-8)", "kl": "sum(-x) FILTER (WHERE st) / (count(*) FILTER (WHERE st) + 1e-8)",
        "clipfrac_lower": "count(*) FILTER (WHERE st AND greatest(d1, d2) > d3 AND da < 0) / (count(*) FILTER (WHERE st) + 1e-8)",
        "fkl_loss": "coalesce(sum(f) FILTER (WHERE te), 0) / (count(*) FILTER (WHERE te) + 1e-8)", "fkl_loss_max": "coalesce(max(f) FILTER (WHERE te), 0)",
    }) + " FROM l GROUP BY step",
    T,
)
def mixed_objective_fkl(spark, d):
    """Forward-KL form; the fkl column is given per token (clamped to 0..0.9 here)."""
    rows = src.tokens(spark, d).withColumns({"teacher_mask": (F.col("tok") % 23 == 0).cast("int"), "fkl": F.least(F.col("value") + 0.2, F.lit(0.9))})
    return rounded(distill.mixed_objective(rows, "fkl", coef=0.5), "step")


@query(
    "relay_attach",
    """WITH n AS (SELECT seq_id, count(*) AS n FROM tokens GROUP BY seq_id),
k AS (SELECT t.*, n, CASE WHEN t < n - 2 AND tok % 3 = 0 THEN 1 ELSE 0 END AS raw, t < n - 1 AND tok % 2 = 0 AND mask > 0 AS act FROM tokens t JOIN n USING (seq_id))
SELECT seq_id, t, CASE WHEN raw > 0 AND mask > 0 THEN 1 ELSE 0 END AS teacher_mask, CASE WHEN act THEN 1 ELSE 0 END AS action_mask,
  CASE WHEN act THEN tok + 100 ELSE tok END AS action_id, CASE WHEN act THEN round(ref_lp, 6) + 0.0 ELSE 0.0 END AS action_lp FROM k""",
    T,
)
def attach_masks(spark, d):
    """The exported masks are two entries shorter than the response, the actions one."""
    rows = with_stats(src.tokens(spark, d), ["seq_id"], F.count(F.lit(1)).alias("n"))
    t, tok = F.col("t"), F.col("tok")
    masks = rows.where(t < F.col("n") - 2).select("seq_id", "t", (tok % 3 == 0).cast("int").alias("flag"))
    actions = rows.where(t < F.col("n") - 1).select("seq_id", "t", (tok + 100).alias("id"), F.col("ref_lp").alias("lp"), (tok % 2 == 0).cast("int").alias("flag"))
    out = distill.attach_rows(rows, masks, rows.select("seq_id"), actions)
    return out.select("seq_id", "t", "teacher_mask", "action_mask", "action_id", r6("action_lp").alias("action_lp"))


# --- hand-off ------------------------------------------------------------------------------------

FLAGS = """f AS (SELECT *, teacher_tok % 3 = 0 AND teacher_tok <> student_tok AND mask > 0 AS cand,
  teacher_tok % 3 = 0 AND teacher_tok <> student_tok AND mask > 0
    AND len(list_filter(student, lambda x: x > student[teacher_tok + 1])) >= 5 AS trig, student_tok % 5 = 0 AS bound FROM positions)"""


def flagged(spark, d):
    """Positions with candidate, trigger and boundary flags; marker ids are the multiples of three."""
    rows = src.positions(spark, d)
    markers = spark.range(64).where("id % 3 = 0").select(F.col("id").cast("int").alias("token_id"))
    rows = handoff.mark(rows, markers, "teacher_tok", "is_marker")
    ends = spark.range(64).where("id % 5 = 0").select(F.col("id").cast("int").alias("token_id"))
    rows = handoff.mark(rows, ends, "student_tok", "boundary")
    rows = rows.withColumn("candidate", handoff.candidate(F.col("teacher_tok"), F.col("student_tok"), F.col("is_marker"), F.col("mask") > 0))
    return rows.withColumn("trigger", handoff.trigger(F.col("candidate"), F.col("teacher_tok"), dv.top_ids(F.col("student"), 5)))


@query("handoff_candidates", f"WITH {FLAGS} SELECT traj_id, t, student_tok, teacher_tok FROM f WHERE cand", P)
def handoff_candidates(spark, d):
    return flagged(spark, d).where("candidate").select("traj_id", "t", "student_tok", "teacher_tok")


@query("handoff_triggers", f"WITH {FLAGS} SELECT traj_id, t, cand AS candidate, trig AS trigger FROM f", P)
def handoff_triggers(spark, d):
    return flagged(spark, d).select("traj_id", "t", "candidate", "trigger")


@query(
    "handoff_first",
    f"""WITH {FLAGS} SELECT traj_id, min(t) FILTER (WHERE trig) AS first_trigger, count(*) AS n_tokens,
  coalesce(min(t) FILTER (WHERE trig), count(*)) AS student_tokens FROM f GROUP BY traj_id""",
    P,
)
def handoff_first(spark, d):
    return handoff.first_triggers(flagged(spark, d), ["traj_id"])


def _legs_sql(paragraphs: int, max_legs: int, cap: int) -> str:
    """Walk the positions one by one: tokens and paragraphs left in the current leg, legs done, stopped."""
    opens = "trig AND w.cap_left <= 0 AND NOT w.stopped"
    left = f"({paragraphs} - CASE WHEN bound_teacher THEN 1 ELSE 0 END)"
    if paragraphs <= 0:
        body = f"""CASE WHEN {opens} THEN 0 ELSE 0 END AS cap_left, 0 AS par_left,
    w.done + CASE WHEN {opens} THEN 1 ELSE 0 END AS done, w.legs + CASE WHEN {opens} THEN 1 ELSE 0 END AS legs,
    w.teacher + CASE WHEN {opens} THEN 1 ELSE 0 END AS teacher,
    w.stopped OR (trig AND w.done + 1 >= {max_legs}) AS stopped,
    CASE WHEN {opens} AND w.done + 1 >= {max_legs} THEN f.t + 1 ELSE w.stop_pos END AS stop_pos"""
    else:
        ends = "w.cap_left > 0 AND (w.cap_left = 1 OR (f.bound AND w.par_left = 1))"
        body = f"""CASE WHEN {ends} THEN 0 WHEN w.cap_left > 0 THEN w.cap_left - 1 WHEN {opens} AND {left} > 0 THEN {cap} ELSE 0 END AS cap_left,
    CASE WHEN w.cap_left > 0 THEN w.par_left - CASE WHEN f.bound THEN 1 ELSE 0 END WHEN {opens} THEN {left} ELSE 0 END AS par_left,
    w.done + CASE WHEN {ends} THEN 1 ELSE 0 END AS done,
    w.legs + CASE WHEN {opens} AND {left} > 0 THEN 1 ELSE 0 END AS legs,
    w.teacher + CASE WHEN w.cap_left > 0 OR ({opens} AND {left} > 0) THEN 1 ELSE 0 END AS teacher,
    w.stopped OR ({ends} AND w.done + 1 >= {max_legs}) AS stopped,
    CASE WHEN {ends} AND w.done + 1 >= {max_legs} THEN f.t + 1 ELSE w.stop_pos END AS stop_pos"""
    return f"""WITH RECURSIVE {FLAGS}, g AS MATERIALIZED (SELECT traj_id, t, trig, bound, bound AS bound_teacher FROM f),
walk AS (SELECT DISTINCT traj_id, -1 AS t, 0 AS cap_left, 0 AS par_left, 0 AS done, 0 AS legs, 0::BIGINT AS teacher, false AS stopped, NULL::INT AS stop_pos FROM g
  UNION ALL SELECT w.traj_id, f.t, {body} FROM walk w JOIN g f ON f.traj_id = w.traj_id AND f.t = w.t + 1)
SELECT traj_id, (max(t) + 1)::INT AS n_tokens, arg_max(legs, t)::INT AS n_legs, arg_max(done, t)::INT AS completed,
  max(stop_pos)::INT AS stop_pos, arg_max(teacher, t)::INT AS teacher_tokens FROM walk GROUP BY traj_id"""


def _legs(spark, d, *args):
    return handoff.legs(flagged(spark, d), ["traj_id"], *args)


@query("handoff_budget", _legs_sql(2, 3, 6), P)
def handoff_budget(spark, d):
    return _legs(spark, d, 2, 3, 6)


@query("handoff_budget_single", _legs_sql(0, 2, 6), P)
def handoff_budget_single(spark, d):
    return _legs(spark, d, 0, 2, 6)


@query("handoff_budget_one", _legs_sql(1, 4, 256), P)
def handoff_budget_one(spark, d):
    return _legs(spark, d, 1, 4, 256)


@query(
    "paragraph_boundary",
    """SELECT p_partkey AS token_id FROM (SELECT p_partkey, p_name || CASE WHEN p_size % 5 = 0 THEN E'\\n\\n' WHEN p_size % 5 = 1 THEN E'\\n' ELSE '' END AS text FROM part)
WHERE contains(text, E'\\n\\n')""",
)
def paragraph_boundary(spark, d):
    s = F.col("p_size") % 5
    text = F.concat("p_name", F.when(s == 0, "\n\n").when(s == 1, "\n").otherwise(""))
    return handoff.boundary_ids(src.table(spark, d, "part").select(F.col("p_partkey").alias("token_id"), text.alias("text")))


@query(
    "handoff_stop",
    f"""WITH {FLAGS} SELECT traj_id, (min(t) + 1)::INT AS response_pos, 99 AS internal_stop_token_id, 5 AS student_rank_teacher_argmax_gt
FROM f WHERE trig GROUP BY traj_id""",
    P,
)
def handoff_stop(spark, d):
    return handoff.stops(flagged(spark, d), ["traj_id"], 5, 99)


@query(
    "skd_accept",
    """WITH a AS (SELECT traj_id, (t // 5)::BIGINT AS block, (t % 5)::INT AS pos,
  len(list_filter(teacher, lambda x: x > teacher[student_tok + 1])) < 25 AS ok FROM positions)
SELECT traj_id, block, min(pos) FILTER (WHERE NOT ok) AS first_rejection, count(*) AS drafted,
  coalesce(min(pos) FILTER (WHERE NOT ok), count(*)) AS accepted FROM a GROUP BY traj_id, block""",
    P,
)
def skd_accept(spark, d):
    rows = src.positions(spark, d).select(
        "traj_id", "t", F.col("student_tok").alias("draft"), dv.top_ids(F.col("teacher"), handoff.DRAFT_TOPK).alias("teacher_top")
    )
    return handoff.accept_drafts(rows, ["traj_id"], 5)


# --- traces --------------------------------------------------------------------------------------


def _gens(spark, d):
    users = src.table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return users.select(F.col("user_id").cast("string").alias("request_id"), (F.col("n") % 60 + 10).cast("int").alias("gen_len"))


def _trace(spark, d):
    return handoff.trace_tokens(handoff.expand_events(src.event_log(spark, d)), _gens(spark, d))


@query("trace_rows", "SELECT * FROM trace", E)
def trace_rows(spark, d):
    return _trace(spark, d)


@query(
    "join_trace_to_generations",
    """WITH p AS (SELECT request_id, gen_len, unnest(range(gen_len)) AS i FROM gens),
m AS (SELECT p.request_id, p.gen_len, i, CASE WHEN t.response_pos IS NULL THEN '0' ELSE '1' END AS b FROM p LEFT JOIN trace t ON p.request_id = t.request_id AND p.i = t.response_pos),
s AS (SELECT user_id::VARCHAR AS request_id, min((floor(value)::BIGINT % 80)::INT) AS pos FROM events GROUP BY 1)
SELECT m.request_id, gen_len, string_agg(b, ',' ORDER BY i) AS teacher_mask, any_value(pos) AS stop_pos FROM m LEFT JOIN s USING (request_id) GROUP BY m.request_id, gen_len""",
    E,
)
def join_trace_to_generations(spark, d):
    """Masks and the earliest stop event per generation; generations without events keep all zeros."""
    rows = handoff.teacher_masks(_trace(spark, d), _gens(spark, d))
    stops = handoff.earliest_stop(_stop_events(spark, d)).select("request_id", F.col("response_pos").alias("stop_pos"))
    return rows.join(stops, "request_id", "left").select("request_id", "gen_len", csv("teacher_mask").alias("teacher_mask"), "stop_pos")


def _stop_events(spark, d):
    ev = src.table(spark, d, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("request_id"), F.col("event_id").alias("event_no"),
        (F.floor("value") % 80).cast("int").alias("response_pos"), F.get_json_object("props", "$.k").cast("int").alias("internal_stop_token_id"),
    )


@query(
    "earliest_stop",
    """WITH s AS (SELECT user_id, event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE (floor(value)::BIGINT % 80)::INT END AS pos, (props->>'$.k')::INT AS k FROM events)
SELECT user_id::VARCHAR AS request_id, min(pos) AS response_pos, arg_min(k, pos::BIGINT * 100000000 + event_id) AS internal_stop_token_id FROM s WHERE pos IS NOT NULL GROUP BY user_id""",
)
def earliest_stop(spark, d):
    rows = _stop_events(spark, d).withColumn("response_pos", F.when(F.col("event_no") % 4 != 0, F.col("response_pos")))
    return handoff.earliest_stop(rows)


@query(
    "stop_strip",
    """WITH n AS (SELECT seq_id, count(*) AS n FROM tokens GROUP BY seq_id),
s AS (SELECT seq_id, n, CASE WHEN n % 4 = 3 THEN NULL WHEN n % 4 = 2 THEN n ELSE n // 2 END AS pos FROM n),
k AS (SELECT s.*, x.tok AS at_pos FROM s LEFT JOIN tokens x ON x.seq_id = s.seq_id AND x.t = s.pos),
r AS (SELECT *, coalesce((pos < n AND (n % 4 = 0 OR at_pos = 9)), false) AS inside, coalesce(pos = n, false) AS behind FROM k)
SELECT seq_id, n::INT AS raw_gen_len, (CASE WHEN inside THEN pos ELSE n END)::INT AS gen_len, inside OR behind AS removed,
  CASE WHEN inside OR behind THEN 'trigger_stop' ELSE 'stop' END AS finish_reason, pos IS NOT NULL AND NOT (inside OR behind) AS mismatch FROM r""",
    T,
)
def stop_strip(spark, d):
    """Stop events at half length (token id known for odd lengths), behind the end, or absent."""
    rows, n = src.tokens(spark, d), F.col("n")
    stops = rows.groupBy("seq_id").agg(F.count(F.lit(1)).cast("int").alias("n")).select(
        "seq_id", F.when(n % 4 == 3, None).when(n % 4 == 2, n).otherwise(F.floor(n / 2).cast("int")).alias("response_pos"),
        F.when(n % 4 != 0, 9).alias("internal_stop_token_id"), F.lit("stop").alias("finish_reason"),
    )
    return handoff.stop_summary(rows, stops, ["seq_id"])


@query(
    "trace_trim",
    """WITH k AS (SELECT request_id, gen_len, (gen_len * 2) // 3 AS keep FROM gens),
t AS (SELECT request_id, k.gen_len, keep, response_pos, emit_token_id FROM trace JOIN k USING (request_id))
SELECT request_id, least(any_value(gen_len), any_value(keep))::INT AS mask_len, string_agg(response_pos, ',' ORDER BY response_pos) FILTER (WHERE response_pos < keep) AS positions,
  string_agg(emit_token_id, ',' ORDER BY response_pos) FILTER (WHERE response_pos < keep) AS tokens, (count(*) FILTER (WHERE response_pos < keep))::INT AS n_events FROM t GROUP BY request_id""",
    E,
)
def trace_trim(spark, d):
    trace = _trace(spark, d)
    cells = trace.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("response_pos", "emit_token_id"))).alias("events"))
    rows = handoff.teacher_masks(trace, _gens(spark, d)).join(cells, "request_id").withColumns({
        "positions": F.transform("events", lambda e: e.response_pos), "tokens": F.transform("events", lambda e: e.emit_token_id),
        "keep_len": F.floor(F.col("gen_len") * 2 / 3).cast("int"),
    })
    out = handoff.trim_trace(rows)
    text = lambda c: F.when(F.size(c) > 0, csv(c)).alias(c)
    return out.select("request_id", F.size("teacher_mask").alias("mask_len"), text("positions"), text("tokens"), F.size("events").alias("n_events"))


@query(
    "trace_divergence",
    """WITH e AS (SELECT traj_id, t, student_tok, teacher_tok, generate_subscripts(student, 1) - 1 AS i, unnest(student) AS s, unnest(teacher) AS q FROM positions),
z AS (SELECT traj_id, t, ln(sum(exp(s))) AS zs, ln(sum(exp(q))) AS zq FROM e GROUP BY traj_id, t),
lp AS (SELECT e.traj_id, e.t, student_tok, teacher_tok, i, s - zs AS s, q - zq AS q, row_number() OVER (PARTITION BY e.traj_id, e.t ORDER BY q DESC, i) AS rq FROM e JOIN z ON e.traj_id = z.traj_id AND e.t = z.t),
m AS (SELECT traj_id, t, sum(exp(q)) AS tm, sum(exp(s)) AS sm FROM lp WHERE rq <= 16 GROUP BY traj_id, t),
k AS (SELECT lp.traj_id, lp.t, sum(exp(q) / tm * (ln(exp(q) / tm) - s)) AS fkl FROM lp JOIN m ON lp.traj_id = m.traj_id AND lp.t = m.t WHERE rq <= 16 GROUP BY lp.traj_id, lp.t),
a AS (SELECT traj_id, t, max(q) FILTER (WHERE i = teacher_tok) AS ta, max(s) FILTER (WHERE i = teacher_tok) AS sa, max(q) FILTER (WHERE i = student_tok) AS td, max(s) FILTER (WHERE i = student_tok) AS sd FROM lp GROUP BY traj_id, t)
SELECT m.traj_id, m.t, """ + _cells({
        "teacher_mass": "tm", "student_mass": "sm", "fkl_renorm": "fkl", "teacher_argmax_lp": "ta", "student_argmax_lp": "sa",
        "teacher_draft_lp": "td", "student_draft_lp": "sd", "gap": "ta - sa",
    }) + " FROM m JOIN k ON m.traj_id = k.traj_id AND m.t = k.t JOIN a ON m.traj_id = a.traj_id AND m.t = a.t",
    P,
)
def trace_divergence(spark, d):
    rows = src.positions(spark, d).withColumnRenamed("student_tok", "draft")
    out = distill.token_divergence(rows, 16).drop("student", "teacher", "teacher_tok", "mask", "draft", "argmax")
    return rounded(out, "traj_id", "t")


@query(
    "token_source_chunks",
    """SELECT seq_id, event_id, tok, row_number() OVER (PARTITION BY seq_id ORDER BY t) - 1 AS response_pos FROM tokens WHERE tok >= 0 AND tok < 90""",
    T,
)
def token_source_chunks(spark, d):
    rows = handoff.running_positions(src.tokens(spark, d), "seq_id", ["t"], "tok", 90)
    return rows.select("seq_id", "event_id", "tok", "response_pos")
