"""Distillation statistics: single-sample estimators, top-k forward KL, mixed teacher/student objective."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajtable.functions.divergence import clamp, gather, kl, kl_on_support, log_softmax, top_ids, total
from trajtable.operators import audit
from trajtable.operators.masked import masked_mean, masked_sum


def loss_range(loss: Column, mask: Column) -> list[Column]:
    v = F.when(mask > 0, loss)
    return [F.avg(F.abs(v)).alias("abs_loss"), F.min(v).alias("loss_min"), F.max(v).alias("loss_max")]


def reverse_kl(df: DataFrame, kind: str = "k1", student: str = "cur_lp", teacher: str = "teacher_lp") -> DataFrame:
    """Per-token KL estimate of student against teacher."""
    return df.withColumn("loss", kl(kind, F.col(student), F.col(teacher)))


def topk_tables(df: DataFrame, k: int, floor: float | None = None, renorm: bool = False) -> DataFrame:
    """Teacher top-k against the student at every position.

    ``student`` and ``teacher`` are logit arrays. Masses are taken before the log-prob floor; with
    ``renorm`` the teacher's top-k is a distribution of its own (mass 1).
    """
    base = df.withColumns({"_t": log_softmax(F.col("teacher")), "_s": log_softmax(F.col("student"))})
    base = base.withColumns({"teacher_ids": top_ids(F.col("_t"), k), "student_ids": top_ids(F.col("_s"), k)})
    base = base.withColumns(
        {"_tk": gather(F.col("_t"), F.col("teacher_ids")), "_sk": gather(F.col("_s"), F.col("teacher_ids"))}
    ).drop("_t", "_s")
    if renorm:
        base = base.withColumn("_tk", log_softmax(F.col("_tk")))
    exp = lambda c: F.transform(c, lambda v: F.exp(v))
    rows = base.withColumns(
        {"student_mass": total(exp("_sk")), "teacher_mass": F.lit(1.0) if renorm else total(exp("_tk"))}
    )
    if floor is not None:
        cut = lambda c: F.transform(c, lambda v: F.greatest(v, F.lit(floor)))
        rows = rows.withColumns({"_tk": cut("_tk"), "_sk": cut("_sk")})
    rows = rows.withColumn("raw_loss", kl_on_support(exp("_tk"), F.col("_tk"), F.col("_sk")))
    pairs = F.arrays_zip("teacher_ids", "_tk", "_sk")
    shared = F.filter(pairs, lambda x: F.array_contains(F.col("student_ids"), x.teacher_ids))
    gain = F.aggregate(shared, F.lit(0.0), lambda a, x: a - F.exp(x["_tk"]) * (x["_tk"] - x["_sk"]))
    rows = rows.withColumns({"overlap": F.size(shared), "_gain": gain})
    return rows.withColumns(
        {
            # top-k distributions do not sum to one, so the divergence can fall below zero
            "loss": F.greatest("raw_loss", F.lit(0.0)),
            "overlap_advantage": F.col("_gain") / F.greatest("overlap", F.lit(1)),
        }
    ).drop("_tk", "_sk", "_gain")


def topk_metrics(rows: DataFrame, k: int, batch: Sequence[str], mask: str = "mask") -> DataFrame:
    on = F.col(mask) > 0
    v = lambda c: F.when(on, F.col(c))
    some = on & (F.col("overlap") > 0)
    return rows.groupBy(*batch).agg(
        F.avg(v("student_mass")).alias("student_mass"), F.min(v("student_mass")).alias("student_mass_min"),
        F.max(v("student_mass")).alias("student_mass_max"), F.avg(v("teacher_mass")).alias("teacher_mass"),
        F.min(v("teacher_mass")).alias("teacher_mass_min"), F.max(v("teacher_mass")).alias("teacher_mass_max"),
        (F.avg(v("overlap")) / k).alias("overlap_ratio"),
        F.coalesce(F.avg(F.when(some, F.col("overlap_advantage"))), F.lit(0.0)).alias("overlap_token_advantage"),
    )


def combine(
    df: DataFrame, loss: str, max_clamp: float | None = None, policy_gradient: bool = True, task_rewards: bool = False,
    coef: float = 1.0, mode: str = "token-mean", low: float = 0.2, high: float = 0.2, c: float = 3.0, batch=("step",),
) -> DataFrame:
    """Distillation loss (as negative reward, or directly) plus the task's policy loss if asked for."""
    value = F.col(loss) if max_clamp is None else clamp(F.col(loss), -max_clamp, max_clamp)
    rows = df.withColumn("_d", value)
    if policy_gradient:
        terms, shares = audit.clip_terms(F.col("cur_lp"), F.col("old_lp"), -F.col("_d"), low, high, c)
    else:
        terms, shares = F.col("_d"), {}
    distill = audit.reduce_audit(rows, terms, shares, mode, batch=batch, name="distill_loss")
    task = audit.ppo(rows, low, high, c, mode=mode).select(*batch, F.col("pg_loss").alias("policy_loss"))
    if not task_rewards:
        task = task.withColumn("policy_loss", F.lit(0.0))
    weight = coef if task_rewards else 1.0
    return distill.join(task, list(batch)).withColumn("loss", F.col("policy_loss") + weight * F.col("distill_loss"))


def attach_masks(df: DataFrame, teacher: str, response: str, actions: str | None = None) -> DataFrame:
    """Cut or pad the teacher mask to the response, AND it with the response mask.

    Every row must carry a teacher mask. With ``actions`` (ids, log-probs, mask as a struct column)
    masked positions take the draft action, others keep the emitted token and log-prob 0.
    """
    missing = F.raise_error(F.lit("a row has no teacher mask")).cast("array<int>")
    n = F.size(response)
    base = F.when(F.col(teacher).isNull(), missing).otherwise(F.col(teacher))
    padded = F.concat(F.slice(base, F.lit(1), n), F.array_repeat(F.lit(0), F.greatest(n - F.size(base), F.lit(0))))
    rows = df.withColumn("teacher_mask", F.zip_with(padded, response, lambda a, b: F.when((a > 0) & (b > 0), 1).otherwise(0)))
    if actions is None:
        return rows
    a = F.col(actions)
    known = F.least(F.size(a["ids"]), F.size(a["lps"]), F.size(a["mask"]), n)
    valid = lambda i: (i < known) & (F.get(a["mask"], i) > 0) & (F.get(F.col(response), i) > 0)
    flags = F.transform(response, lambda _, i: F.when(F.coalesce(valid(i), F.lit(False)), 1).otherwise(0))
    rows = rows.withColumn("action_mask", flags)
    return rows.withColumns(
        {
            "action_ids": F.transform("action_mask", lambda m, i: F.when(m > 0, F.get(a["ids"], i)).otherwise(F.get(F.col("tokens"), i))),
            "action_lps": F.transform("action_mask", lambda m, i: F.when(m > 0, F.get(a["lps"], i)).otherwise(F.lit(0.0))),
        }
    )


def attach_rows(
    df: DataFrame, masks: DataFrame, exported: DataFrame, actions: DataFrame | None = None, traj=("seq_id",), t: str = "t",
    token: str = "tok", mask: str = "mask",
) -> DataFrame:
    """``attach_masks`` on token rows.

    ``masks`` holds (traj, t, flag) of exported teacher masks, which may be shorter or longer than the
    response, ``exported`` a row for each trajectory that has one: a trajectory without is an error.
    ``actions`` holds (traj, t, id, lp, flag) of draft actions.
    """
    traj = list(traj)
    there = exported.select(*traj, F.lit(True).alias("_known")).distinct()
    rows = df.join(there, traj, "left")
    checked = F.when(F.col("_known").isNull(), F.raise_error(F.lit("a row has no teacher mask")).cast("int"))
    rows = rows.withColumn("_ok", checked.otherwise(1)).join(masks.select(*traj, t, F.col("flag").alias("_raw")), [*traj, t], "left")
    on = F.col(mask) > 0
    rows = rows.withColumn("teacher_mask", F.when((F.col("_ok") > 0) & (F.col("_raw") > 0) & on, 1).otherwise(0)).drop("_known", "_ok", "_raw")
    if actions is None:
        return rows
    given = actions.select(*traj, t, F.col("id").alias("_id"), F.col("lp").alias("_lp"), F.col("flag").alias("_act"))
    rows = rows.join(given, [*traj, t], "left").withColumn("action_mask", F.when((F.col("_act") > 0) & on, 1).otherwise(0))
    taken = F.col("action_mask") > 0
    return rows.withColumns({
        "action_id": F.when(taken, F.col("_id")).otherwise(F.col(token)), "action_lp": F.when(taken, F.col("_lp")).otherwise(F.lit(0.0)),
    }).drop("_id", "_lp", "_act")


def mixed_objective(
    df: DataFrame, teacher_loss: str = "rkl", action: str = "emitted", coef: float = 1.0, max_clamp: float | None = None,
    low: float = 0.2, high: float = 0.2, c: float = 3.0, mode: str = "token-mean", traj=("seq_id",), batch=("step",),
) -> DataFrame:
    """Objective of rollouts in which a teacher wrote some tokens (forward values only).

    Student tokens are scored by policy gradient on the k1 estimate. Teacher tokens get the same
    with ``rkl``, or ``coef`` times the ``fkl`` column. With ``action="student_draft"`` the k1
    estimate of teacher tokens uses the draft's log-prob, and a missing draft is an error.
    """
    if action not in ("emitted", "student_draft"):
        raise ValueError(f"unknown action token {action}")
    if teacher_loss not in ("rkl", "fkl"):
        raise ValueError(f"unknown teacher loss {teacher_loss}")
    m = F.col("mask") > 0
    teacher, student = m & (F.col("teacher_mask") > 0), m & ~(F.col("teacher_mask") > 0)
    target = F.col("teacher_lp")
    drafted = F.lit(False)
    if action == "student_draft":
        drafted = teacher & (F.col("action_mask") > 0)
        lost = F.raise_error(F.lit("a teacher token has no draft action")).cast("double")
        target = F.when(drafted, F.col("action_lp")).when(teacher, lost).otherwise(target)
    k1 = kl("k1", F.col("cur_lp"), target)
    fkl = F.greatest(F.col("fkl"), F.lit(0.0)) if teacher_loss == "fkl" else F.lit(0.0)
    if max_clamp is not None:
        k1, fkl = clamp(k1, -max_clamp, max_clamp), F.least(fkl, F.lit(max_clamp))
    rows = df.withColumns({"_k1": k1, "_fkl": fkl, "_teacher": teacher, "_student": student, "_drafted": drafted})
    pg, shares = audit.clip_terms(F.col("cur_lp"), F.col("old_lp"), -F.col("_k1"), low, high, c)
    rows = rows.withColumn("_pg", pg)
    pg_mask = F.col("mask") if teacher_loss == "rkl" else F.col("_student").cast("int")
    token = F.col("_pg") if teacher_loss == "rkl" else (
        F.when(F.col("_student"), F.col("_pg")).when(F.col("_teacher"), coef * F.col("_fkl")).otherwise(0.0)
    )
    total_loss = audit.reduce_audit(rows, token, {}, mode, traj=traj, batch=batch, name="loss")
    count = lambda cond: F.count(F.when(cond, 1))
    n, n_teacher = F.greatest(F.sum("mask"), F.lit(1)), count(F.col("_teacher"))
    mean = lambda v, cond: F.coalesce(masked_mean(v, cond.cast("int")), F.lit(0.0))
    cells = [
        (n_teacher / n).alias("teacher_ratio"),
        (count(F.col("_student")) / n).alias("student_ratio"),
        masked_mean(F.col("_pg"), pg_mask).alias("pg_loss"),
        mean(F.col("_pg"), F.col("_teacher")).alias("teacher_pg_loss"),
        (count(F.col("_drafted")) / F.greatest(n_teacher, F.lit(1))).alias("action_coverage"),
        F.avg(F.when(m, F.abs("_k1"))).alias("abs_loss"),
        F.coalesce(F.avg(F.when(F.col("_student"), -F.col("_k1"))), F.lit(0.0)).alias("adv_mean_student"),
        F.coalesce(F.stddev_pop(F.when(F.col("_student"), -F.col("_k1"))), F.lit(0.0)).alias("adv_std_student"),
    ]
    cells += [(masked_sum(v.cast("double"), pg_mask) / (F.sum(pg_mask) + 1e-8)).alias(k) for k, v in shares.items()]
    if action == "student_draft":
        differs = F.when(F.col("_drafted"), (F.col("action_id") != F.col("tok")).cast("double"))
        cells.append(F.coalesce(F.avg(differs), F.lit(0.0)).alias("action_mismatch"))
    if teacher_loss == "fkl":
        cells += [
            mean(F.col("_fkl"), F.col("_teacher")).alias("fkl_loss"),
            F.coalesce(F.max(F.when(F.col("_teacher"), F.col("_fkl"))), F.lit(0.0)).alias("fkl_loss_max"),
        ]
    return total_loss.join(rows.groupBy(*batch).agg(*cells), list(batch))


def token_divergence(df: DataFrame, k: int = 128) -> DataFrame:
    """Per teacher token: log-probs of the teacher's argmax and of the draft on both sides, gaps, masses, renormalised KL."""
    tiny = 1e-30
    lp = df.withColumns({"_t": log_softmax(F.col("teacher")), "_s": log_softmax(F.col("student"))})
    lp = lp.withColumn("_ids", top_ids(F.col("_t"), k)).withColumn("argmax", F.element_at("_ids", 1))
    top = lp.withColumns(
        {
            "_tp": F.transform(gather(F.col("_t"), F.col("_ids")), lambda v: F.exp(v)),
            "_sp": F.transform(gather(F.col("_s"), F.col("_ids")), lambda v: F.greatest(F.exp(v), F.lit(tiny))),
        }
    )
    masses = top.withColumns(
        {"teacher_mass": F.greatest(total(F.col("_tp")), F.lit(tiny)), "student_mass": F.greatest(total(F.col("_sp")), F.lit(tiny))}
    )
    q = lambda p: p / F.col("teacher_mass")
    fkl = total(F.zip_with("_tp", "_sp", lambda p, s: q(p) * (F.log(F.greatest(q(p), F.lit(tiny))) - F.log(s))))
    at = lambda c, i: F.element_at(c, i + 1)
    return masses.withColumns(
        {
            "fkl_renorm": fkl,
            "teacher_argmax_lp": at("_t", F.col("argmax")),
            "student_argmax_lp": at("_s", F.col("argmax")),
            "teacher_draft_lp": at("_t", F.col("draft")),
            "student_draft_lp": at("_s", F.col("draft")),
        }
    ).withColumn("gap", F.col("teacher_argmax_lp") - F.col("student_argmax_lp")).drop("_t", "_s", "_ids", "_tp", "_sp")
