"""Small literal cases and error cases."""

import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from trajtable.functions import answers as an
from trajtable.functions import divergence as dv
from trajtable.operators import advantage as adv
from trajtable.operators import batch, correction, distill, grading, handoff, metrics, prep, registry, validation
from trajtable.sources import files


def test_group_mean_std(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (0, 3.0)], "g int, s double")
    got = rows(adv.group_mean_std(df, "s", ["g"]), "g")
    assert got == [(0, 2.0, pytest.approx(math.sqrt(2)), 2), (1, 0.0, 1.0, 1)]


def test_labels(spark):
    df = spark.createDataFrame([("a", "s"), ("b", "s"), ("a", "s"), ("c", "s"), ("0042", "s"), ("42", "n")], "label string, kind string")
    assert metrics.label_ids(df, "label", "kind").select("group_id").distinct().count() == 5


def test_two_forms_of_grpo_agree(spark):
    df = spark.createDataFrame([(0, g, s) for g, s in ((0, 1.0), (0, 1.00001), (1, 2.0), (1, 2.00001))], "step int, uid int, score double")
    a, b = (rows(f(df).select("uid", "score", "advantage"), "uid", "score") for f in (adv.grpo, adv.grpo_from_table))
    assert [x[2] for x in a] == pytest.approx([x[2] for x in b])


def test_single_sample_rules(spark):
    df = spark.createDataFrame([(0, 1, 0.7, 3)], "step int, uid int, score double, sample_idx int")
    assert adv.rloo(df).first()["advantage"] == 0.7
    assert adv.rloo_from_sums(df).first()["advantage"] == 0.0
    with pytest.raises(Exception, match="two samples"):
        adv.grpo_passk(df).collect()


def test_multi_output(spark):
    data = [(0, "p", 0, 0, 9.0), (0, "p", 0, 1, 1.0), (0, "p", 1, 0, 3.0), (0, "q", 0, 0, 5.0)]
    df = spark.createDataFrame(data, "step int, uid string, session_id int, output_idx int, score double")
    got = {(r["uid"], r["session_id"], r["output_idx"]): r["advantage"] for r in adv.multi_output(df).collect()}
    half = 1 / (math.sqrt(2) + 1e-6)
    assert got[("p", 0, 0)] == got[("p", 0, 1)] == pytest.approx(-half)
    assert got[("p", 1, 0)] == pytest.approx(half)
    assert got[("q", 0, 0)] == pytest.approx(5 / (1 + 1e-6))


def tokens(spark, rewards, values, masks):
    data = [(0, f"s{i}", t, float(r), float(v), m) for i, (a, b, c) in enumerate(zip(rewards, values, masks)) for t, (r, v, m) in enumerate(zip(a, b, c))]
    return spark.createDataFrame(data, "step int, seq_id string, t int, reward double, value double, mask int")


@pytest.mark.parametrize("gamma,lam", [(1.0, 1.0), (0.9, 0.8)])
def test_gae_skips_observations(spark, gamma, lam):
    """Masked-out tokens in the middle do not change returns of the others, whatever their values."""
    masks = [[1, 0, 1, 1], [1, 1, 0, 1]]
    rewards = [[0, 0, 0.5, 1], [0.2, 0, 0, 1]]
    a = tokens(spark, rewards, [[0.1, 7, 0.3, 0.4], [0.2, 0.1, 9, 0.3]], masks)
    b = tokens(spark, rewards, [[0.1, -3, 0.3, 0.4], [0.2, 0.1, 2, 0.3]], masks)
    keep = lambda df: [r[2] for r in rows(adv.gae(df, gamma, lam).where("mask = 1").select("seq_id", "t", "returns"), "seq_id", "t")]
    assert keep(a) == pytest.approx(keep(b))


def test_window_and_walk_agree(spark):
    df = tokens(spark, [[0.1, 0.2, 0.3, 0.4]], [[0.5, 0.1, 0.2, 0.3]], [[1, 0, 1, 1]])
    a = rows(adv.reinforce_pp(df).select("t", "returns"), "t")
    b = rows(adv.reinforce_pp(df, 1.0 - 1e-15).select("t", "returns"), "t")
    for x, y in zip(a, b):
        assert x == pytest.approx(y)
    assert [x[1] for x in a] == pytest.approx([0.1, 0.9, 0.7, 0.4])


def test_whiten_needs_two_tokens(spark):
    with pytest.raises(Exception, match="more than one token"):
        adv.gae(tokens(spark, [[1.0]], [[0.0]], [[1]])).collect()


def test_weights_outside_bounds_are_zero(spark):
    df = spark.createDataFrame([(0, "a", t, math.log(w), 0.0, 1) for t, w in enumerate((0.4, 0.8, 6.0))], "step int, seq_id string, t int, old_lp double, rollout_lp double, mask int")
    got = [r[1] for r in rows(correction.is_weights(df, "token", "0.5_5.0").select("t", "is_weight"), "t")]
    assert got == pytest.approx([0.0, 0.8, 0.0])
    m = correction.is_metrics(df, "token", "0.5_5.0").first()
    assert m["rollout_is_oob_ratio"] == pytest.approx(2 / 3)
    assert m["rollout_is_std"] == pytest.approx(0.3771236, abs=1e-6)
    assert m["rollout_is_eff_sample_size"] == pytest.approx(1 / 3, abs=1e-6)


@pytest.mark.parametrize("bad", ["2_1", "-1", "0", "a"])
def test_bad_thresholds(bad):
    with pytest.raises(ValueError):
        correction.limits(bad)


def test_unknown_rejection_option():
    with pytest.raises(ValueError):
        correction.rejection_limits({"seq_max_k1": 1.0})


def test_topk_overlap_counts(spark):
    data = [(0, [9.0, 8.0, 7.0, 0.0, 0.0, 0.0], [0.0, 9.0, 8.0, 0.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0, 9.0, 8.0, 0.0], [0.0, 0.0, 0.0, 0.0, 9.0, 8.0]),
            (2, [9.0, 8.0, 0.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 9.0, 8.0, 0.0])]
    df = spark.createDataFrame(data, "i int, student array<double>, teacher array<double>")
    got = [r[1] for r in rows(distill.topk_tables(df, 2).select("i", "overlap"), "i")]
    assert got == [1, 1, 0]


def test_renormalised_teacher_has_mass_one(spark):
    df = spark.createDataFrame([([0.5, 0.1, -0.2, 0.3, 1.0], [1.0, 0.9, 0.1, -1.0, -2.0])], "student array<double>, teacher array<double>")
    r = distill.topk_tables(df, 3, renorm=True).first()
    z = math.log(sum(math.exp(x) for x in (0.5, 0.1, -0.2, 0.3, 1.0)))
    top = (1.0, 0.9, 0.1)
    zt = math.log(sum(map(math.exp, top)))
    want = sum(math.exp(t - zt) * ((t - zt) - (s - z)) for t, s in zip(top, (0.5, 0.1, -0.2)))
    assert r["teacher_mass"] == 1.0 and r["loss"] == pytest.approx(want)


def test_majority_ties_go_to_the_first_seen(spark):
    df = spark.createDataFrame([(1, "A", 0.9, 0), (1, "B", 0.8, 1), (1, "B", 0.6, 2), (1, "A", 0.7, 3), (2, "A", 0.9, 0), (2, "B", 0.8, 1), (2, "A", 0.7, 2)], "u int, p string, v double, i int")
    got = rows(validation.majority(df, ["u"], "p", "v", "i").select("u", "value"), "u")
    assert got == [(1, 0.9), (2, 0.9)]


def test_validation_mean(spark):
    df = spark.createDataFrame([("s", 1, 0.8), ("s", 1, 0.9)], "data_source string, uid bigint, score double")
    got = {r["metric"]: r["value"] for r in validation.point_metrics(df, ["score"]).collect()}
    assert got["mean@2"] == pytest.approx(0.85) and got["std@2"] == pytest.approx(0.05)


def test_throughput(spark):
    sizes = spark.createDataFrame([(0, 200, 100), (0, 200, 100)], "step int, resp_len int, prompt_len int")
    timing = spark.createDataFrame([(0, "step", 2.0)], "step int, name string, seconds double")
    assert metrics.throughput(sizes, timing, 2).first()["throughput"] == 150


def test_empty_mask_gives_nan(spark):
    df = spark.createDataFrame([(0, -1.0, -1.0, 0)], "step int, old_lp double, rollout_lp double, mask int")
    r = metrics.logprob_debug(df).first()
    assert r["valid"] == 0 and math.isnan(r["diff_mean"])


def test_metric_names_decide(spark):
    df = spark.createDataFrame([(0, "x/minmax_diff", v) for v in (1.0, 3.0)] + [(0, "lr", v) for v in (1.0, 3.0)], "step int, key string, value double")
    assert rows(metrics.metric_reduce(df, ["step"]).select("key", "value"), "key") == [("lr", 2.0), ("x/minmax_diff", 3.0)]


def test_eos_mask(spark):
    df = spark.createDataFrame([(0, [20, 10, 34, 1, 0, 0, 0]), (1, [78, 0, 76, 2, 1, 0, 0]), (2, [33, 3, 98, 45, 8, 0, 0])], "i int, ids array<int>")
    got = [r[1] for r in rows(df.select("i", prep.eos_mask(F.col("ids"), [1, 2]).alias("m")), "i")]
    assert got == [[1, 1, 1, 1, 0, 0, 0], [1, 1, 1, 1, 0, 0, 0], [1] * 7]


def test_truncation_modes(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5],)], "x array<int>")
    got = df.select(*[prep.truncate(F.col("x"), 3, how).alias(how) for how in ("left", "right", "middle")]).first()
    assert tuple(got) == ([3, 4, 5], [1, 2, 3], [1, 4, 5])
    with pytest.raises(Exception, match="exceed"):
        df.select(prep.truncate(F.col("x"), 3, "error").alias("x")).collect()
    with pytest.raises(ValueError):
        prep.truncate(F.col("x"), 3, "other")


LEG_CASES = [
    # triggers, boundaries, tokens, paragraphs, legs allowed, cap -> starts, ends, completed, stop
    ([2, 4, 9], [6, 12], 20, 1, 0, 256, [2, 9], [6, 12], 2, None),
    ([2], [], 20, 1, 0, 5, [2], [7], 1, None),
    ([2, 8], [2, 5, 11], 20, 1, 0, 256, [8], [11], 1, None),
    ([2, 8], [3, 9], 20, 1, 1, 256, [2], [3], 1, 4),
    ([2, 3, 8], [], 20, 0, 2, 256, [2, 3], [2, 3], 2, 4),
    ([18], [], 20, 2, 0, 256, [18], [19], 0, None),
]


@pytest.mark.parametrize("triggers,bounds,n,par,most,cap,starts,ends,done,stop", LEG_CASES)
def test_legs(spark, triggers, bounds, n, par, most, cap, starts, ends, done, stop):
    df = spark.createDataFrame([("a", t, t in triggers, t in bounds) for t in range(n)], "traj string, t int, trigger boolean, boundary boolean")
    found = rows(handoff.leg_rows(df, ["traj"], par, most, cap), "leg")
    assert [x[2] for x in found] == starts and [x[3] for x in found] == ends
    r = handoff.legs(df, ["traj"], par, most, cap).first()
    assert (r["completed"], r["stop_pos"], r["n_legs"]) == (done, stop, len(starts))


@pytest.mark.parametrize("text,want", [
    (r"a \boxed{1} b \boxed{\frac{2}{3}} c", r"\frac{2}{3}"), (r"\boxed 7$ and", "7"), (r"\boxed{open", None), ("none", None), (r"\boxed{}", ""),
])
def test_last_boxed(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(an.last_boxed(F.col("t")).alias("x")).first()["x"] == want


@pytest.mark.parametrize("a,b,same", [
    (r"\dfrac12", r"\frac{1}{2}", True), ("0.5", "1/2", True), (r"x=3", "3", True), (r"\sqrt2", r"\sqrt{2}", True), ("3", "4", False),
    (r"5\text{ cm}", "5", True), (r"50\%", "50", True),
])
def test_boxed_equal(spark, a, b, same):
    assert spark.createDataFrame([(a, b)], "a string, b string").select(an.boxed_equal(F.col("a"), F.col("b")).alias("x")).first()["x"] is same


@pytest.mark.parametrize("raw,want", [
    ("1,234,567", "1234567"), ("12.0", "12"), (r"\text{Monday}", "Monday"), ("3 days", "3"), (r"5 \text{ meters}", "5"), (r"\frac12", r"\frac{1}{2}"),
    ("{7}", "7"), ("x or y", "x,y"), (r"7 \frac{3}{4}", "7+3/4"), (r"\left(1,2\right)", "(1,2)"),
])
def test_canonical(spark, raw, want):
    assert spark.createDataFrame([(raw,)], "t string").select(an.canonical_answer(F.col("t")).alias("x")).first()["x"] == want


@pytest.mark.parametrize("p,t,want", [("50%", "0.5", True), ("1,000", "1000", True), ("x+1", "1+x", None), ("2", "3", False), ("$5", "5", True)])
def test_numeric_equal(spark, p, t, want):
    assert spark.createDataFrame([(p, t)], "p string, t string").select(an.numeric_equal(F.col("p"), F.col("t")).alias("x")).first()["x"] is want


def test_unordered_elements(spark):
    df = spark.createDataFrame([("1, 2", "2,1.0"), (r"\pm 3", "3,-3"), ("1,1,2", "1,2,2")], "a string, b string")
    got = [r[0] for r in df.select((grading.element_multiset(F.col("a")) == grading.element_multiset(F.col("b"))).alias("x")).collect()]
    assert got == [True, True, False]


def test_registry():
    r = registry.Registry("loss", {"a": adv.grpo})
    r.register("a", adv.grpo)
    with pytest.raises(ValueError):
        r.register("a", adv.rloo)
    with pytest.raises(ValueError):
        r.get("missing")
    registry.Registry("loss", {"a": adv.grpo}, replace=True).register("a", adv.rloo)


def test_errors(spark):
    one = spark.createDataFrame([(0, "x", 1), (1, "y", 2), (2, "z", 3)], "idx bigint, k string, v int")
    with pytest.raises(Exception, match="not divisible"):
        batch.chunks(one, 2).collect()
    with pytest.raises(Exception, match="no teacher"):
        prep.route(one, "k", {"x": "t"}).collect()
    with pytest.raises(Exception, match="differs"):
        prep.union_columns(one, one.withColumn("v", F.col("v") + 1), "idx").collect()
    with pytest.raises(Exception, match="meta column"):
        batch.concat([one, one.withColumn("v", F.lit(9))], ["v"]).collect()
    with pytest.raises(ValueError):
        files.read_rows(spark, ["x.csv"])
    with pytest.raises(ValueError):
        handoff.trigger(F.lit(True), F.lit(1), F.array(F.lit(1)), 0)


def test_let_evaluates_like_plain(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],)], "x array<double>")
    r = df.select(dv.entropy(F.col("x")).alias("e"), dv.softmax(F.col("x")).alias("p")).first()
    assert sum(r["p"]) == pytest.approx(1.0) and r["e"] == pytest.approx(-sum(p * math.log(p) for p in r["p"]))


def test_speaker_messages(spark):
    kind = "i int, conversations array<struct<`from`:string,value:string>>"
    df = spark.createDataFrame([(0, [("human", "see <image>"), ("gpt", None)]), (1, []), (2, None)], kind)
    got = rows(df.select("i", prep.speaker_messages(F.col("conversations")).alias("m")), "i")
    assert got == [(0, [("user", "see <image>"), ("assistant", None)]), (1, []), (2, None)]
    with pytest.raises(Exception, match="unknown speaker: system"):
        spark.createDataFrame([(0, [("system", "x")])], kind).select(prep.speaker_messages(F.col("conversations"))).collect()


def test_epoch_goes_on_where_it_stopped(spark):
    """The rest of an order after any place is the end of the whole order, however rows are partitioned."""
    df = spark.range(200).withColumnRenamed("id", "k")
    whole = rows(prep.epoch_order(df, "k", 2, 9), "epoch", "position")
    assert [r[:2] for r in whole] == [(e, p) for e in range(2) for p in range(200)]
    assert all(sorted(k for e, _, k in whole if e == x) == list(range(200)) for x in range(2))
    assert [k for e, _, k in whole if e == 0] != [k for e, _, k in whole if e == 1]
    for place in ((0, 57), (1, 0), (1, 199)):
        rest = prep.epoch_order(df.repartition(7), "k", 2, 9, place)
        assert rows(rest, "epoch", "position") == [r for r in whole if r[:2] >= place]
    split = rows(prep.seeded_split(df, "k", 0.1, 3).groupBy("split").count(), "split")
    assert split == [("test", 20), ("train", 180)]
