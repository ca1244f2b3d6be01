"""Skew handling and contracts against brute force on small tables."""

import hashlib
import itertools
import math
import random
import statistics
import time
from fractions import Fraction

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from trajtable.functions import divergence, resample
from trajtable.operators import advantage as adv
from trajtable.operators import handoff, metrics, packing, prep, sampling, validation
from trajtable.operators.batch import with_index
from trajtable.plans import skew
from trajtable.plans.skew import affine, by_position, by_sort, largest, quantiles, ranked, running, with_stats


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    data = [("hot" if i % 3 == 0 else f"k{rng.randrange(12)}", rng.randrange(1000) / 7, i) for i in range(600)]
    return data, spark.createDataFrame(data, "key string, v double, i int")


def ranks_by_loop(data, key, order):
    out = {}
    for k in {key(d) for d in data}:
        for n, d in enumerate(sorted((d for d in data if key(d) == k), key=order)):
            out[d[-1]] = n + 1
    return out


def test_ranked(skewed):
    data, df = skewed
    found = {r["i"]: r["rank"] for r in ranked(df, ["key"], [F.col("v"), F.col("i")]).collect()}
    assert found == ranks_by_loop(data, lambda d: d[0], lambda d: d[1:])


@pytest.mark.parametrize("kind", ["binary", "equal", "prefix", "null"])
def test_ranked_spreads_equal_values(spark, kind):
    """0/1 scores, equal lengths, labels with a shared prefix, and null keys and values."""
    value = {"binary": lambda i: i % 2, "equal": lambda i: 7, "prefix": lambda i: f"s:user_{i // 3}", "null": lambda i: None if i % 3 else i}[kind]
    data = [(None if kind == "null" and i % 2 else "k", value(i), i) for i in range(500)]
    kinds = "string" if kind == "prefix" else "int"
    df = spark.createDataFrame(data, f"key string, v {kinds}, i int")
    found = {r["i"]: r["rank"] for r in ranked(df, ["key"], [F.col("v"), F.col("i")]).collect()}
    assert found == ranks_by_loop(data, lambda d: d[0], lambda d: (d[1] is not None, d[1] or 0 if kind != "prefix" else d[1], d[2]))


def test_with_index_keeps_null_and_sparse(spark):
    df = spark.createDataFrame([(None,), (10**15,), (-(10**15),), (3,)], "id bigint")
    assert rows(with_index(df, [F.col("id")]), "idx") == [(None, 0), (-(10**15), 1), (3, 2), (10**15, 3)]


def test_with_stats_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert rows(with_stats(df, ["k"], F.sum("v").alias("s")), "v") == [("a", 1, 1), (None, 2, 5), (None, 3, 5)]


def test_quantiles(skewed):
    data, df = skewed
    got = {r["key"]: (r["a"], r["b"]) for r in quantiles(df, ["key"], "v", {"a": 0.5, "b": 0.95}).collect()}
    for key, (a, b) in got.items():
        v = [d[1] for d in data if d[0] == key]
        assert a == pytest.approx(np.percentile(v, 50)) and b == pytest.approx(np.percentile(v, 95))


def test_top_two(spark):
    df = spark.createDataFrame([("a", 1.0, 0), ("a", 3.0, 2), ("a", 3.0, 1), ("b", 2.0, 0), ("c", 5.0, 0), ("c", 4.0, 1)], "k string, v double, i int")
    got = rows(adv.top_two(df, ["k"], "v", "i").select("k", "_max", "_second", "_best", "_rows"), "k")
    assert got == [("a", 3.0, 3.0, 1, 3), ("b", 2.0, None, 0, 1), ("c", 5.0, 4.0, 0, 2)]


def uniform_draws(n, size, rounds):
    """The draws of the engine, one by one."""
    bits = lambda k: int(hashlib.md5(f"42:{n}:{size}:{k}".encode()).hexdigest()[:13], 16)
    return [[int(bits(r * size + j) / 2**52 * n) for j in range(size)] for r in range(rounds)]


def test_group_reduce_against_loops(skewed):
    data, df = skewed
    for r in validation.group_reduce(df, ["key"], "v", "i", {"med": np.median}, 4).collect():
        v = [d[1] for d in sorted(data, key=lambda d: d[2]) if d[0] == r["key"]]
        want = [statistics.median(v[i] for i in p) for p in uniform_draws(len(v), 4, 100)]
        assert r["med_mean"] == pytest.approx(statistics.fmean(want)) and r["med_std"] == pytest.approx(statistics.pstdev(want))


def test_reducers_take_many_groups_a_call():
    """Groups of as many rows share their draws, so a call reduces a slab of them; the results are those of each alone."""
    calls = []

    def median(x, axis):
        calls.append(len(x))
        return np.median(x, axis=axis)

    rng = np.random.default_rng(2)
    sizes = [1 + i % 7 for i in range(700)]
    pdf = resample.pd.DataFrame({"k": range(700), "_n": sizes, "_i": [np.unique(resample.draws(n, 4, 100)) for n in sizes]})
    pdf["_v"] = [rng.random(len(i)) for i in pdf["_i"]]
    (got,) = resample.reduce_batches(["k"], {"m": median}, 4, 42, 100)([pdf])
    assert len(calls) == 7
    for r, n, places, values in zip(got.itertuples(), pdf["_n"], pdf["_i"], pdf["_v"]):
        want = [statistics.median(values[np.searchsorted(places, d)]) for d in resample.draws(n, 4, 100)]
        assert r.m_mean == pytest.approx(statistics.fmean(want)) and r.m_std == pytest.approx(statistics.pstdev(want))


def exact_majority(preds, values, size):
    """Mean and deviation of the majority's value over all samples of the size; ties and rows of the winner by chance."""
    n, one, two = len(preds), 0.0, 0.0
    rows_of = {p: [v for q, v in zip(preds, values) if q == p] for p in preds}
    for draw in itertools.product(preds, repeat=size):
        most = max(draw.count(p) for p in set(draw))
        tied = [p for p in set(draw) if draw.count(p) == most]
        for p in tied:
            weight = 1 / len(tied) / n**size
            one += weight * statistics.fmean(rows_of[p])
            two += weight * statistics.fmean(x * x for x in rows_of[p])
    return one, max(two - one * one, 0) ** 0.5


def test_bootstrap_against_all_samples(spark):
    """Best and worst exactly, the majority within its sampling error; prompts with equal counts share their draws."""
    rng = random.Random(1)
    data = []
    for p, n in (("a", 3), ("b", 6), ("c", 6), ("d", 5), ("e", 1)):
        preds = ["A", "B", "A", "C", "B", "A"] if p in "bc" else [rng.choice(["A", "B", None]) for _ in range(n)]
        data += [("s", p, rng.randrange(5) / 4, preds[i]) for i in range(n)]
    df = spark.createDataFrame(data, "src string, prompt string, score double, pred string")
    got = {(r["prompt"], r["metric"]): r["value"] for r in validation.bootstrap_metrics(df, ["score"], keys=("src", "prompt"), rounds=4000).collect()}
    assert {p for p, _ in got} == set("abcd")
    for p in "abcd":
        v, preds = [d[2] for d in data if d[1] == p], [d[3] for d in data if d[1] == p]
        n = len(v)
        for size in [m for m in (2, 4) if m < n] + [n]:
            every = list(itertools.product(v, repeat=size))
            for kind, pick in (("best", max), ("worst", min)):
                assert got[p, f"{kind}@{size}/mean"] == pytest.approx(statistics.fmean(map(pick, every)))
                assert got[p, f"{kind}@{size}/std"] == pytest.approx(statistics.pstdev(map(pick, every)), abs=1e-6)
            mean, std = exact_majority(preds, v, size)
            assert got[p, f"maj@{size}/mean"] == pytest.approx(mean, abs=0.03) and got[p, f"maj@{size}/std"] == pytest.approx(std, abs=0.03)


def test_extremes_sort_large_groups_alone(spark, monkeypatch):
    """Only groups of many values are sorted over all tasks; the result is the same on either way."""
    data = [(None if i % 2 else "p", (i * 7 % 5) / 4) for i in range(12)] + [("big", i / 3) for i in range(9)]
    df = spark.createDataFrame(data, "prompt string, score double")
    seen = []
    monkeypatch.setattr(validation, "by_sort", lambda df, *args: seen.append(df.count()) or by_sort(df, *args))
    alone = rows(validation.extremes(df, ["score"], ["prompt"]), "prompt", "metric")
    assert not seen
    monkeypatch.setattr(validation, "FEW_VALUES", 6)
    mixed = rows(validation.extremes(df, ["score"], ["prompt"]), "prompt", "metric")
    assert seen == [9]
    assert [r[:3] for r in alone] == [r[:3] for r in mixed] and [r[3] for r in alone] == pytest.approx([r[3] for r in mixed])


@pytest.mark.parametrize("shape, size", [([(3, 1), (2, 2)], 5), ([(5, 1), (4, 1), (1, 4)], 16), ([(400, 1), (380, 1), (100, 2)], 980)])
def test_majority_on_counts_against_plain_draws(shape, size):
    """How often answers win when counts are drawn, and when rows are drawn one by one."""
    rounds = 4000
    got = resample.winning_shares(shape, size, range(rounds), 7)
    counts = np.array([c for c, k in shape for _ in range(k)])
    of = np.repeat(np.arange(len(shape)), [k for _, k in shape])
    rng = np.random.default_rng(5)
    drawn = np.array([np.bincount(rng.choice(len(counts), size, p=counts / counts.sum()), minlength=len(counts)) for _ in range(rounds)])
    tied = drawn == drawn.max(1, keepdims=True)
    want = np.bincount(of, (tied / tied.sum(1, keepdims=True)).sum(0))
    assert sum(got) == pytest.approx(rounds) and np.abs(np.array(got) - want).max() < 5 * np.sqrt(rounds / 2)


def test_binomial_quantiles():
    """Against the distribution function summed exactly, and moments where there are too many trials for that."""
    rng = np.random.default_rng(4)
    for m, ones, others in ((0, 1, 1), (1, 1, 3), (7, 2, 5), (60, 9, 1)):
        u = rng.random(500)
        p = Fraction(ones, ones + others)
        below = list(itertools.accumulate(math.comb(m, k) * p**k * (1 - p) ** (m - k) for k in range(m + 1)))
        want = [min(m, sum(float(b) < x for b in below)) for x in u]
        assert resample.binomials(np.full(500, m), ones, others, u).tolist() == want
    m = 5_000_000
    got = resample.binomials(np.full(2000, m), 3, 7, rng.random(2000))
    assert abs(got.mean() - 0.3 * m) < 5 * np.sqrt(m * 0.21 / 2000) and abs(got.std() / np.sqrt(m * 0.21) - 1) < 0.1


def test_majority_of_a_large_prompt():
    """A prompt of 5,000,000 samples at every size: the work follows its answers."""
    shape = [(2_000_000, 1), (1_900_000, 1), (550_000, 2)]
    for size in (2, 2**22, 5_000_000):
        got = resample.winning_shares(shape, size, range(100), 42)
        assert sum(got) == pytest.approx(100) and (size == 2 or got[0] == 100)


def test_packing_contract(skewed):
    _, df = skewed
    df = df.withColumns({"step": F.lit(0), "cost": F.col("v").cast("bigint") + 1})
    bins = [r["n"] for r in packing.pack_balanced(df, 8, "cost", ["i"]).groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(bins) == 8 and sum(bins) == 600 and max(bins) - min(bins) <= 1
    grouped = packing.pack_by_group(df, 3, "cost", "key")
    assert grouped.groupBy("key").agg(F.countDistinct("bin").alias("n")).where("n > 1").count() == 0
    with pytest.raises(Exception, match="longer than the bin"):
        packing.pack_by_tokens(df, 50, "cost", ["i"]).collect()


def test_resample_follows_weights(skewed):
    data, df = skewed
    copies = sampling.resample(df.withColumn("step", F.lit(0)), "v", ["i"], method="pow", power=1.0, seed=9)
    got = {r["i"]: r["copies"] for r in copies.where("copy = 1").collect()}
    total = sum(d[1] for d in data)
    assert sum(got.values()) == 600
    for _, v, i in data:
        assert abs(got.get(i, 0) - 600 * v / total) < 2


def test_draws_equal_loop():
    assert (resample.draws(5, 3, 40) - 1).tolist() == uniform_draws(5, 3, 40)


def test_fill_batch(spark):
    """Batch ids need not start at 0; a limit counts batches, 0 is no limit, too few groups are an error."""
    data = [(10 * b, g, s) for b in range(4) for g in range(3) for s in (0.0, 1.0 if g else 0.0)]
    df = spark.createDataFrame(data, "b int, g int, acc double")
    taken = lambda **kw: rows(prep.fill_batch(df, "acc", "g", "b", **kw).select("b", "g").distinct(), "b", "g")
    assert taken(size=3, max_batches=2) == [(0, 1), (0, 2), (10, 1)]
    assert taken(size=8, max_batches=0) == [(10 * b, g) for b in range(4) for g in (1, 2)]
    with pytest.raises(Exception, match="5 groups are needed, qualified are 4"):
        taken(size=5, max_batches=2)


def test_offline_filter_seeded(spark):
    df = spark.createDataFrame([(i, 1, i) for i in range(50)], "pos int, prompt_len int, response_len int")
    pick = lambda **kw: [r[0] for r in rows(prep.offline_filter(df, "pos", max_prompt=5, **kw).select("pos"), "pos")]
    assert pick(max_rows=5) == [0, 1, 2, 3, 4]
    assert len(pick(max_rows=5, seed=3)) == 5 and pick(max_rows=5, seed=3) == pick(max_rows=5, seed=3) != pick(max_rows=5, seed=4)


def test_pack_by_group_equal_counts(spark):
    df = spark.createDataFrame([(0, g, 1 + g) for g in range(7)], "step int, uid int, cost int")
    with pytest.raises(Exception, match="7 groups cannot be dealt evenly to 3 bins"):
        packing.pack_by_group(df, 3, "cost", equal_counts=True).collect()
    assert packing.pack_by_group(df, 7, "cost", equal_counts=True).count() == 7


def trajectories(spark, lengths, seed=2):
    rng = np.random.default_rng(seed)
    data = [
        (0, 0 if g < len(lengths) - 1 else None, f"s{g}" if g else None, t, int(rng.random() > 0.2), float(rng.integers(0, 9) / 7), float(rng.integers(0, 9) / 5))
        for g, n in enumerate(lengths) for t in range(n)
    ]
    return data, spark.createDataFrame(data, "step int, uid int, seq_id string, t int, mask int, reward double, value double")


def backwards(data, gamma, lam):
    """Discounted return and held advantage of every token, by the plain loop."""
    out, groups = {}, {}
    for row in data:
        groups.setdefault(row[2], []).append(row)
    for g, cells in groups.items():
        carry = held = ahead = 0.0
        for _, _, _, t, m, r, v in sorted(cells, key=lambda c: -c[3]):
            total = r + gamma * carry
            carry = total * m
            if m:
                held, ahead = r + gamma * ahead - v + gamma * lam * held, v
            out[g, t] = (total, held)
    return out


@pytest.mark.parametrize("gamma, lam", [(1.0, 1.0), (0.9, 0.8), (0.5, 0.0)])
def test_recurrences_against_loops(spark, gamma, lam):
    """Trajectories shorter and longer than a piece, of one token, with a null id, in one table."""
    data, df = trajectories(spark, [5, 1, 0, 1500, 9000, 33])
    want = backwards(data, gamma, lam)
    df = df.withColumn("step", F.lit(0))
    got = {(r["seq_id"], r["t"]): r["returns"] for r in adv.gae(df, gamma, lam).withColumn("returns", F.col("returns") - F.col("value")).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k][1], abs=1e-9) for k in want)
    got = {(r["seq_id"], r["t"]): r["returns"] for r in adv.reinforce_pp(df, gamma).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k][0], abs=1e-9) for k in want)


@pytest.mark.parametrize("steps", [2, 8])
def test_affine_over_several_levels(spark, steps):
    """Pieces of pieces, with gaps between positions."""
    rng = random.Random(4)
    data = [(g, t * 3 + (t > 40) * 100, rng.choice([0.0, 1.0, 0.5, -0.7]), rng.random()) for g, n in (("a", 90), ("b", 1), (None, 17)) for t in range(n)]
    df = spark.createDataFrame(data, "g string, t int, a double, b double")
    want = {}
    for g in ("a", "b", None):
        x = 0.0
        for _, t, a, b in sorted((d for d in data if d[0] == g), key=lambda d: -d[1]):
            want[g, t] = (a * x + b, x)
            x = a * x + b
    got = affine(df, ["g"], "t", F.col("a"), F.col("b"), "x", "y", steps=steps)
    assert got.columns == [*df.columns, "x", "y"]
    found = {(r["g"], r["t"]): (r["x"], r["y"]) for r in got.collect()}
    assert found.keys() == want.keys() and all(found[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_one_long_trajectory(spark, monkeypatch):
    """1,000,000 tokens of one trajectory are scanned by at least 20 tasks, and by value like a plain loop."""
    n, plain = 1_000_000, skew.materialise
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(n).select(
            F.lit(0).alias("step"), F.lit("s").alias("seq_id"), F.col("id").alias("t"), F.when(F.col("id") % 7 == 3, 0).otherwise(1).alias("mask"),
            ((F.col("id") % 11) / 7.0).alias("reward"), ((F.col("id") % 5) / 3.0).alias("value"),
        )
        for gamma, lam in ((0.9, 0.8), (1.0, 1.0)):
            summed = running(by_position(df, "t"), ["seq_id"], [F.col("t")], ahead={"x": F.col("reward")})
            assert summed.select(F.spark_partition_id().alias("p"), "x").where("x >= 0").select("p").distinct().count() >= 20
            made = []  # every task that scanned tokens has left a file
            monkeypatch.setattr(skew, "materialise", lambda rows: made.append(plain(rows)) or made[-1])
            affine(df, ["seq_id"], "t", F.lit(gamma), F.col("reward"), "x")
            assert len(made[0].inputFiles()) >= 20 and made[0].count() == n
            monkeypatch.setattr(skew, "materialise", plain)
            held = ahead = 0.0
            want = np.zeros(n)
            for t in range(n - 1, -1, -1):
                if t % 7 != 3:
                    held, ahead = t % 11 / 7 + gamma * ahead - t % 5 / 3 + gamma * lam * held, t % 5 / 3
                want[t] = held
            got = adv.gae(df, gamma, lam).select("t", F.col("returns") - F.col("value")).toArrow()
            order = got.column(0).to_numpy()
            assert np.allclose(got.column(1).to_numpy(), want[order], rtol=1e-9, atol=1e-6)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("cut", ["position", "sort"])
def test_running_against_loops(spark, cut):
    rng = random.Random(6)
    data = [(g, t, rng.choice([None, 1, 2, 3])) for g, n in (("a", 300), (None, 40), ("b", 1)) for t in range(n)]
    df = spark.createDataFrame(data, "g string, t int, v int")
    rows_in = by_position(df, "t", size=16) if cut == "position" else by_sort(df, ["g"], [F.col("t")])
    got = running(rows_in, ["g"], [F.col("t")], {"a": F.col("v")}, {"b": F.col("v")}, {"c": F.col("v")})
    assert got.columns == ["g", "t", "v", "a", "b", "c"] or set(got.columns) == {"g", "t", "v", "a", "b", "c"}
    found = {(r["g"], r["t"]): (r["a"], r["b"], r["c"]) for r in got.collect()}
    for g in ("a", None, "b"):
        v = [d[2] for d in sorted((d for d in data if d[0] == g), key=lambda d: d[1])]
        for t in range(len(v)):
            after = next((x for x in v[t + 1 :] if x is not None), None)
            assert found[g, t] == (sum(x or 0 for x in v[: t + 1]), sum(x or 0 for x in v[t:]), after)


@pytest.mark.parametrize("few", [1, 50, 10_000])
def test_largest_against_sort(spark, few):
    """A hot key, equal values at the cut, all values equal, infinite and far-off values, k above the count."""
    rng = random.Random(8)
    values = {"hot": [rng.choice([0.0, 1.0, 2.5, rng.random(), -rng.random() * 1e300]) for _ in range(900)], "equal": [4.0] * 300, None: [1e308, -1e308, 3.0, 3.0, 5e-324], "few": [1.0]}
    data = [(k, v, i) for k, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(data, "k string, v double, i int")
    got = largest(df, ["k"], "v", F.greatest(F.floor(F.count(F.lit(1)) * 0.6), F.lit(1)), [F.col("i")], few=few)
    for k, vs in values.items():
        want = sorted(((-v, i) for i, v in enumerate(vs)))[: max(1, int(len(vs) * 0.6))]
        assert sorted((-r["v"], r["i"]) for r in got.where(F.col("k").eqNullSafe(F.lit(k))).collect()) == want


def legs_by_loop(triggers, bounds, n, paragraphs, most, cap):
    out, last, done = [], -1, 0
    for x in triggers:
        left = paragraphs - (x in bounds)
        if x <= last or (most and done >= most) or (paragraphs > 0 and left <= 0):
            continue
        end = x
        if paragraphs > 0:
            ahead = [b for b in range(x + 1, min(n, x + cap + 1)) if b in bounds]
            end = ahead[left - 1] if len(ahead) >= left else x + cap
        done += end < n
        out.append((x, min(end, n - 1), end < n))
        last = end
    return out


@pytest.mark.parametrize("paragraphs, most, cap", [(2, 0, 6), (1, 3, 4), (0, 5, 9), (1, 0, 1), (3, 40, 30)])
def test_legs_over_many_pieces(spark, paragraphs, most, cap):
    """Pieces of few triggers, so that ways through them are composed over several levels."""
    rng = random.Random(paragraphs * 100 + cap)
    data, want = [], {}
    for traj, n in (("a", 700), ("b", 3), (None, 90), ("c", 40)):
        triggers = [] if traj == "c" else [t for t in range(n) if rng.random() < 0.5]
        bounds = {t for t in range(n) if rng.random() < 0.2}
        data += [(traj or "null", t, t in triggers, t in bounds) for t in range(n)]
        want[traj or "null"] = legs_by_loop(triggers, bounds, n, paragraphs, most, cap)
    df = spark.createDataFrame(data, "traj string, t int, trigger boolean, boundary boolean")
    found = {k: [] for k in want}
    for r in handoff.leg_rows(df, ["traj"], paragraphs, most, cap, size=4).orderBy("traj", "leg").collect():
        found[r["traj"]].append((r["start"], r["end"], r["complete"]))
    assert found == want


def test_legs_of_100_000_triggers(spark):
    """A trajectory whose every token is a trigger takes time in proportion to its length."""
    took = {}
    for n in (25_000, 100_000):
        df = spark.range(n).select(F.lit("a").alias("traj"), F.col("id").alias("t"), F.lit(True).alias("trigger"), (F.col("id") % 3 == 0).alias("boundary"))
        start = time.time()
        r = handoff.legs(df, ["traj"], 1, 0, 256).first()
        took[n] = time.time() - start
        # a trigger that is no boundary opens a leg up to the next boundary
        assert r["n_legs"] == len([t for t in range(1, n, 3)]) and r["n_tokens"] == n
    assert took[100_000] < 4 * took[25_000] + 10


def test_opo_group_of_128_tokens(spark):
    """Quotients that end on a half at the seventh decimal are exact."""
    df = spark.createDataFrame([(0, 1, 9.0, 25), (0, 1, 2.0, 40), (0, 1, 7.0, 63)], "step int, uid int, score double, resp_len int")
    mean = (9 * 25 + 2 * 40 + 7 * 63) / 128
    assert sorted(r["advantage"] for r in adv.opo(df).collect()) == sorted([9 - mean, 2 - mean, 7 - mean])


def test_long_conversation(spark):
    """A conversation of 5,000 messages has one first question and one problem."""
    data = [(1, i, "system" if i == 0 else "user" if i % 2 else "assistant", f"m{i}") for i in range(5000)]
    ends = prep.conversation_ends(spark.createDataFrame(data, "conv_id int, i int, role string, content string"), ["conv_id"], "i")
    assert rows(ends, "conv_id") == [(1, "m0", "m1", "m4998")]


def test_data_metrics_without_critic(spark):
    tokens = spark.createDataFrame([(0, 1, "a", 1, 1.0, 0.5, 2.0, 3.0), (0, 1, "a", 1, 0.0, 0.0, 4.0, 1.0)], "step int, uid int, seq_id string, mask int, score double, reward double, adv double, returns double")
    per = metrics.response_rows(tokens).withColumn("prompt_len", F.lit(5))
    row = metrics.data_metrics(per, 10, 2).first().asDict()
    assert (row["advantages_mean"], row["returns_max"], row["response_length_clip_ratio"]) == (3.0, 3.0, 1.0)
    assert not any(k.startswith(("values", "explained")) for k in row)


def test_arg_max(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([-1.0],)], "s array<double>")
    assert [r[0] for r in df.select(divergence.arg_max(F.col("s"))).collect()] == [1, 0]
