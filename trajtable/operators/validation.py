"""Validation and benchmark summaries."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajtable.functions import resample
from trajtable.plans.skew import by_sort, join_on, materialise, ranked, running, spread, with_stats

FEW_VALUES = 256  # different values of a group that one window looks at


def rows_n() -> Column:
    return F.count(F.lit(1))


def first_per_problem(df: DataFrame, keys: Sequence[str], value: str, index: str) -> Column:
    return F.min_by(value, index)


def bench_summary(df: DataFrame, keys: Sequence[str], problem: str, correct: str, index: str) -> DataFrame:
    """avg@k (mean over problems of mean correctness), pass@1 (first sample), pass@k (any)."""
    per = df.groupBy(*keys, problem).agg(
        F.avg(correct).alias("_avg"), F.min_by(correct, index).alias("_first"), F.max(correct).alias("_any"), rows_n().alias("_n")
    )
    return per.groupBy(*keys).agg(
        rows_n().alias("n_problems"),
        F.max("_n").alias("n_samples"),
        F.avg("_avg").alias("avg_at_k"),
        F.avg("_first").alias("pass_at_1"),
        F.avg((F.col("_any") > 0).cast("double")).alias("pass_at_k"),
    )


def bench_pool(summaries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pool shard summaries weighted by problems; no problems at all is an error."""
    n = F.sum("n_problems")
    empty = F.raise_error(F.lit("no problems to pool")).cast("double")
    mean = lambda c: F.when(n <= 0, empty).otherwise(F.sum(F.col(c) * F.col("n_problems")) / n).alias(c)
    return summaries.groupBy(*keys).agg(
        n.alias("n_problems"), mean("avg_at_k"), mean("pass_at_1"), mean("pass_at_k"), F.max("wall_seconds").alias("wall_seconds")
    )


def bench_status(shards: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``shards`` has one row per shard (null shard = root) with ``avg_at_k`` (null = no summary) and log size.

    Done when a root summary exists, or some shard is done and none is partial.
    """
    has = F.col("avg_at_k").isNotNull()
    root = F.max((F.col("shard").isNull() & has).cast("int")) == 1
    some = F.max((F.col("shard").isNotNull() & has).cast("int")) == 1
    partial = F.max((F.col("shard").isNotNull() & ~has & (F.col("log_bytes") > 0)).cast("int")) == 1
    weight = F.when(has, F.when(F.col("n_problems") > 0, F.col("n_problems")).otherwise(1))
    return shards.groupBy(*keys).agg(
        (root | (some & ~partial)).alias("done"), (F.sum(F.col("avg_at_k") * weight) / F.sum(weight)).alias("avg_at_k")
    )


def best_step(status: DataFrame, run: Sequence[str], benches: Sequence[str], step: str = "step", bench: str = "bench") -> DataFrame:
    """Step with the highest mean over the benches, earliest step on ties; all benches must be done."""
    ready = status.where(F.col(bench).isin(*benches) & F.col("done") & F.col("avg_at_k").isNotNull())
    steps = ready.groupBy(*run, step).agg(rows_n().alias("_n"), (100 * F.sum("avg_at_k") / len(benches)).alias("_avg"))
    steps = steps.where(F.col("_n") == len(benches))
    return steps.groupBy(*run).agg(
        F.max_by(step, F.struct("_avg", -F.col(step))).alias("peak_step"), F.max("_avg").alias("peak_avg"), rows_n().alias("steps_done")
    )


def majority(df: DataFrame, keys: Sequence[str], vote: str, value: str, index: str) -> DataFrame:
    """Most frequent vote (ties: the one seen first) and the first value given with it."""
    votes = df.groupBy(*keys, vote).agg(
        rows_n().alias("_n"), F.min(index).alias("_first"), F.min_by(value, index).alias("_value")
    )
    best = F.struct(F.col("_n"), -F.col("_first"))
    return votes.groupBy(*keys).agg(
        F.max_by(vote, best).alias("majority"), F.max_by("_value", best).alias("value"),
        F.max("_n").alias("votes"), (F.max("_n") / F.sum("_n")).alias("agreement"),
    )


# --- bootstrap -----------------------------------------------------------------------------------


def point_metrics(df: DataFrame, variables: Sequence[str], keys=("data_source", "uid")) -> DataFrame:
    """mean@n, and population std@n when n > 1, per prompt."""
    stats = df.groupBy(*keys).agg(
        rows_n().alias("n"), *[f(v).alias(f"{v}_{k}") for v in variables for k, f in (("mean", F.avg), ("std", F.stddev_pop))]
    )
    name = lambda p: F.concat(F.lit(f"{p}@"), F.col("n").cast("string"))
    cells = []
    for v in variables:
        cells.append(F.struct(F.lit(v).alias("variable"), name("mean").alias("metric"), F.col(f"{v}_mean").alias("value")))
        spread = F.when(F.col("n") > 1, F.col(f"{v}_std"))
        cells.append(F.struct(F.lit(v).alias("variable"), name("std").alias("metric"), spread.alias("value")))
    return stats.select(*keys, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def bootstrap_metrics(
    df: DataFrame, variables: Sequence[str], pred: str | None = "pred", keys=("data_source", "uid"), seed: int = 42, rounds: int = 1000,
) -> DataFrame:
    """best, worst and maj of m samples drawn with replacement, m = 2, 4, 8, ... and n, per prompt.

    One rule for every number of samples. Best and worst are the mean and deviation over all draws, in
    closed form from the ranks of the values. The majority is resampled ``rounds`` times on the counts
    of the answers; the value is that of a random row with the winning answer. Answers drawn equally
    often win with equal chances. Prompts with one sample give no rows.
    """
    keys = list(keys)
    parts = [extremes(df, variables, keys)]
    if pred is not None:
        parts.append(resampled_majority(df, variables, pred, keys, seed, rounds))
    return reduce(lambda x, y: x.unionByName(y), parts)


def resample_sizes(n: Column) -> Column:
    """2, 4, 8, ... below n, then n."""
    powers = F.transform(F.sequence(F.lit(1), F.lit(62)), lambda i: F.pow(F.lit(2.0), i).cast("bigint"))
    return F.concat(F.filter(powers, lambda s: s < n), F.array(n))


def moment_cells(variable: Column, kinds: dict[str, tuple[Column, Column]]) -> Column:
    """Metric rows from the first and second moment of each kind, by the column ``size``."""
    cells = []
    for kind, (one, two) in kinds.items():
        label = F.concat(F.lit(f"{kind}@"), F.col("size").cast("string"))
        std = F.sqrt(F.greatest(two - one * one, F.lit(0.0)))
        for moment, value in (("mean", one), ("std", std)):
            cells.append(F.struct(variable.alias("variable"), F.concat(label, F.lit(f"/{moment}")).alias("metric"), value.alias("value")))
    return F.array(*cells)


def extremes(df: DataFrame, variables: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Best and worst of m draws: a value whose equals take the ranks from r + 1 to s of n is the best with
    probability (s / n) ** m - (r / n) ** m, so every value knows its share from its ranks alone.

    Rows are reduced to the counts of their values, whose running sums are the ranks. Groups of at most
    FEW_VALUES different values are summed in a window of their own, larger ones in pieces over all tasks.
    """
    keys = list(keys)
    long = df.select(*keys, F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("_x")) for v in variables])))
    group = [*keys, "variable"]
    counts = materialise(long.where(F.col("_x").isNotNull()).groupBy(*group, "_x").agg(rows_n().alias("_c")))
    many = materialise(counts.groupBy(*group).agg(rows_n().alias("_values")).where(F.col("_values") > FEW_VALUES).select(*group))
    c, whole = F.col("_c"), Window.partitionBy(*group)
    so_far = whole.orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    if many.isEmpty():
        ranks = counts.withColumns({"_s": F.sum(c).over(so_far), "n": F.sum(c).over(whole)})
    else:
        ranks = join_on(counts, many, group, "left_anti").withColumns({"_s": F.sum(c).over(so_far), "n": F.sum(c).over(whole)})
        large = by_sort(join_on(counts, many, group, "left_semi"), group, [F.col("_x")])
        ranks = ranks.unionByName(running(large, group, [F.col("_x")], behind={"_s": c}, whole={"n": c}).select(ranks.columns))
    ranks = ranks.where(F.col("n") > 1)
    ranks = ranks.withColumn("size", F.explode(resample_sizes(F.col("n"))))
    r, s, n, m, x = F.col("_s") - F.col("_c"), F.col("_s"), F.col("n"), F.col("size"), F.col("_x")
    shares = {"b": F.pow(s / n, m) - F.pow(r / n, m), "w": F.pow((n - r) / n, m) - F.pow((n - s) / n, m)}
    moments = ranks.groupBy(*group, "size").agg(*[F.sum(w * v).alias(f"{k}{i}") for k, w in shares.items() for i, v in ((1, x), (2, x * x))])
    cells = moment_cells(F.col("variable"), {"best": (F.col("b1"), F.col("b2")), "worst": (F.col("w1"), F.col("w2"))})
    return moments.select(*keys, F.inline(cells))


def resampled_majority(df: DataFrame, variables: Sequence[str], pred: str, keys: Sequence[str], seed: int, rounds: int) -> DataFrame:
    """Value of a random row with the answer drawn most often.

    Who wins depends on the counts of the answers alone. Prompts with the same counts (a *shape*: how many
    answers have each count) share one set of draws, made on the counts in blocks of rounds, so the cost
    follows the number of different answers and not the number of samples.
    """
    keys = list(keys)
    answers = df.groupBy(*keys, pred).agg(rows_n().alias("_c"), *[F.avg(e).alias(f"{v}_{i}") for v in variables for i, e in ((1, F.col(v)), (2, F.col(v) * F.col(v)))])
    # answers with equal counts have equal chances: they are one row from here on
    sums = [F.sum(f"{v}_{i}").alias(f"{v}_{i}") for v in variables for i in (1, 2)]
    by_count = materialise(answers.groupBy(*keys, "_c").agg(rows_n().alias("_answers"), *sums))
    cell = F.struct("_c", "_answers")
    # n samples have less than sqrt(2 n) different counts
    shapes = by_count.groupBy(*keys).agg(F.sort_array(F.collect_list(cell), asc=False).alias("_shape"), F.sum(F.col("_c") * F.col("_answers")).alias("n"))
    shapes = shapes.where(F.col("n") > 1).withColumn("_name", F.array_join(F.transform("_shape", lambda x: F.concat_ws("x", x["_c"], x["_answers"])), ","))
    one = shapes.select("_name", "_shape", "n").dropDuplicates(["_name"])
    blocks = one.withColumn("size", F.explode(resample_sizes(F.col("n")))).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit((rounds - 1) // resample.BLOCK))))
    shares = spread(blocks, ["_name", "size", "_block"]).mapInPandas(resample.majority_shares(seed, rounds), "_name string, size bigint, _c bigint, _w double")
    shares = shares.groupBy("_name", "size", "_c").agg((F.sum("_w") / rounds).alias("_w"))
    named = join_on(by_count, shapes.select(*keys, "_name"), keys)
    won = named.join(shares, ["_name", "_c"])
    moments = won.groupBy(*keys, "size").agg(*[F.sum(F.col("_w") * F.col(f"{v}_{i}")).alias(f"{v}_{i}") for v in variables for i in (1, 2)])
    cells = F.concat(*[moment_cells(F.lit(v), {"maj": (F.col(f"{v}_1"), F.col(f"{v}_2"))}) for v in variables])
    return moments.select(*keys, F.inline(cells))


def val_metrics(df: DataFrame, variables: Sequence[str], pred: str | None = "pred", rounds: int = 1000) -> DataFrame:
    """Mean over prompts of every per-prompt metric, by data source, variable and metric name."""
    numeric = [v for v in variables if dict(df.dtypes)[v] != "string"]
    df = materialise(df.select("data_source", "uid", *numeric, *([pred] if pred else [])))  # read three times
    per_uid = point_metrics(df, numeric).unionByName(bootstrap_metrics(df, numeric, pred, rounds=rounds))
    return per_uid.groupBy("data_source", "variable", "metric").agg(F.avg("value").alias("value"))


def val_sections(metrics: DataFrame) -> DataFrame:
    """Name each metric ``val-core/...`` or ``val-aux/...``.

    Core: the variable is acc (reward where a source has no acc), the metric is a mean, maj or best
    and uses the largest n of its variable.
    """
    n = F.regexp_extract("metric", r"@(\d+)", 1).cast("int")
    rows = with_stats(metrics.withColumn("_n", n), ["data_source", "variable"], F.max("_n").alias("_n_max"))
    acc = F.max((F.col("variable") == "acc").cast("int")).alias("_acc")
    rows = with_stats(rows, ["data_source"], acc)
    core_var = F.when(F.col("_acc") == 1, "acc").otherwise("reward")
    core = (
        (F.col("variable") == core_var) & F.col("metric").rlike("^(mean|maj|best)")
        & F.col("metric").contains(F.concat(F.lit("@"), F.col("_n_max").cast("string")))
    )
    key = F.concat_ws("/", F.when(core, "val-core").otherwise("val-aux"), "data_source", "variable", "metric")
    return rows.select(key.alias("key"), "value")


def turn_stats(df: DataFrame, turns: str) -> DataFrame:
    """num_turns min, max and mean as val-aux rows."""
    one = df.agg(F.min(turns).alias("min"), F.max(turns).alias("max"), F.avg(turns).alias("mean"))
    cells = [F.struct(F.lit(f"val-aux/num_turns/{k}").alias("key"), F.col(k).cast("double").alias("value")) for k in ("min", "max", "mean")]
    return one.select(F.inline(F.array(*cells)))


def drawn(n: Column, size: Column, number: Column, seed: int) -> Column:
    """1-based position of a draw; the same for all groups of n rows."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), n.cast("string"), size.cast("string"), number.cast("string"))), 1, 13), 16, 10)
    return (F.floor(bits.cast("bigint") / float(2**52) * n) + 1).cast("bigint")


def group_reduce(
    df: DataFrame, keys: Sequence[str], value: str, index: str, reducers: Mapping[str, Callable], size: int, seed: int = 42, rounds: int = 100,
) -> DataFrame:
    """Caller-supplied reducers over ``rounds`` resamples of ``size`` values: mean and deviation per group.

    A group sends the rows at the drawn positions to its task, at most rounds x size of them whatever
    its size. Draws are those of ``drawn``.
    """
    keys = list(keys)
    rows = ranked(df.select(*keys, F.col(value).cast("double").alias(value), index), keys, [F.col(index)], out="_i")
    rows = with_stats(rows, keys, rows_n().alias("_n"))
    wanted = rows.select("_n").distinct().withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(rounds * size - 1))))
    wanted = wanted.select("_n", drawn(F.col("_n"), F.lit(size), F.col("_k"), seed).alias("_i")).distinct()
    picked = rows.join(wanted, ["_n", "_i"]).groupBy(*keys, "_n").agg(F.array_sort(F.collect_list(F.struct("_i", value))).alias("_s"))
    pick = lambda c: F.transform("_s", lambda x: x[c])
    picked = spread(picked.select(*keys, "_n", pick("_i").alias("_i"), pick(value).alias("_v")), keys)
    kinds = {f.name: f.dataType.simpleString() for f in picked.schema}
    schema = ", ".join([*[f"{k} {kinds[k]}" for k in keys], *[f"{r}_{k} double" for r in reducers for k in ("mean", "std")]])
    return picked.mapInPandas(resample.reduce_batches(keys, dict(reducers), size, seed, rounds), schema)
