"""Column expressions on log-probabilities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low: float | None = None, high: float | None = None) -> Column:
    if high is not None:
        x = F.least(x, F.lit(float(high)))
    return F.greatest(x, F.lit(float(low))) if low is not None else x


def kl(kind: str, lp: Column, ref: Column) -> Column:
    """Per-token KL estimate. A trailing ``+`` changes gradients only, so the value is the same."""
    kind = kind.removesuffix("+")
    if kind in ("kl", "k1"):
        return lp - ref
    if kind == "abs":
        return F.abs(lp - ref)
    if kind in ("mse", "k2"):
        return 0.5 * (lp - ref) * (lp - ref)
    if kind in ("low_var_kl", "k3"):
        d = clamp(ref - lp, -20, 20)
        return clamp(F.exp(d) - d - 1, -10, 10)
    raise ValueError(f"unknown KL estimator {kind}")


def policy_ratio(lp: Column, old: Column, bound: float = 20.0) -> Column:
    return F.exp(clamp(lp - old, -bound, bound))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    A value computed inside the lambda of an array function is computed for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def pipe(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """Run a value through steps, each evaluated once however often the next one refers to it."""
    if not steps:
        return value
    return let(value, lambda v: pipe(steps[0](v), *steps[1:]))


def total(x: Column) -> Column:
    """Sum of a double array."""
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def logsumexp(x: Column) -> Column:
    return let(F.array_max(x), lambda top: top + F.log(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.exp(v - top))))


def log_softmax(x: Column) -> Column:
    return let(logsumexp(x), lambda z: F.transform(x, lambda v: v - z))


def softmax(x: Column) -> Column:
    return let(logsumexp(x), lambda z: F.transform(x, lambda v: F.exp(v - z)))


def entropy(logits: Column) -> Column:
    """logsumexp - sum(p * logit)."""
    return let(
        logsumexp(logits),
        lambda z: z - F.aggregate(logits, F.lit(0.0), lambda a, v: a + F.exp(v - z) * v),
    )


def sum_pi_squared(logits: Column) -> Column:
    return let(logsumexp(logits), lambda z: F.aggregate(logits, F.lit(0.0), lambda a, v: a + F.exp(2 * (v - z))))


def top_ids(scores: Column, k: int) -> Column:
    """Ids of the k largest entries, largest first; equal scores go to the lowest id."""
    ranked = F.array_sort(F.transform(scores, lambda v, i: F.struct((-v).alias("v"), i.alias("i"))))
    return F.transform(F.slice(ranked, 1, k), lambda x: x.i)


def arg_max(scores: Column) -> Column:
    """Id of the largest entry, the lowest of equal ones; one pass instead of a sort."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def gather(values: Column, ids: Column) -> Column:
    return F.transform(ids, lambda i: F.element_at(values, i + 1))


def kl_on_support(p: Column, log_p: Column, log_q: Column) -> Column:
    """Sum of p (log p - log q) over entries with p > 0."""
    diff = F.zip_with(log_p, log_q, lambda a, b: a - b)
    return total(F.zip_with(p, diff, lambda a, d: F.when(a > 0, a * d).otherwise(F.lit(0.0))))
