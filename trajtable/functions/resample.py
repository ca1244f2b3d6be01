"""Seeded resamples inside a task (NumPy): caller-supplied reducers, and majorities on answer counts.

This module is sent to the executors by value, so it must not create Spark columns.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 250  # rounds that one task draws at a time
SLAB = 1 << 20  # resampled values that a reducer gets at a time, or one group


def draws(n: int, size: int, rounds: int, seed: int = 42) -> np.ndarray:
    """1-based resample positions (rounds, size); they depend on the seed and the sizes only."""
    bits = [int(hashlib.md5(f"{seed}:{n}:{size}:{k}".encode()).hexdigest()[:13], 16) for k in range(rounds * size)]
    return (np.floor(np.array(bits) / 2.0**52 * n).astype(np.int64) + 1).reshape(rounds, size)


def reduce_batches(keys: Sequence[str], reducers: Mapping[str, Callable], size: int, seed: int, rounds: int):
    """Mean and deviation of the reducers over the resamples of every group.

    A group comes as the sorted positions that are drawn (``_i``) and their values (``_v``). A reducer
    takes a (resamples, size) array and ``axis=1``, as NumPy reducers do, and reduces each row on its
    own. Groups of n rows share their draws: slabs of them are reduced in one call, resamples that
    are drawn twice once.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            out = pdf[list(keys)].copy()
            got = {f"{name}_{k}": np.empty(len(pdf)) for name in reducers for k in ("mean", "std")}
            numbers, places, values = pdf["_n"].to_numpy(), pdf["_i"].to_numpy(), pdf["_v"].to_numpy()
            for n in np.unique(numbers).tolist():
                if n not in cache:
                    cache[n] = np.unique(draws(n, size, rounds, seed), axis=0, return_inverse=True)
                different, every = cache[n]
                groups = np.flatnonzero(numbers == n)
                step = max(1, SLAB // (rounds * size))
                for rows in (groups[a : a + step] for a in range(0, len(groups), step)):
                    # equal n means equal positions
                    spots = np.searchsorted(places[rows[0]], different)
                    samples = np.stack([np.asarray(values[i], float) for i in rows])[:, spots]
                    for name, reducer in reducers.items():
                        each = np.asarray(reducer(samples.reshape(-1, size), axis=1)).reshape(len(rows), -1)[:, every.ravel()]
                        got[f"{name}_mean"][rows], got[f"{name}_std"][rows] = each.mean(axis=1), each.std(axis=1)
            yield out.assign(**got)

    return run


def uniforms(text: str, rounds: range, number: int) -> np.ndarray:
    """Seeded numbers in [0, 1), one for each round."""
    bits = [int(hashlib.md5(f"{text}:{r}:{number}".encode()).hexdigest()[:13], 16) for r in rounds]
    return np.array(bits) / 2.0**52


def binomials(trials: np.ndarray, ones: int, others: int, u: np.ndarray) -> np.ndarray:
    """Quantile ``u`` of Binomial(trials, ones / (ones + others)): how many values have a distribution function below u.

    The function is summed over twelve deviations around the mean, beyond which no double lies.
    """
    out = np.zeros(len(trials), np.int64)
    p = ones / (ones + others)
    for m in np.unique(trials).tolist():
        rows = trials == m
        wide = 12 * math.sqrt(m * p * (1 - p)) + 12
        low, high = max(0, math.floor(m * p - wide)), min(m, math.ceil(m * p + wide))
        k = np.arange(low, high + 1)
        first = math.lgamma(m + 1) - math.lgamma(low + 1) - math.lgamma(m - low + 1) + low * math.log(p) + (m - low) * math.log1p(-p)
        steps = np.log((m - k[:-1]) / (k[:-1] + 1.0)) + math.log(p) - math.log1p(-p)
        below = np.cumsum(np.exp(first + np.concatenate([[0.0], np.cumsum(steps)])))
        out[rows] = np.minimum(low + np.searchsorted(below, u[rows], "left"), high)
    return out


def winning_shares(shape: Sequence[tuple[int, int]], size: int, rounds: range, seed: int) -> list[float]:
    """For each count of ``shape`` (count, number of answers), how often one of its answers wins, ties shared.

    An answer's number of draws is binomial given those of the answers before it, so every round is one
    pass over the answers. The result is the sum over ``rounds``, divided by the number of answers.
    """
    text = f"{seed}:{','.join(f'{c}x{a}' for c, a in shape)}:{size}"
    left, rest = np.full(len(rounds), size, np.int64), sum(c * a for c, a in shape)
    most, ties = np.zeros(len(rounds), np.int64), np.zeros((len(shape), len(rounds)))
    number = 0
    for i, (count, answers) in enumerate(shape):
        for _ in range(answers):
            rest -= count
            got = binomials(left, count, rest, uniforms(text, rounds, number)) if rest else left
            left = left - got
            ties[:, got > most] = 0
            most = np.maximum(most, got)
            ties[i] += (got == most) & (got > 0)
            number += 1
    return (ties / ties.sum(0)).sum(1).tolist() if len(rounds) else [0.0] * len(shape)


def majority_shares(seed: int, rounds: int):
    """Rows (_name, size, _c, _w): the wins of an answer with count _c in a block of rounds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, shape, size, block in zip(pdf["_name"], pdf["_shape"], pdf["size"], pdf["_block"]):
                shape = [(int(x["_c"]), int(x["_answers"])) for x in shape]
                wins = winning_shares(shape, int(size), range(block * BLOCK, min(rounds, (block + 1) * BLOCK)), seed)
                yield pd.DataFrame({"_name": name, "size": size, "_c": [c for c, _ in shape], "_w": [w / a for w, (_, a) in zip(wins, shape)]})

    return run
