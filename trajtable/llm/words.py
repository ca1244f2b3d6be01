"""Words and tokens of text batches as 64-bit hashes, computed over the bytes with NumPy.

Words are maximal runs of ASCII letters and digits and of all bytes above ASCII; A-Z counts as a-z.
Hashes are prefix sums of a polynomial modulo 2**64, so a batch needs no loop over words.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE = 0x9E3779B97F4A7C15 | 1
PIECE = 1 << 20
STEM = 5


def _byte_tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.zeros(256, np.uint8)  # 0: white space, 1: word, 2: anything else
    kind[:] = 2
    kind[[9, 10, 11, 12, 13, 32]] = 0
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[a:b] = 1
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    return kind, lower


KIND, LOWER = _byte_tables()


class Tokens(NamedTuple):
    hashes: np.ndarray  # uint64 per token
    bounds: np.ndarray  # tokens of text i are bounds[i]:bounds[i + 1]
    starts: np.ndarray  # byte positions in ``data``
    ends: np.ndarray
    data: np.ndarray  # the bytes of all texts
    stems: np.ndarray  # hashes of the first STEM bytes

    def text(self, i: int) -> bytes:
        return LOWER[self.data[self.starts[i] : self.ends[i]]].tobytes()


def mix(h: np.ndarray) -> np.ndarray:
    """Final mixing, so that low bits can be used as table positions."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Tokenizer:
    """Keeps the powers of the polynomial between batches."""

    def __init__(self, fold_case: bool = True, punctuation: bool = False, stems: bool = False):
        self.fold, self.punctuation, self.stems = fold_case, punctuation, stems
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, PIECE + 1)
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, texts: pa.Array) -> Tokens:
        texts = texts.cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[: offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
        at, first = int(offsets[0]) if len(offsets) else 0, []
        found: list[tuple[np.ndarray, ...]] = []
        while at < len(data):
            span = PIECE
            while True:  # cut between tokens; a token longer than the span widens it
                end = min(at + span, len(data))
                kind = KIND[data[at:end]]
                if end == len(data):
                    break
                gaps = np.flatnonzero(kind[-4096:] == 0)
                if not len(gaps):
                    gaps = np.flatnonzero(kind == 0)
                    shift = 0
                else:
                    shift = max(0, len(kind) - 4096)
                if len(gaps):
                    end = at + shift + int(gaps[-1]) + 1
                    kind = kind[: end - at]
                    break
                span *= 2
            found.append(self._piece(data[at:end], kind, at, offsets))
            at = end
        if found:
            hashes, starts, ends, stems = (np.concatenate(x) for x in zip(*found))
        else:
            hashes, starts, ends, stems = (np.zeros(0, k) for k in (np.uint64, np.int64, np.int64, np.uint64))
        return Tokens(hashes, np.searchsorted(starts, offsets), starts, ends, data, stems)

    def _piece(self, part, kind, at, offsets):
        if not self.punctuation:
            kind = np.where(kind == 1, kind, 0)
        before = np.empty_like(kind)
        before[0] = 255
        before[1:] = kind[:-1]
        inner = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, at + len(part))] - at
        before[inner] = 255  # a text begins here
        edge = np.flatnonzero(kind != before)
        tail = np.append(edge[1:], len(part))
        token = kind[edge] > 0
        starts, ends = edge[token], tail[token]
        self._grow(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        letters = LOWER[part] if self.fold else part
        np.cumsum((letters.astype(np.uint64) + np.uint64(1)) * self.powers[: len(part)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverse[starts])
        stems = hashes
        if self.stems:
            stems = mix((sums[np.minimum(ends, starts + STEM)] - sums[starts]) * self.inverse[starts] + np.uint64(1))
        return hashes, starts.astype(np.int64) + at, ends.astype(np.int64) + at, stems
