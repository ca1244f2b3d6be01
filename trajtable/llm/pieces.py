"""Token ids of whole texts from those of their distinct pieces, in arrays.

Texts are cut where the pattern of byte-level tokenizers always ends a word: before a space that
follows a character which is no white space, between ASCII letters, digits and marks, and around a
single line end. The pieces of a slice of texts are one Arrow array over the bytes of the texts; each
distinct piece is encoded once, and the ids of all texts are one gather. What a Python worker
remembers from slice to slice is bounded in bytes.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EACH = 190  # bytes of a remembered piece beside its text: string, dictionary slot, numbers, ids
LONG = 200  # characters of a piece that is not worth remembering


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs ``flat[start : start + size]`` one after another."""
    ends = np.cumsum(sizes)
    return flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins (and the last ends)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


LETTER, DIGIT, MARK, QUOTE, HIGH, LINE, SPACE = range(1, 8)


def byte_kinds() -> np.ndarray:
    """The kind of every byte; 0 for control characters that are no white space."""
    kinds = np.zeros(256, np.uint8)
    kinds[33:127], kinds[128:], kinds[9:14] = MARK, HIGH, LINE
    kinds[48:58], kinds[65:91], kinds[97:123] = DIGIT, LETTER, LETTER
    kinds[39], kinds[32] = QUOTE, SPACE
    return kinds


KINDS = byte_kinds()


def cuts(data: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each byte.

    Beside an apostrophe no cut is made between letters and marks, as words such as 's go over it.
    White space beyond ASCII has two bytes from C2, or three from E1 to E3: a space after any three
    bytes from these makes no cut, which costs nothing but speed.
    """
    out, kind = np.zeros(len(data), bool), KINDS[data]
    known = (kind >= LETTER) & (kind <= MARK)
    out[1:] = known[1:] & known[:-1] & (kind[1:] != kind[:-1])
    at = np.flatnonzero(kind[1:] == SPACE) + 1
    before, one, two, three = kind[at - 1], data[at - 1], data[at - 2], np.where(at >= 3, data[at - 3], 0)
    wide = ((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | ((three >= 0xE1) & (three <= 0xE3))
    out[at] = ((before >= LETTER) & (before <= QUOTE)) | ((before == HIGH) & ~wide)
    seen = (kind >= LETTER) & (kind <= QUOTE)
    alone = np.flatnonzero((kind[1:-1] == LINE) & seen[:-2] & seen[2:]) + 1  # a single line end or tab
    out[alone] = out[alone + 1] = True
    return out


def plain(piece: str) -> bool:
    """Whether no white space is in a piece but one space at its beginning, before something else."""
    return piece.isprintable() and piece.rfind(" ") <= 0 and piece != " "


class PieceEncoder:
    """Ids of whole texts; ``encode_new`` gives the ids of distinct pieces end to end, and the number of each."""

    def __init__(self, encode_new: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], special: dict[str, int], remembered: int):
        self.encode_new, self.special = encode_new, special
        self.remembered = remembered  # bytes of pieces and ids; a matter of speed only
        names = sorted((s.encode() for s in special), key=len, reverse=True)
        self.find = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.met, self.bytes = np.zeros(0, bool), 0

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of ids of each. No text may be null."""
        data, offsets = text_bytes(texts)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        begins = cuts(data)
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        self.cut_special(texts, data, offsets, begins)
        at = np.append(np.flatnonzero(begins), len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        flat, starts, sizes = self.lookup(pieces.dictionary.to_pylist())
        which = pieces.indices.to_numpy()
        total = np.concatenate([[0], np.cumsum(sizes[which])])
        ids = gather(flat, starts[which], sizes[which])
        return ids, np.diff(total[np.searchsorted(at[:-1], offsets)])

    def cut_special(self, texts: pa.Array, data: np.ndarray, offsets: np.ndarray, begins: np.ndarray) -> None:
        """Make every special token's string a piece of its own."""
        if self.find is None:
            return
        held = np.zeros(len(texts), bool)
        for s in self.special:
            held |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(held).tolist():
            for hit in self.find.finditer(data[offsets[i] : offsets[i + 1]].tobytes()):
                a, b = offsets[i] + hit.start(), offsets[i] + hit.end()
                begins[a + 1 : b] = False
                begins[a] = True
                if b < len(data):
                    begins[b] = True

    def lookup(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for every piece where its ids begin and how many they are; new pieces are encoded and remembered."""
        if self.bytes > self.remembered:
            self.thin()
        slots = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        self.met[slots[slots >= 0]] = True
        new = np.flatnonzero(slots < 0)
        fresh = [pieces[i] for i in new.tolist()]
        ids, sizes = self.encode_fresh(fresh)
        flat, n = np.concatenate([self.flat, ids]), len(self.starts)
        starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        sizes = np.concatenate([self.sizes, sizes])
        slots[new] = n + np.arange(len(new))
        short = np.array([len(p) <= LONG for p in fresh], bool)
        if short.all():
            self.flat, self.starts, self.sizes = flat, starts, sizes
            kept = fresh
        else:
            kept = [p for p, ok in zip(fresh, short.tolist()) if ok]
            old_starts, old_sizes = starts[n:][short], sizes[n:][short]
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(old_sizes) - old_sizes])
            self.flat = np.concatenate([self.flat, gather(flat, old_starts, old_sizes)])
            self.sizes = np.concatenate([self.sizes, old_sizes])
        self.known.update(zip(kept, range(n, n + len(kept))))
        self.met = np.concatenate([self.met, np.zeros(len(kept), bool)])
        self.bytes += sum(map(len, kept)) + EACH * len(kept)
        return flat, starts[slots], sizes[slots]

    def encode_fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not pieces:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if not self.special.keys().isdisjoint(pieces):
            plain = [p for p in pieces if p not in self.special]
            ids, sizes = self.encode_new(plain) if plain else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            own = np.array([self.special.get(p, -1) for p in pieces], np.int32)
            all_sizes = np.ones(len(pieces), np.int64)
            all_sizes[own < 0] = sizes
            out = np.empty(all_sizes.sum(), np.int32)
            single = np.repeat(own >= 0, all_sizes)
            out[single], out[~single] = own[own >= 0], ids
            return out, all_sizes
        return self.encode_new(pieces)

    def thin(self) -> None:
        """Keep the pieces that were met again, at most half of what may be remembered."""
        pieces, met = list(self.known), self.met
        chosen = np.flatnonzero(met)
        weight = np.cumsum([len(pieces[i]) + EACH for i in chosen.tolist()]) if len(chosen) else np.zeros(0)
        chosen = chosen[weight <= self.remembered // 2]
        flat, starts, sizes = self.flat, self.starts[chosen], self.sizes[chosen]
        self.forget()
        self.known = {pieces[i]: k for k, i in enumerate(chosen.tolist())}
        self.flat, self.starts, self.sizes = gather(flat, starts, sizes), np.cumsum(sizes) - sizes, sizes
        self.met, self.bytes = np.zeros(len(chosen), bool), sum(map(len, self.known)) + EACH * len(chosen)
