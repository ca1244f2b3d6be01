"""Benchmark decontamination by multi-pattern search over words (Wu-Manber).

Every window of ``window`` consecutive item words is a pattern; an item with fewer words, but not
none, is one pattern. The search reads blocks of two words: a shift table tells how far the
window end may move without missing a pattern, a shift of zero selects the patterns with that
suffix block, and the bytes of the words are compared before an occurrence counts.

The patterns are broadcast in blocks of items of at most ``block_bytes`` bytes of text (checked
by a sum over the item table), so the memory of a task does not grow with the number of items.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import annotate, as_row, share, shared, size_of, table
from trajtable.llm.words import Tokenizer, Tokens, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 4_000_000
LANE = 64  # window ends that one search lane walks over


def fingerprint(rows: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of each row of word hashes."""
    h = np.zeros(len(rows), np.uint64)
    for j in range(rows.shape[1]):
        h = mix(h * np.uint64(3) + rows[:, j])
    return h


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


class Scanner:
    """Shift table and suffix buckets for patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], list[str]]):
        self.length, self.block = length, min(2, length)
        words = [w for p in patterns for w in p]
        rows = Tokenizer()(pa.array([w.decode("utf-8", "surrogateescape") for w in words])).hashes.reshape(-1, length)
        blocks = rows if self.block == 1 else pair(rows[:, :-1], rows[:, 1:])
        bits = max(10, min(24, int(blocks.size * 8).bit_length()))
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, length - self.block + 1, np.uint8)
        for q in range(blocks.shape[1]):  # a block further right allows a smaller shift
            self.shift[(blocks[:, q] & self.mask).astype(np.int64)] = blocks.shape[1] - 1 - q
        keys = np.rec.fromarrays([blocks[:, -1], fingerprint(rows)], names="suffix,whole")
        order = np.argsort(keys, order=("suffix", "whole"))
        self.keys = keys[order]
        every = list(patterns.items())
        self.texts = [b" ".join(every[i][0]) for i in order]
        self.items = [every[i][1] for i in order]

    def block_at(self, h: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return h[ends - 1] if self.block == 1 else pair(h[ends - 2], h[ends - 1])

    def search(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """First words and pattern numbers of all occurrences."""
        sizes = np.maximum(np.diff(t.bounds) - self.length + 1, 0)
        lanes = -(-sizes // LANE)
        doc = np.repeat(np.arange(len(sizes)), lanes)
        number = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = t.bounds[doc] + self.length + number * LANE
        stop = np.minimum(at + LANE, t.bounds[doc + 1] + 1)
        found = []
        while len(at):
            step = self.shift[(self.block_at(t.hashes, at) & self.mask).astype(np.int64)]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        ends = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        if not len(ends):
            return ends, ends
        starts = ends - self.length
        rows = t.hashes[starts[:, None] + np.arange(self.length)]
        suffix, whole = self.block_at(t.hashes, ends), fingerprint(rows)
        # the bucket of the suffix block, and in it the pattern with this fingerprint
        lo, hi = np.searchsorted(self.keys.suffix, suffix), np.searchsorted(self.keys.suffix, suffix, "right")
        hit = lo < hi
        starts, suffix, whole, lo, hi = starts[hit], suffix[hit], whole[hit], lo[hit], hi[hit]
        known = np.searchsorted(self.keys, np.rec.fromarrays([suffix, whole], names="suffix,whole"))
        same = (known < hi) & (self.keys.whole[np.minimum(known, len(self.keys) - 1)] == whole)
        starts, known = starts[same], known[same]
        sure = [
            b" ".join([t.text(i) for i in range(s, s + self.length)]) == self.texts[p]
            for s, p in zip(starts.tolist(), known.tolist())
        ]
        sure = np.array(sure, bool)
        return starts[sure], known[sure]


def scanners(items: list[tuple[str, str]], window: int) -> list[Scanner]:
    """Scanners by pattern length for (item id, text) pairs."""
    by_length: dict[int, dict[tuple[bytes, ...], list[str]]] = {}
    t = Tokenizer()(pa.array([x or "" for _, x in items], pa.string()))
    for k, (item, _) in enumerate(items):
        a, b = int(t.bounds[k]), int(t.bounds[k + 1])
        words = [t.text(i) for i in range(a, b)]
        length = min(window, len(words))
        for i in range(len(words) - length + 1) if length else ():
            owners = by_length.setdefault(length, {}).setdefault(tuple(words[i : i + length]), [])
            if item not in owners:
                owners.append(item)
    return [Scanner(n, p) for n, p in sorted(by_length.items())]


def _finder(handle) -> Callable:
    def prepare():
        machines, tokenize = shared(handle), Tokenizer()

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            t = tokenize(texts)
            cover = np.zeros(len(t.hashes) + 1, np.int64)
            items: list[set[str]] = [set() for _ in range(len(texts))]
            for m in machines:
                starts, known = m.search(t)
                np.add.at(cover, starts, 1)
                np.add.at(cover, starts + m.length, -1)
                docs = np.searchsorted(t.bounds, starts, "right") - 1
                for d, p in set(zip(docs.tolist(), known.tolist())):
                    items[d].update(m.items[p])
            hit = np.cumsum(cover)[:-1] > 0
            edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
            begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            spans: list[list[int]] = [[] for _ in range(len(texts))]
            owner = np.searchsorted(t.bounds, begins, "right") - 1
            for d, a, b in zip(owner.tolist(), begins.tolist(), ends.tolist()):
                while a < b:  # a run of hit words may go on in the next text
                    stop = min(b, int(t.bounds[d + 1]))
                    if a < stop:
                        spans[d] += [a - int(t.bounds[d]), stop - int(t.bounds[d])]
                    a, d = stop, d + 1
            return {
                "n_words": pa.array(np.diff(t.bounds), pa.int64()),
                "hit_spans": pa.array(spans, pa.list_(pa.int64())),
                "item_ids": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            }

        return work

    return prepare


FIELDS = [("n_words", "bigint"), ("hit_spans", "array<bigint>"), ("item_ids", "array<string>")]


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    block_bytes: int = BLOCK_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """Documents with ``n_words``, ``hit_spans`` and ``item_ids`` (sorted as strings).

    ``hit_spans`` holds from, to (exclusive) word positions of the maximal runs of hit words.
    Null or empty texts have no words; a null item id is reported as "null"; repeated items and
    repeated rows change nothing; an empty item table hits nothing. A result column replaces an
    input column of the same name.
    """
    spark = docs.sparkSession
    pairs = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("i"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    total = size_of(pairs, "t")[1]
    blocks = max(1, -(-total // block_bytes))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in dict(FIELDS)]
    out = docs if blocks == 1 else docs.select(F.struct(*keep).alias("_row"), F.col(text).alias("_text"))
    for b in range(blocks):
        # hashing spreads the items evenly over blocks, each near block_bytes
        block = pairs if blocks == 1 else pairs.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        handle = share(spark, scanners([(r.i, r.t) for r in block.collect()], window))
        if blocks == 1:
            return annotate(out, FIELDS, _finder(handle), text, keep)
        part = annotate(out, FIELDS, _finder(handle), "_text")
        if b == 0:
            out = part.withColumnsRenamed({"hit_spans": "_spans", "item_ids": "_items"})
        else:
            out = part.withColumns({"_spans": F.concat("_spans", "hit_spans"), "_items": F.array_union("_items", "item_ids")}).drop("hit_spans", "item_ids")
    merged = out.select("_row", "n_words", merged_spans(F.col("_spans")).alias("hit_spans"), F.array_sort("_items").alias("item_ids"))
    return merged.select("_row.*", "n_words", "hit_spans", "item_ids")


def merged_spans(flat):
    """Union of the spans that several blocks of items have found."""
    n = F.size(flat) / 2
    pairs = F.array_sort(F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.struct(F.element_at(flat, 2 * i - 1).alias("a"), F.element_at(flat, 2 * i).alias("b"))))
    empty = F.array().cast("array<bigint>")

    def add(acc, p):
        last = F.element_at(acc, -1)
        joins = (F.size(acc) > 0) & (p.a <= F.try_element_at(acc, F.lit(-1)))
        longer = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.greatest(last, p.b)))
        return F.when(joins, longer).otherwise(F.concat(acc, F.array(p.a, p.b)))

    return F.when(F.size(flat) == 0, empty).otherwise(F.aggregate(pairs, empty, add))


def hit_words(spans):
    """Number of hit words from the flat from, to list."""
    return F.aggregate(
        F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("bigint"), lambda a, x: a + x
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no window of any item, with their own columns.

    Null and empty texts hold none and stay; repeated rows stay or go together; an empty item table
    keeps everything, an empty table gives an empty result.
    """
    rows = docs.select(as_row(docs), F.col(options.pop("text", "text")).alias("text"))
    found = find_benchmark(rows, benchmark, keep=["_row"], **options)
    return found.where(F.size("hit_spans") == 0).select("_row.*")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = hit_words(F.col("hit_spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


OP7_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT row_number() OVER () AS r, doc_id, w FROM words),
items AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS l FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS t
  FROM (SELECT item, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT l FROM windows),
places AS (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i FROM docs, lengths WHERE len(w) >= l),
hits AS (
  SELECT r, i, p.l, item FROM places p JOIN windows x ON x.l = p.l AND x.t = array_to_string(p.w[i:i + p.l - 1], ' ')),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + l)) AS k FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
"""
