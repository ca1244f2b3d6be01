"""Near duplicates by Order MinHash, with candidates verified by a banded alignment.

A text is the sequence of its 5-word k-mers; the t-th occurrence of a k-mer is labelled t, so labels
are distinct within a text. A sketch takes the few k-mers with the smallest hash and keeps them in
the order of the text; texts that agree in one of the sketches meet in a bucket. Within a bucket
every pair of texts is compared, in blocks of bounded size, first by the number of common k-mers and
then by an alignment, a longest increasing chain of common k-mers inside a band. Two texts are linked
when the aligned k-mers are at least 0.8 of all k-mers of either. The classes are the connected
components of the links.

Equal word sequences are one text from the start. Tasks return links that join texts not yet
joined, never all pairs of a group.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import components, keep_rows, row_key, table, text_slices, written
from trajtable.llm.words import Tokenizer, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 5  # words in a k-mer
SIMILARITY = 0.8
SKETCHES = 16
KEPT = 3  # k-mers in a sketch: texts at 0.8 agree in one with about 0.5, and miss all with about 1e-5
BLOCK = 512  # texts of a bucket compared at once; larger buckets are compared block by block
GOLD = np.uint64(0x9E3779B97F4A7C15)


def kmers(t) -> tuple[np.ndarray, np.ndarray]:
    """Labelled k-mers of all texts in order, and bounds; texts of 1 to K - 1 words are one k-mer."""
    words = np.diff(t.bounds)
    sizes = np.where(words >= K, words - K + 1, np.minimum(words, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first = t.bounds[doc] + np.arange(bounds[-1]) - bounds[doc]
    stop = t.bounds[doc + 1]
    h = np.zeros(len(doc), np.uint64)
    for j in range(K):
        at = first + j
        word = np.where(at < stop, t.hashes[np.minimum(at, len(t.hashes) - 1)], np.uint64(0)) if len(h) else h
        h = mix(h * np.uint64(3) + word)
    # the occurrence number of a k-mer within its text
    key = h ^ mix(doc.astype(np.uint64) + GOLD)
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    place = np.arange(len(key))
    number = np.empty(len(key), np.uint64)
    number[order] = (place - np.maximum.accumulate(np.where(fresh, place, 0))).astype(np.uint64)
    return mix(h + number * GOLD), bounds


def sketches(labels: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """SKETCHES keys for each text with k-mers: the KEPT least k-mers under each hash, in text order."""
    sizes = np.diff(bounds)
    full = np.flatnonzero(sizes)
    out = np.zeros((len(sizes), SKETCHES), np.int64)
    if not len(full):
        return out
    starts, reps = bounds[full], sizes[full]
    end = np.uint64(0xFFFFFFFFFFFFFFFF)
    seeds = mix(np.arange(1, SKETCHES + 1).astype(np.uint64) * GOLD)
    for s, seed in enumerate(seeds):
        v = (labels ^ seed) * (seed | np.uint64(1))
        v ^= v >> np.uint64(32)
        places = np.full((KEPT, len(full)), len(labels), np.int64)
        for r in range(KEPT):
            least = np.minimum.reduceat(v, starts)
            spots = np.flatnonzero(v == np.repeat(least, reps))
            owner = np.searchsorted(starts, spots, "right") - 1
            owner, one = np.unique(owner, return_index=True)
            spots = spots[one]
            live = least[owner] != end
            places[r, owner[live]] = spots[live]
            v[spots] = end
        places.sort(axis=0)
        key = np.full(len(full), seed, np.uint64)
        padded = np.append(labels, np.uint64(0))
        for r in range(KEPT):
            key = mix(key * np.uint64(3) + padded[places[r]])
        out[full, s] = key.view(np.int64)
    return out


def text_keys(t, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the word sequence; a text without words has those of its characters."""
    words = np.diff(t.bounds)
    full = np.flatnonzero(words)
    keys = np.zeros((2, len(words)), np.uint64)
    place = (np.arange(len(t.hashes)) - np.repeat(t.bounds[:-1], words)).astype(np.uint64)
    for k, salt in enumerate((GOLD, np.uint64(0xD6E8FEB86659FD93))):
        if len(full):
            keys[k, full] = np.add.reduceat(mix((t.hashes ^ salt) + place * salt), t.bounds[full])
    for i in np.flatnonzero(words == 0).tolist():
        raw = texts[i].as_py().encode()
        keys[0, i], keys[1, i] = xxhash.xxh64_intdigest(raw, 1), xxhash.xxh64_intdigest(raw, 2)
    return keys[0].view(np.int64), keys[1].view(np.int64)


def sketched(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """_k1, _k2 (row key), doc_id, t1, t2 (text key), sketch keys; written, as three steps read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = Tokenizer()
        for batch in batches:
            for a, b in text_slices(batch.column(3)):
                part = batch.slice(a, b - a)
                texts = pc.fill_null(part.column(3), "")
                t = tokenize(texts)
                found = sketches(*kmers(t))
                full = np.diff(t.bounds) > 0
                keys = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(full * SKETCHES)]).astype(np.int32)), pa.array(found[full].ravel())
                )
                t1, t2 = text_keys(t, texts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(t1), pa.array(t2), keys],
                    names=["_k1", "_k2", "doc_id", "t1", "t2", "sketch"],
                )

    rows = docs.select(*row_key(text, doc_id), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(run, f"_k1 bigint, _k2 bigint, doc_id {kind}, t1 bigint, t2 bigint, sketch array<bigint>"))


def with_kmers(rows: DataFrame) -> DataFrame:
    """(node, text) to (node, kmers): the labelled k-mers as packed 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = Tokenizer()
        for batch in batches:
            for a, b in text_slices(batch.column(1)):
                labels, bounds = kmers(tokenize(pc.fill_null(batch.column(1).slice(a, b - a), "")))
                short = labels.astype(np.uint32)
                packed = [short[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(packed, pa.binary())], names=["node", "kmers"])

    return rows.select("node", "text").mapInArrow(run, "node bigint, kmers binary")


def aligned(x: np.ndarray, y: np.ndarray) -> int:
    """Common k-mers in the same order in both, each at most a band of (n + m) / 9 off its place.

    Texts at a similarity of 0.8 differ by at most (n + m) / 9 insertions and deletions of k-mers,
    so a chain that leaves the band cannot reach it.
    """
    _, at_x, at_y = np.intersect1d(x, y, return_indices=True)
    order = np.argsort(at_x)
    at_x, at_y = at_x[order], at_y[order]
    at_y = at_y[np.abs(at_x - at_y) <= (len(x) + len(y)) / 9]
    if np.all(at_y[1:] > at_y[:-1]):
        return len(at_y)
    tails: list[int] = []
    for p in at_y.tolist():
        i = bisect_left(tails, p)
        if i == len(tails):
            tails.append(p)
        else:
            tails[i] = p
    return len(tails)


def similar(common: float, n: int, m: int) -> bool:
    return common >= SIMILARITY * (n + m - common) - 1e-9


def common_counts(texts: list[np.ndarray]) -> np.ndarray:
    """Number of common labelled k-mers of every two texts of a block."""
    g = len(texts)
    owner = np.repeat(np.arange(g), [len(x) for x in texts])
    _, column, counts = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    owner, column = owner[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((g, g), np.float32)
    for low in range(0, int(shared.sum()), 2048):
        a, b = np.searchsorted(column, [low, low + 2048])
        dense = np.zeros((g, 2048), np.float32)
        dense[owner[a:b], column[a:b] - low] = 1
        out += dense @ dense.T
    return out


def block_links(nodes: list[int], texts: list[np.ndarray], side: list[int], cross: bool) -> list[tuple[int, int]]:
    """Verified links that join the similar texts of a block; with ``cross`` only between its sides."""
    sizes = np.array([len(x) for x in texts], np.float64)
    common = common_counts(texts)
    enough = np.triu(common >= SIMILARITY * (sizes[:, None] + sizes[None] - common) - 1e-6, 1)
    left, right = np.nonzero(enough)
    root = list(range(len(nodes)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for k in np.argsort(-common[left, right], kind="stable").tolist():
        i, j = int(left[k]), int(right[k])
        if cross and side[i] == side[j]:
            continue
        a, b = find(i), find(j)
        if a != b and similar(aligned(texts[i], texts[j]), len(texts[i]), len(texts[j])):
            root[b] = a
            links.append((nodes[i], nodes[j]))
    return links


def verified(members: DataFrame) -> DataFrame:
    """Links (src, dst) from rows (bucket, low, high, side, node, kmers), one block after another.

    The rows of a block lie together in a sorted partition, so a task holds one block at a time:
    at most about 2 x BLOCK texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(6)))

        current, block, links = None, ([], [], []), []

        def close():
            if current is not None and len(block[0]) > 1:
                links.extend(block_links(*block, current[1] != current[2]))

        for bucket, low, high, side, node, packed in rows():
            if (bucket, low, high) != current:
                close()
                current, block = (bucket, low, high), ([], [], [])
            block[0].append(node)
            block[1].append(np.frombuffer(packed, np.uint32))
            block[2].append(side)
            if len(links) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["src", "dst"])
                links = []
        close()
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links)], names=["src", "dst"])

    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["bucket", "low", "high", "side", "node", "kmers"]
    dealt = members.select(*columns).repartition(parts, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return dealt.mapInArrow(run, "src bigint, dst bigint")


def near_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, group_id (least doc_id of the class), group_size, kept and the row key.

    One row per document; a document without near duplicates is a class of its own. One document of a
    class is kept, the one with the least doc_id (null last); rows equal in id and text are one
    document, kept or not together. Null text counts as empty; texts
    without words are equal only if their characters are. Texts of fewer than five words are one
    k-mer, so they are near only when their words are equal. An empty table gives an empty result;
    other columns are not read.
    """
    rows = sketched(docs, text, doc_id)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_k1", "_k2")).alias("first")
    # one node for each distinct word sequence
    nodes = written(
        rows.groupBy("t1", "t2").agg(first, F.count(F.lit(1)).alias("n_docs"), F.any_value("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    spread = nodes.select("node", F.explode("sketch").alias("bucket"))
    meets = (
        spread.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.min("node").alias("a"), F.max("node").alias("b"))
        .where("n > 1")
    )
    # buckets with the same members are compared once
    chosen = meets.groupBy("n", "x", "a", "b").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    members = written(spread.join(chosen, "bucket"))
    active = members.select("node").distinct().join(nodes.select("node", "first._k1", "first._k2"), "node")
    texts = docs.select(*row_key(text, doc_id), F.col(text).alias("text")).join(active, ["_k1", "_k2"], "inner")
    # rows equal in id and text are one node: any of them will do
    packed = with_kmers(texts).dropDuplicates(["node"])
    side = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = members.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("bucket", "node", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"))
    links = written(verified(dealt.join(packed, "node")))
    roots = components(links)
    classes = nodes.join(roots.withColumnRenamed("id", "node"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = classes.groupBy("root").agg(F.min("first").alias("best"), F.sum("n_docs").alias("group_size"))
    named = classes.select("t1", "t2", "root").join(best, "root").select("t1", "t2", "best", "group_size")
    # a class may hold a third of all rows: a skewed partition of this join is split at run time
    out = rows.select("doc_id", "_k1", "_k2", "t1", "t2").join(named, ["t1", "t2"])
    kept = (F.col("_k1") == F.col("best._k1")) & (F.col("_k2") == F.col("best._k2"))
    return out.select("doc_id", F.col("best.doc_id").alias("group_id"), "group_size", kept.alias("kept"), "_k1", "_k2")


def without_near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each class, with its own columns.

    Which row stays, and what null and empty texts, repeated rows and empty tables give, is said at
    ``near_groups``. Columns may have any names.
    """
    return keep_rows(docs, near_groups(docs, text, doc_id).where("kept"), text, doc_id)


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("_k1", "_k2")
