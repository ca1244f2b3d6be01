"""Approximate nearest neighbours by learned partitions.

On a bounded sample the neighbour graph is cut into balanced parts (spectral bisection, then swaps
that lower the number of cut edges), and a small network learns to tell the parts of a vector's
neighbours. The network deals every row of the table to its likeliest part, and a query to its
several likeliest ones, whose rows are reranked by the exact inner product. How many parts a query
visits is measured: sample queries are searched by brute force over all rows, and the fewest parts
that hold the wanted share of their neighbours are taken.

The parts are dealt to a fixed number of shares of equal size, a part that is too large (or one vector that
a third of all rows have) to several. A task holds a bounded number of queries and their best so far while
the rows of one share stream by, so neither a share nor a part has to fit it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajtable.llm.common import share, shared, smallest, table, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP = 20
SAMPLE = 16_384  # vectors the parts and the network are fitted on
SAMPLE_BYTES = 64_000_000  # of these vectors
PART_ROWS = 64  # rows of an average part, until there are MOST_PARTS
MOST_PARTS = 256
PROBES = 128  # sample queries that set the number of visited parts
RECALL = 0.97  # share of their neighbours in the visited parts
SHARES = 16  # into which all rows are dealt by their parts
CHUNK = 8_192  # queries that a task holds
SCORES = 2_000_000  # inner products held at once inside a tile
EDGES = 20  # neighbours of a vector in the graph
HIDDEN = 128


# --- fitted on the sample ----------------------------------------------------------------------


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` rows with the largest inner product with each row, itself left out."""
    out = np.empty((len(x), k), np.int32)
    for a in range(0, len(x), 512):
        near = x[a : a + 512] @ x.T
        near[np.arange(len(near)), np.arange(a, a + len(near))] = -np.inf
        out[a : a + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def halves(near: np.ndarray, rng: np.random.Generator, rounds: int = 40, swaps: int = 12) -> np.ndarray:
    """0 or 1 for each vertex, equally many of both, with few edges between the two.

    The graph's second eigenvector, by power iteration, is cut at its median; then equal numbers of
    vertices of both sides change places as long as that removes edges.
    """
    n = len(near)
    src = np.repeat(np.arange(n), near.shape[1])
    dst = near.ravel()
    inside = dst >= 0
    a, b = np.concatenate([src[inside], dst[inside]]), np.concatenate([dst[inside], src[inside]])
    degree = np.bincount(a, minlength=n) + 1.0
    v = rng.normal(size=n)
    for _ in range(rounds):
        v -= (v * degree).sum() / degree.sum()
        v = (np.bincount(a, v[b], minlength=n) + v) / degree
        v /= np.abs(v).max() + 1e-300
    side = np.zeros(n, np.int8)
    side[np.argsort(v, kind="stable")[n // 2 :]] = 1
    for _ in range(swaps):
        other = np.bincount(a, side[a] != side[b], minlength=n)
        gain = 2 * other - (degree - 1)  # edges that vanish if the vertex alone changes sides
        zero, one = (np.flatnonzero(side == s) for s in (0, 1))
        zero, one = (i[np.argsort(-gain[i], kind="stable")] for i in (zero, one))
        m = min(len(zero), len(one))
        together = gain[zero[:m]] + gain[one[:m]]
        move = np.flatnonzero(together > 0)
        if not len(move):
            break
        move = move[: max(1, len(move) // 2)]  # moved at once, vertices may undo each other's gain
        before = np.count_nonzero(side[a] != side[b])
        trial = side.copy()
        trial[zero[move]], trial[one[move]] = 1, 0
        if np.count_nonzero(trial[a] != trial[b]) >= before:
            break
        side = trial
    return side


def balanced_parts(near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """The part of each vertex; ``parts`` is a power of two, and sizes differ by one at most per cut."""
    label = np.zeros(len(near), np.int64)
    while (done := label.max(initial=0) + 1) < parts:
        wider = label * 2
        for p in range(done):
            rows = np.flatnonzero(label == p)
            place = np.full(len(near), -1, np.int64)
            place[rows] = np.arange(len(rows))
            wider[rows] += halves(place[near[rows]], rng)
        label = wider
    return label


def fit_router(x: np.ndarray, near: np.ndarray, part: np.ndarray, parts: int, rng: np.random.Generator, epochs: int = 24) -> list[np.ndarray]:
    """Weights of a two-layer network from a vector to the parts of its neighbours (soft labels, Adam)."""
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.arange(len(x))[:, None], part[near]), 1.0)
    np.add.at(goal, (np.arange(len(x)), part), 1.0)
    goal /= goal.sum(1, keepdims=True)
    w = [rng.normal(size=(x.shape[1], HIDDEN)) * np.sqrt(2 / x.shape[1]), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts)]
    m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
    for epoch in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            h = np.maximum(x[rows] @ w[0] + w[1], 0)
            p = h @ w[2] + w[3]
            p = np.exp(p - p.max(1, keepdims=True))
            d = (p / p.sum(1, keepdims=True) - goal[rows]) / len(rows)
            dh = (d @ w[2].T) * (h > 0)
            step += 1
            rate = 3e-3 * (1 - epoch / epochs)
            for i, g in enumerate((x[rows].T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return w


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # first by the largest component, whose square may not fit a double
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def routed(w: list[np.ndarray] | None, x: np.ndarray, m: int) -> np.ndarray:
    """The ``m`` likeliest parts of each vector, the likeliest first."""
    if w is None or not len(x):
        return np.zeros((len(x), 1), np.int32)
    chances = np.maximum(unit(x) @ w[0] + w[1], 0) @ w[2] + w[3]
    return np.argsort(-chances, axis=1, kind="stable")[:, :m].astype(np.int32)


def fit(x: np.ndarray, parts: int) -> list[np.ndarray] | None:
    """The router of a sample; vectors count by direction. None for one part."""
    if parts < 2:
        return None
    rng = np.random.default_rng(7)
    x = unit(x)
    near = neighbour_graph(x, min(EDGES, len(x) - 1))
    return fit_router(x, near, balanced_parts(near, parts, rng), parts, rng)


# --- in the tasks ------------------------------------------------------------------------------


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(lists), -1)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added in one order, so that equal vectors have equal scores."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


def best_of(q: np.ndarray, ids: np.ndarray, score: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``top`` best of every query, ties to the smaller id; of several vectors of one id the best."""
    by = np.lexsort((-score, ids, q))
    q, ids, score = q[by], ids[by], score[by]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
    q, ids, score = q[fresh], ids[fresh], score[fresh]
    by = np.lexsort((ids, -score, q))
    q, ids, score = q[by], ids[by], score[by]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < top
    return q[keep], ids[keep], score[keep]


class Search:
    """A chunk of queries, and the best items of each among the rows seen so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, visits: np.ndarray, top: int):
        self.ids, self.vectors, self.visits, self.top = ids, vectors, visits, top
        self.q, self.found, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.floor = np.full(len(ids), -np.inf)  # the score of the last of ``top`` items

    def look(self, item_ids: np.ndarray, items: np.ndarray, parts: np.ndarray) -> None:
        """Compare the queries with the rows of the parts that they visit.

        Equal vectors are compared once, and of their ids the smallest that could be listed are kept.
        """
        raw = np.ascontiguousarray(items).view(np.dtype((np.void, items.dtype.itemsize * items.shape[1]))).ravel()
        _, first, same = np.unique(raw, return_index=True, return_inverse=True)
        order = np.lexsort((item_ids, same))
        order = order[np.concatenate([[True], (np.diff(same[order]) != 0) | (np.diff(item_ids[order]) != 0)])]  # an id once
        begins = np.searchsorted(same[order], np.arange(len(first) + 1))
        near_q, near_u = self.candidates(items[first], parts[first])
        sizes = np.minimum(np.diff(begins)[near_u], self.top + 1)
        score = np.repeat(products(self.vectors[near_q], items[first[near_u]]), sizes)
        ids = item_ids[order[np.repeat(begins[near_u], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]]
        q = np.repeat(near_q, sizes)
        other = ids != self.ids[q]
        self.q, self.found, self.score = best_of(
            np.concatenate([self.q, q[other]]), np.concatenate([self.found, ids[other]]), np.concatenate([self.score, score[other]]), self.top
        )
        ends = np.searchsorted(self.q, np.arange(len(self.ids)), "right")
        full = ends - np.searchsorted(self.q, np.arange(len(self.ids))) == self.top
        self.floor[full] = self.score[ends[full] - 1]

    def candidates(self, items: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, item) that may be among the best: with a margin, as these products are added in any order."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for p in np.unique(parts):
            kinds, asked = np.flatnonzero(parts == p), np.flatnonzero((self.visits == p).any(1))
            step = max(1, SCORES // len(kinds))
            for a in range(0, len(asked), step):
                rows = asked[a : a + step]
                near = self.vectors[rows] @ items[kinds].T
                cut = self.floor[rows]
                if len(kinds) > self.top + 1:  # one more, as the query's own vector may be among them
                    at = len(kinds) - self.top - 1
                    cut = np.maximum(cut, np.partition(near, at, axis=1)[:, at])
                finite = np.where(np.isfinite(cut), cut, 0.0)
                q, u = np.nonzero(near >= (cut - 1e-9 * (1 + np.abs(finite)))[:, None])
                found.append((rows[q], kinds[u]))
        q, u = map(np.concatenate, zip(*found))
        return q, u


# --- on Spark ----------------------------------------------------------------------------------


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part: an id, and a finite vector that is not zero."""
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    found = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("vector"))
    return found.where(F.col("id").isNotNull() & x.isNotNull()).where(finite & F.exists(x, lambda v: v != 0))


def _with_parts(rows: DataFrame, router, m: int) -> DataFrame:
    """id, vector and the ``m`` likeliest parts."""
    handle = share(rows.sparkSession, router)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared(handle)
        for batch in batches:
            for a in range(0, batch.num_rows, 4_096):
                part = batch.slice(a, 4_096)
                got = routed(w, matrix(part.column(1)), m)
                parts = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1, dtype=np.int32) * got.shape[1]), pa.array(got.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), parts], names=["id", "vector", "parts"])

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.select("id", "vector").mapInArrow(run, f"id bigint, vector {kind}, parts array<int>")


def _true_parts(items: DataFrame, ids: np.ndarray, x: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Probe and part of each of the ``top`` nearest of every probe, by brute force over all items."""
    handle = share(items.sparkSession, (ids, x))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe_ids, probes = shared(handle)
        for batch in batches:
            for a in range(0, batch.num_rows, 4_096):
                rows = batch.slice(a, 4_096)
                near = probes @ matrix(rows.column(1)).T
                near[probe_ids[:, None] == rows.column(0).to_numpy()[None, :]] = -np.inf
                k = min(top, near.shape[1])
                at = np.argpartition(-near, k - 1, axis=1)[:, :k]
                probe = np.repeat(np.arange(len(probes)), k)
                columns = [pa.array(probe, pa.int32()), pa.array(rows.column(2).to_numpy()[at.ravel()], pa.int32()), pa.array(near[probe, at.ravel()])]
                yield pa.RecordBatch.from_arrays(columns, names=["probe", "part", "score"])

    found = items.select("id", "vector", "part").mapInArrow(run, "probe int, part int, score double").where(F.col("score") > float("-inf"))
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.col("score").desc(), "part"))
    got = found.withColumn("_n", place).where(F.col("_n") <= top).select("probe", "part").toArrow()
    return got.column("probe").to_numpy(), got.column("part").to_numpy()


def visited(items: DataFrame, queries: DataFrame, router, parts: int, sizes: np.ndarray, top: int, recall: float) -> int:
    """The fewest parts in which ``recall`` of the true neighbours of the probes lie."""
    if parts == 1:
        return 1
    probes = smallest(queries.withColumn("_h", F.xxhash64("id", "vector")), "_h", PROBES).select("id", "vector").toArrow()
    if not probes.num_rows:
        return 1
    x = matrix(probes.column(1))
    probe, part = _true_parts(items, probes.column(0).to_numpy(), x, top)
    place = np.argsort(routed(router, x, parts), axis=1)[probe, part]
    share_in = np.cumsum(np.bincount(place, minlength=parts)) / max(1, len(place))
    enough = np.cumsum(np.sort(sizes)) > top  # parts that surely hold ``top`` items beside the query's own
    return int(min(parts, 1 + max(np.argmax(share_in >= recall), np.argmax(enough) if enough.any() else parts - 1)))


def search(
    items: DataFrame, queries: DataFrame, top: int = TOP, vec_id: str = "vec_id", vector: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """query_id, rank, vec_id, score: the nearest items of each query by inner product, ties to the smaller id.

    A query never finds an item with its own id. Rows without id and vectors that are null, zero,
    not finite, or not of the most frequent length take no part. Rows with one id are one item (or
    query), whose score is its best vector's. Fewer than ``top`` items: all of them. An empty table
    on either side gives no rows; other columns are not read.
    """
    spark = items.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    items, queries = usable(items, vec_id, vector), usable(queries, vec_id, vector)
    lengths = items.groupBy(F.size("vector").alias("d")).count().orderBy(F.col("count").desc(), "d").first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d, n = lengths
    items, queries = (x.where(F.size("vector") == d) for x in (items, queries))
    parts = 1 << int(np.clip(np.log2(max(1, n / PART_ROWS)), 0, np.log2(MOST_PARTS)))
    size = max(2 * EDGES, min(SAMPLE, SAMPLE_BYTES // (8 * d)))
    sample = matrix(smallest(items.select("vector", F.xxhash64("vector").alias("_h")), "_h", size).orderBy("_h").select("vector").toArrow().column(0))
    while parts > max(1, len(sample) // 4):  # few different vectors
        parts //= 2
    router = fit(sample, parts)
    index = written(_with_parts(items, router, 1).select("id", "vector", F.col("parts")[0].alias("part")))
    sizes = np.zeros(parts, np.int64)
    for part, count in index.groupBy("part").count().collect():  # a row for each part
        sizes[part] = count
    m = visited(index, queries, router, parts, sizes, top, recall)

    # parts one after another fill shares of n / SHARES rows; a part that goes over a border lies in both
    ends = np.cumsum(sizes)
    low = (ends - sizes) * SHARES // n
    high = np.maximum(low, (np.maximum(ends, 1) - 1) * SHARES // n)
    numbers = lambda values: F.array(*[F.lit(int(v)) for v in values])
    pick = lambda values, p: F.element_at(numbers(values), p + 1)
    chunks = max(1, -(-queries.count() // CHUNK))
    # a row of a part in several shares goes to one of them by its id
    width = pick(high - low + 1, F.col("part"))
    placed = index.withColumn("share", pick(low, F.col("part")) + F.pmod(F.xxhash64("id"), width).cast("int"))
    placed = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    reached = F.transform("parts", lambda p: F.sequence(pick(low, p), pick(high, p)))
    asked = _with_parts(queries, router, m).select("id", "vector", "parts", F.explode(F.array_distinct(F.flatten(reached))).alias("share"))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int"))
    none = F.lit(None)
    rows = asked.select("share", "chunk", F.lit(0).alias("kind"), none.cast("int").alias("part"), "id", "vector", "parts").unionByName(
        placed.select("share", "chunk", F.lit(1).alias("kind"), "part", "id", "vector", none.cast("array<int>").alias("parts"))
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The queries of a share and chunk come first, then its rows."""
        current, held, search_ = None, [], None

        def result():
            if search_ is not None and len(search_.q):
                columns = [pa.array(search_.ids[search_.q]), pa.array(search_.found), pa.array(search_.score)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

        for batch in batches:
            key = np.stack([batch.column(i).to_numpy() for i in range(3)])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                if a == b:
                    continue
                part, where, kind = batch.slice(a, b - a), (int(key[0, a]), int(key[1, a])), int(key[2, a])
                if where != current:
                    yield from result()
                    current, held, search_ = where, [], None
                if kind == 0:
                    held.append((part.column(4).to_numpy(), matrix(part.column(5)), matrix(part.column(6)).astype(np.int32)))
                    continue
                if held:
                    search_, held = Search(*(np.concatenate(x) for x in zip(*held)), top), []
                if search_ is not None:
                    search_.look(part.column(4).to_numpy(), matrix(part.column(5)), part.column(3).to_numpy())
        yield from result()

    keys = ["share", "chunk", "kind"]
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), SHARES * chunks)
    found = rows.repartition(tasks, "share", "chunk").sortWithinPartitions(*keys, "part")
    found = found.mapInArrow(stream, "query_id bigint, vec_id bigint, score double").repartition("query_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op11_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % 20 == 0))
