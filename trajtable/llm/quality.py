"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Each token bucket has a sparse random index vector; its word vector is the sum of the index vectors
of its neighbours over the whole corpus, so it is gathered in one pass and summed by Spark. A
document is the mean and the mean square of its word vectors. The network is trained in NumPy on
a bounded sample, and its probabilities are calibrated by one temperature.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import annotate, crc_fold, labelled_sample, share, shared, table, text_slices
from trajtable.llm.words import Tokenizer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 13
DIM = 32
ONES = 4  # non-zero entries of an index vector
REACH = 2  # neighbours on either side
HIDDEN = 16
SAMPLE_DOCS = 6_000
SAMPLE_CHARS = 50_000
KEEP_AT = 0.7


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of each bucket's index vector."""
    r = np.random.default_rng(5)
    places = np.stack([r.permutation(DIM)[:ONES] for _ in range(BUCKETS)])
    return places, r.choice([-1.0, 1.0], size=(BUCKETS, ONES))


def buckets(t) -> np.ndarray:
    return (t.hashes % np.uint64(BUCKETS)).astype(np.int64)


def tokenizer() -> Tokenizer:
    """Words and runs of marks, upper case kept apart from lower case."""
    return Tokenizer(fold_case=False, punctuation=True)


def gather(docs: DataFrame, text: str) -> np.ndarray:
    """Word vectors (BUCKETS x DIM, unit length) from the neighbours of every token of every text."""
    names = [f"v{i}" for i in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize, (places, signs) = tokenizer(), index_vectors()
        total = np.zeros(BUCKETS * DIM)
        for batch in batches:
            for a, b in text_slices(batch.column(0)):
                t = tokenize(pc.fill_null(batch.column(0).slice(a, b - a), ""))
                word = buckets(t)
                doc = np.repeat(np.arange(b - a), np.diff(t.bounds))
                for off in range(1, REACH + 1):
                    near = doc[:-off] == doc[off:]
                    left, right = word[:-off][near], word[off:][near]
                    for at, other in ((left, right), (right, left)):
                        for k in range(ONES):
                            total += np.bincount(at * DIM + places[other, k], signs[other, k], BUCKETS * DIM)
        rows = total.reshape(BUCKETS, DIM)
        used = np.flatnonzero(rows.any(axis=1))
        columns = [pa.array(used.astype(np.int32)), *(pa.array(rows[used, i].astype(np.int64)) for i in range(DIM))]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", *names])

    parts = docs.select(text).mapInArrow(run, "bucket int, " + ", ".join(f"{n} bigint" for n in names))
    sums = parts.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])  # at most BUCKETS rows
    vectors = np.zeros((BUCKETS, DIM), np.float32)
    for row in sums.collect():
        vectors[row[0]] = row[1:]
    return vectors / np.maximum(1e-6, np.linalg.norm(vectors, axis=1, keepdims=True))


def pooled(t, vectors: np.ndarray) -> np.ndarray:
    """Mean and mean square of the word vectors of each text; zeros without tokens."""
    sizes = np.diff(t.bounds)
    out = np.zeros((len(sizes), 2 * DIM), np.float32)
    full = np.flatnonzero(sizes)
    if len(full):
        rows = vectors[buckets(t)]
        out[full, :DIM] = np.add.reduceat(rows, t.bounds[full], axis=0) / sizes[full, None]
        out[full, DIM:] = np.add.reduceat(rows * rows, t.bounds[full], axis=0) / sizes[full, None]
    return out


class Network:
    """tanh layer and logistic output over standardised features, with a temperature."""

    def __init__(self, vectors: np.ndarray, share: float = 0.5):
        r = np.random.default_rng(9)
        self.vectors = vectors
        self.mean, self.std = np.zeros(2 * DIM), np.ones(2 * DIM)
        self.w1, self.b1 = r.standard_normal((2 * DIM, HIDDEN)) / np.sqrt(2 * DIM), np.zeros(HIDDEN)
        self.w2, self.b2 = np.zeros(HIDDEN), np.array([np.log((share + 1e-3) / (1 - share + 1e-3))])
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.std @ self.w1 + self.b1) @ self.w2 + self.b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 400) -> None:
        """Adam over the whole sample; ``weight`` undoes the balanced choice of the sample."""
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        z, w = (x - self.mean) / self.std, weight / weight.sum()
        weights = [self.w1, self.b1, self.w2, self.b2]
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in weights]
        for step in range(1, epochs + 1):
            h = np.tanh(z @ self.w1 + self.b1)
            error = (1 / (1 + np.exp(-np.clip(h @ self.w2 + self.b2[0], -30, 30))) - y) * w
            back = np.outer(error, self.w2) * (1 - h * h)
            grads = [z.T @ back + 1e-5 * self.w1, back.sum(0), h.T @ error + 1e-5 * self.w2, error.sum(keepdims=True)]
            for p, g, m in zip(weights, grads, moments):
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                p -= 0.02 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """The temperature with the least weighted log loss on rows that were not fitted."""
        z = self.logits(x)

        def loss(t: float) -> float:
            return float((weight * np.logaddexp(0, np.where(y == 1, -z, z) / t)).sum())

        self.temperature = min(np.geomspace(0.25, 8, 61), key=loss)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", text: str = "text") -> Network:
    """Word vectors from all documents, the network from ``labelled_sample``; a quarter of the sample
    sets the temperature. With fewer than four examples of a class every score is the label's share."""
    vectors = gather(docs, text)
    texts, y, weight = labelled_sample(docs, labels, label, SAMPLE_DOCS, SAMPLE_CHARS)
    if min((y == 0).sum(), (y == 1).sum()) < 4:
        return Network(vectors, float(y.mean()) if len(y) else 0.5)
    tokenize = tokenizer()
    x = np.concatenate([pooled(tokenize(pa.array([t], pa.string())), vectors) for t in texts]).astype(np.float64)
    order = np.random.default_rng(3).permutation(len(y))
    x, y, weight = x[order], y[order], weight[order]
    network, aside = Network(vectors), np.arange(len(y)) % 4 == 0
    network.fit(x[~aside], y[~aside], weight[~aside])
    network.calibrate(x[aside], y[aside], weight[aside])
    return network


def score(docs: DataFrame, network: Network, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (default: all) and ``score``, ``predicted`` of each whole text.

    Null counts as empty; an empty text is scored from zero features. Only the text is read. A
    result column replaces an input column of the same name.
    """
    handle = share(docs.sparkSession, network)

    def prepare():
        network, tokenize = shared(handle), tokenizer()

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            p = network.scores(pooled(tokenize(texts), network.vectors))
            return {"score": pa.array(p, pa.float64()), "predicted": pa.array((p >= KEEP_AT).astype(np.int32))}

        return work

    return annotate(docs, [("score", "double"), ("predicted", "int")], prepare, text, keep)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    network = train(docs, labels.where(crc_fold(F.col("doc_id"), 4) != 2))
    return score(docs, network, keep=["doc_id"]).select(
        "doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted"
    )
