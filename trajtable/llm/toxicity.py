"""Toxicity: a convolutional text classifier trained in NumPy.

Words are hashed to embedding rows; filters of one, two and three words run over the whole text,
each keeps its largest response, and a logistic layer reads those. A filter over several words is
a sum of one table per position, so scoring is a gather and a running maximum, whatever the length.
The threshold is calibrated for each language (guessed from frequent words of the text) and
shifted to a score of 0.5.

Weights, word counts and thresholds come from all labelled rows: in every pass the tasks fit on from
the same model, each on its own rows, and the weights are averaged.
"""

from __future__ import annotations

import copy
import sys
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajtable.llm.common import annotate, crc_fold, share, shared, table, text_slices, written
from trajtable.llm.words import Tokenizer
from trajtable.plans.skew import by_sort, running

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 15
BITS = 1 << 26  # bits of the table of labelled ids: 8 MB
DIM = 12
FILTERS = 8  # of each width
WIDTHS = (1, 2, 3)
PACK_ROWS = 4_096  # texts that are fitted at a time inside a task
PACK_WORDS = 2_000_000  # words after which a pack ends
ROUNDS = 4  # passes over all labelled rows
FEW = 4_096  # up to so many texts are read more than once in a pass
STEPS = 500  # least steps with few texts, in all passes
HIDE = 0.5  # share of the words hidden in a step
SPREAD = 0.02  # of the first embeddings; small, so that words without signal respond little
RATE = 0.02
DECAY = 1e-5
MIN_DOCS = 2  # texts that must hold a word for it to count
BATCH = 64
#: fixed values: frequent words by which the language of a text is guessed
MARKERS = {
    "en": "the and of to is that it was for with".split(),
    "de": "der die und das von mit den ist ein zu".split(),
    "fr": "le les et des une est du dans qui pas".split(),
    "es": "el los las del y por con una para se".split(),
}
LANGUAGES = (*MARKERS, "other")


def tokenizer() -> Tokenizer:
    return Tokenizer(stems=True)


def hashed(t) -> np.ndarray:
    """The two embedding rows of each word, for the word and for its first bytes; row 0 is padding."""
    return (np.stack([t.hashes, t.stems], axis=1) % np.uint64(BUCKETS - 1) + np.uint64(1)).astype(np.int32)


def marker_hashes() -> list[np.ndarray]:
    tokenize = Tokenizer()
    return [tokenize(pa.array(words)).hashes for words in MARKERS.values()]


def languages(t, markers: list[np.ndarray]) -> np.ndarray:
    """Index into LANGUAGES by the most marker words; no marker word is "other"."""
    counts = np.zeros((len(t.bounds) - 1, len(LANGUAGES)))
    for k, m in enumerate(markers):
        total = np.concatenate([[0], np.cumsum(np.isin(t.hashes, m))])
        counts[:, k] = total[t.bounds[1:]] - total[t.bounds[:-1]]
    counts[:, -1] = 0.5
    return counts.argmax(axis=1)


PAD = max(WIDTHS) + 1


def padded(rows: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts one after another with padding rows between, and the first and last filter position of each."""
    sizes = np.diff(bounds)
    starts = bounds[:-1] - bounds[0] + PAD * np.arange(len(sizes))
    out = np.zeros((int(sizes.sum()) + PAD * len(sizes), 2), np.int32)
    out[np.arange(int(sizes.sum())) + PAD * np.repeat(np.arange(len(sizes)), sizes)] = rows
    return out, starts, starts + sizes + 1


class Model:
    """Embeddings, one kernel per width and position, and the output layer."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.embedding = (r.standard_normal((BUCKETS, DIM)) * SPREAD).astype(np.float32)
        self.embedding[0] = 0
        self.kernels = [(r.standard_normal((w, DIM, FILTERS)) / np.sqrt(w * DIM)).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = (r.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32)
        self.base = np.zeros(1, np.float32)
        self.cut = np.zeros(len(LANGUAGES))
        self.scale = 1.0

    def tables(self) -> list[list[np.ndarray]]:
        return [[self.embedding @ k[j] for j in range(len(k))] for k in self.kernels]

    def pooled(self, tables, rows: np.ndarray, starts: np.ndarray, stops: np.ndarray, places: bool = False):
        """Largest response of each filter in each text, and where it is."""
        best, at = [], []
        edges = np.stack([starts, stops], axis=1).ravel()
        for parts in tables:
            n = len(rows) - len(parts) + 1
            response = parts[0][rows[:n, 0]] + parts[0][rows[:n, 1]]
            for j in range(1, len(parts)):
                response += parts[j][rows[j : j + n, 0]]
                response += parts[j][rows[j : j + n, 1]]
            best.append(np.maximum.reduceat(response, edges, axis=0)[::2])
            if places:
                at.append(np.stack([a + response[a:b].argmax(axis=0) for a, b in zip(starts, stops)]))
        return np.concatenate(best, axis=1), (np.concatenate(at, axis=1) if places else None)

    def logits(self, tables, rows, starts, stops) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        return np.maximum(self.pooled(tables, rows, starts, stops)[0] + self.bias, 0) @ self.out + self.base[0]

    def arrays(self) -> list[np.ndarray]:
        return [*self.kernels, self.bias, self.out, self.base]

    def fit(self, rows: np.ndarray, bounds: np.ndarray, labels: np.ndarray, known: np.ndarray, turn: int, seed: int, least: int) -> None:
        """A pass of Adam on the logistic loss; a gradient reaches only the words of the largest responses.

        Every step takes as many texts of either class. The larger class is read once, or as often as
        ``least`` steps need, and the smaller one over and over. Buckets that are not ``known`` stay
        at zero, and in every step a share HIDE of the words is hidden: a text cannot be learnt by a word
        of its own.
        """
        r = np.random.default_rng(seed)
        used = np.flatnonzero(known & (np.bincount(rows.ravel(), minlength=BUCKETS) > 0))
        number = np.zeros(BUCKETS, np.int32)
        number[used] = np.arange(1, len(used) + 1)
        rows = number[rows]
        vectors = np.concatenate([np.zeros((1, DIM), np.float32), self.embedding[used]])
        weights = [vectors, *self.arrays()]
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in weights]
        classes = [c for c in (np.flatnonzero(labels == y) for y in (0, 1)) if len(c)]
        half = BATCH // 2
        steps = max(least, *(-(-len(c) // half) for c in classes))
        order = [np.concatenate([r.permutation(c) for _ in range(-(-steps * half // len(c)))]) for c in classes]
        for step in range(1, steps + 1):
            pick = np.concatenate([o[(step - 1) * half : step * half] for o in order])
            words = np.concatenate([rows[bounds[i] : bounds[i + 1]] for i in pick])
            words = np.where(r.random((len(words), 1), np.float32) < HIDE, 0, words)
            text, starts, stops = padded(words, np.concatenate([[0], np.cumsum(bounds[pick + 1] - bounds[pick])]))
            top, at = self.pooled([[vectors @ k[j] for j in range(len(k))] for k in self.kernels], text, starts, stops, True)
            raw = top + self.bias
            hidden = np.maximum(raw, 0)
            p = 1 / (1 + np.exp(-(hidden @ self.out + self.base[0])))
            error = (p - labels[pick])[:, None].astype(np.float32) / len(pick)
            back = error * self.out * (raw > 0)
            grads = [np.zeros_like(vectors), *(np.zeros_like(k) for k in self.kernels), back.sum(0), (error * hidden).sum(0), error.sum(0)]
            for w, k in enumerate(self.kernels):
                block = slice(w * FILTERS, (w + 1) * FILTERS)
                g, where = back[:, block], at[:, block]
                for j in range(len(k)):
                    pull = (g[:, :, None] * k[j].T[None]).reshape(-1, DIM)
                    for part in (0, 1):
                        word = text[where + j, part]  # (texts, filters)
                        grads[1 + w][j] += np.einsum("tfd,tf->df", vectors[word], g)
                        np.add.at(grads[0], word.ravel(), pull)
            grads[0][0] = 0
            rate = RATE * min(1.0, 2 * (1 - (turn + step / (steps + 1)) / ROUNDS))
            for weight, grad, (m, v) in zip(weights, grads, moments):
                m += 0.1 * (grad + DECAY * weight - m)
                v += 0.001 * (grad * grad - v)
                weight -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)
        self.embedding[used] = vectors[1:]


def constant_model(share: float) -> Model:
    """Without examples of both classes every text gets the same score."""
    model = Model()
    model.out[:] = 0
    model.cut = np.full(len(LANGUAGES), -np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    return model


def marked_ids(known: DataFrame) -> np.ndarray:
    """A table of BITS bits with two of them set for each id of ``known``; a full one only admits more rows."""
    key = F.xxhash64("doc_id")
    spots = known.select(F.explode(F.array(key, F.shiftrightunsigned(key, 32))).alias("at"))
    spots = spots.select(F.col("at").bitwiseAND(F.lit(BITS - 1)).alias("at"))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    # at most BITS / 64 rows, however many ids there are
    got = spots.groupBy(F.shiftright("at", 6).alias("i")).agg(F.bit_or(mask).alias("m")).toArrow()
    bits = np.zeros(BITS // 64, np.uint64)
    bits[got.column("i").to_numpy()] = got.column("m").to_numpy().view(np.uint64)
    return bits


def is_marked(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether both bits of the hashes are set: so for every id of the table, and for few others."""
    key = key.view(np.uint64)
    found = np.ones(len(key), bool)
    for at in (key, key >> np.uint64(32)):
        at = at & np.uint64(BITS - 1)
        found &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def training_table(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """One row for each row of ``docs`` with a label: the buckets of its whole text, its label and its language.

    A null label is not used; of several labels for an id the largest counts. Every fourth id (``check``) is
    for the thresholds. Texts stay in the tasks that read them: only the buckets of rows whose id may have a
    label are shuffled, and the join with the labels decides.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    # ids of two types have hashes of two kinds: then all rows are joined
    alike = docs.schema["doc_id"].dataType == labels.schema["doc_id"].dataType
    handle = share(docs.sparkSession, marked_ids(known) if alike else None)
    text = F.coalesce("text", F.lit(""))
    check = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    rows = docs.select("doc_id", F.xxhash64("doc_id", text).alias("key"), check.alias("check"), F.xxhash64("doc_id").alias("_id"), text.alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, tokenize, markers = shared(handle), tokenizer(), marker_hashes()
        for batch in batches:
            if bits is not None:
                batch = batch.filter(pa.array(is_marked(bits, batch.column(3).to_numpy())))
            for a, b in text_slices(batch.column(4)):
                part = batch.slice(a, b - a)
                t = tokenize(part.column(4))
                data = hashed(t).astype(np.int16)
                ids = [data[x:y].tobytes() for x, y in zip(t.bounds[:-1], t.bounds[1:])]
                found = [pa.array(ids, pa.binary()), pa.array(languages(t, markers).astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], *found], names=["doc_id", "key", "check", "ids", "language"])

    schema = T.StructType([*rows.schema.fields[:3], T.StructField("ids", T.BinaryType()), T.StructField("language", T.IntegerType())])
    return written(rows.mapInArrow(run, schema).join(known, "doc_id").select("key", "y", "check", "ids", "language"))


class Pack(NamedTuple):
    """Some rows of the training table, in the order of their keys."""

    y: np.ndarray
    language: np.ndarray
    ids: np.ndarray  # the two buckets of each word
    bounds: np.ndarray


def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[Pack]:
    """All rows of a task in packs of at most PACK_ROWS texts; a pack ends with the text that passes PACK_WORDS."""

    def joined(parts: list[pa.RecordBatch]) -> Pack:
        rows = pa.Table.from_batches(parts).sort_by("key")
        ids = rows.column("ids").to_pylist()
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        words = np.frombuffer(b"".join(ids), np.int16).reshape(-1, 2).astype(np.int32)
        return Pack(rows.column("y").to_numpy(), rows.column("language").to_numpy(), words, np.concatenate([[0], np.cumsum(sizes)]))

    waiting, count, size = [], 0, 0
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.binary_length(batch.column("ids")).to_numpy(zero_copy_only=False), np.int64) // 4)
        at, done = 0, 0
        while at < len(batch):
            full = int(np.searchsorted(ends, done + PACK_WORDS - size)) + 1
            stop = min(len(batch), at + PACK_ROWS - count, max(full, at + 1))
            waiting.append(batch.slice(at, stop - at))
            count, size = count + stop - at, size + int(ends[stop - 1]) - done
            at, done = stop, int(ends[stop - 1])
            if count >= PACK_ROWS or size >= PACK_WORDS:
                yield joined(waiting)
                waiting, count, size = [], 0, 0
    if waiting:
        yield joined(waiting)


def summed(rows: DataFrame, prepare: Callable[[], Callable[[Pack], list[np.ndarray]]]) -> list[np.ndarray] | None:
    """The sum over all packs of the arrays that the function of ``prepare`` returns; None without rows.

    Tasks add up their packs, groups of about the root of the number of tasks add up those sums.
    """

    def add(blobs: list[bytes]) -> list[np.ndarray]:
        total = cloudpickle.loads(blobs[0])
        for blob in blobs[1:]:
            total = [a + b for a, b in zip(total, cloudpickle.loads(blob))]
        return total

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, total = prepare(), None
        for pack in packs(batches):
            got = work(pack)
            total = got if total is None else [a + b for a, b in zip(total, got)]
        if total is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "sums": pa.array([cloudpickle.dumps(total)], pa.binary())})

    def in_group(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        got = cloudpickle.dumps(add(table.column("sums").to_pylist()))
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([got], pa.binary())})

    parts = rows.select("key", "y", "language", "ids").mapInArrow(in_task, "part int, sums binary")
    found = parts.groupBy(F.floor(F.sqrt("part"))).applyInArrow(in_group, "part int, sums binary").orderBy("part").collect()
    return add([bytes(r.sums) for r in found]) if found else None


def in_docs(pack: Pack) -> np.ndarray:
    """How many texts of the pack hold each bucket."""
    owner = np.repeat(np.arange(len(pack.y)), np.diff(pack.bounds))[:, None]
    return np.bincount(np.unique(owner.astype(np.int64) * BUCKETS + pack.ids) % BUCKETS, minlength=BUCKETS)


def improved(model: Model, rows: DataFrame, known: np.ndarray, turn: int, least: int) -> Model:
    """One pass over all rows: each pack fits on from the model, and the weights are averaged.

    Weights count by the texts of a pack, word vectors by the texts that hold the word.
    """
    handle = share(rows.sparkSession, (model, known))

    def prepare():
        start, known = shared(handle)

        def work(pack: Pack) -> list[np.ndarray]:
            model, holding = copy.deepcopy(start), in_docs(pack)
            model.fit(pack.ids, pack.bounds, pack.y, known, turn, 11 + turn, least)
            n = len(pack.y)
            return [np.array([n]), holding, holding[:, None].astype(np.float32) * model.embedding, *(np.float32(n) * w for w in model.arrays())]

        return work

    n, holding, vectors, *arrays = summed(rows, prepare)
    out = copy.deepcopy(model)
    found = known & (holding > 0)
    out.embedding[found] = vectors[found] / holding[found, None]
    for mine, total in zip(out.arrays(), arrays):
        mine[:] = total / n[0]
    return out


def calibrated(model: Model, rows: DataFrame) -> Model:
    """Per language the threshold of the best F1 over all of ``rows``; few examples share the common one.

    Equal logits are one row with their counts, whose running sums are the texts above a cut.
    """
    handle = share(rows.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared(handle)
        tables = model.tables()
        for pack in packs(batches):
            z = model.logits(tables, *padded(pack.ids, pack.bounds))
            yield pa.RecordBatch.from_pydict({"language": pa.array(pack.language, pa.int32()), "y": pa.array(pack.y, pa.int32()), "z": pa.array(z, pa.float64())})

    one = written(rows.select("key", "y", "language", "ids").mapInArrow(run, "language int, y int, z double"))
    scale = one.agg(F.stddev_pop("z")).first()[0]
    every = one.withColumn("language", F.explode(F.array("language", F.lit(-1))))
    cells = written(every.groupBy("language", "z").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("n")))
    sums = {"_hits": F.col("y"), "_above": F.col("n")}
    totals = {"_ones": F.col("y"), "_all": F.col("n")}
    cuts = running(by_sort(cells, ["language"], [F.col("z")]), ["language"], [F.col("z")], ahead=sums, whole=totals)
    cuts = cuts.where("_ones >= 20 and _all - _ones >= 20 and _above < _all")
    cuts = written(cuts.select("language", "z", (2 * F.col("_hits") / (F.col("_above") + F.col("_ones"))).alias("f1")))
    top = cuts.groupBy("language").agg(F.max("f1").alias("_top"))
    best = cuts.join(top, "language").where(F.col("f1") >= F.col("_top") - 1e-9).groupBy("language").agg(F.min("z").alias("low"), F.max("z").alias("high"))
    # a cut lies half way to the next lower logit
    below = lambda c: F.max(F.when(F.col("z") < F.col(c), F.col("z")))
    middle = (F.first("low") + below("low") + F.first("high") + below("high")) / 4
    found = dict(cells.join(F.broadcast(best), "language").groupBy("language").agg(middle).collect())
    out = copy.deepcopy(model)
    out.cut = np.array([found.get(k, found.get(-1, 0.0)) for k in range(len(LANGUAGES))])
    out.scale = max(1.0, scale or 0.0)
    return out


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    """Fit on every labelled row and its whole text, in ROUNDS passes; a quarter of the ids is left out of
    them and sets the thresholds. With fewer than four examples of a class every text gets the share of the
    label, with fewer than 400 texts all are used for both."""
    rows = training_table(docs, labels, label)
    count = {(r.y, r.check): r["count"] for r in rows.groupBy("y", "check").count().collect()}
    zeros, ones = (count.get((y, False), 0) + count.get((y, True), 0) for y in (0, 1))
    if min(zeros, ones) < 4:
        return constant_model(ones / (zeros + ones) if zeros + ones else 0.0)
    enough = zeros + ones >= 400 and all(count.get((y, c), 0) for y in (0, 1) for c in (False, True))
    fit_on, check = (rows.where(~F.col("check")), rows.where("check")) if enough else (rows, rows)
    model, known = Model(), summed(fit_on, lambda: lambda pack: [in_docs(pack)])[0] >= MIN_DOCS
    known[0] = False
    model.embedding[~known] = 0
    # one pass over few texts has too few steps
    least = STEPS // ROUNDS if zeros + ones <= FEW else 1
    for turn in range(ROUNDS):
        model = improved(model, fit_on, known, turn, least)
    return calibrated(model, check)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (default: all) and ``score``, ``predicted`` of each whole text.

    Null counts as empty; an empty text is scored like any other. Only the text is read. A result
    column replaces an input column of the same name.
    """
    handle = share(docs.sparkSession, model)

    def prepare():
        model, tokenize = shared(handle), tokenizer()
        tables, markers = model.tables(), marker_hashes()

        def work(texts: pa.Array) -> dict[str, pa.Array]:
            t = tokenize(texts)
            z = model.logits(tables, *padded(hashed(t), t.bounds)) - model.cut[languages(t, markers)]
            p = 1 / (1 + np.exp(-np.clip(z / model.scale * 2, -30, 30)))
            return {"score": pa.array(p.astype(np.float64)), "predicted": pa.array((p >= 0.5).astype(np.int32))}

        return work

    return annotate(docs, [("score", "double"), ("predicted", "int")], prepare, text, keep)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels of the training folds; the held-out fifth is never read."""
    return labels.where(crc_fold(F.col("doc_id"), 5) != 0)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns.

    A null text is scored like an empty one; repeated rows stay or go together; without labels of both
    classes nothing is learnt and all rows get the share of toxic ones; an empty table gives an empty result.
    """
    model = train(docs, training_labels(labels))
    scored = score(docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text")), model, "_text", ["_row"])
    return scored.where("predicted = 0").select("_row.*")


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, training_labels(table(spark, sf_dir, "labels")))
    return score(docs, model, keep=["doc_id"]).select(
        "doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )
