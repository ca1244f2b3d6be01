"""Helpers shared by the corpus operators: reading, intermediate tables, batch functions, components.

The helpers that run in tasks are pickled by value, so executors need no installed package.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajtable.session import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE_BYTES = 2_000_000  # text handled at once inside a task; longer texts are handled alone


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: cuts the lineage."""
    folder = scratch(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes of text each, one row at least."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def annotate(
    df: DataFrame,
    fields: Sequence[tuple[str, str]],
    prepare: Callable[[], Callable[[pa.Array], dict[str, pa.Array]]],
    text: str = "text",
    keep: Sequence[str] | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Columns of ``keep`` (default: all) plus columns computed from whole texts in Arrow batches.

    ``prepare`` runs once per task and returns the batch function; it gets texts without nulls
    (null counts as empty). A result column replaces an input column of the same name.
    """
    names = [n for n, _ in fields]
    keep = [c for c in (df.columns if keep is None else keep) if c not in names]
    types = {f.name: f for f in df.schema.fields}
    schema = T.StructType([types[c] for c in keep] + [T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    read = list(dict.fromkeys([*keep, text]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = prepare()
        for batch in batches:
            for a, b in text_slices(batch.column(read.index(text)), slice_bytes):
                part = batch.slice(a, b - a)
                got = work(pc.fill_null(part.column(read.index(text)), ""))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(read.index(c)) for c in keep), *(got[n] for n in names)], names=[*keep, *names]
                )

    return df.select(*read).mapInArrow(run, schema)


def row_key(text: str, doc_id: str) -> list[Column]:
    """Two hashes that identify a row by its id and text, never null; null text counts as empty."""
    parts = [F.col(doc_id).isNull(), F.col(doc_id), F.coalesce(F.col(text), F.lit(""))]
    return [F.xxhash64(*parts).alias("_k1"), F.xxhash64(F.lit(1), *parts).alias("_k2")]


def as_row(df: DataFrame):
    """The whole row as one column, beside which helper columns cannot clash with its own."""
    return F.struct(*df.columns).alias("_row")


def keep_rows(docs: DataFrame, kept: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is in ``kept``, rows equal in id and text once.

    Duplicates are reduced in the tasks before the one shuffle of the texts, which also serves the join.
    """
    once = docs.select(as_row(docs), *row_key(text, doc_id)).dropDuplicates(["_k1", "_k2"])
    return once.join(kept.select("_k1", "_k2"), ["_k1", "_k2"], "left_semi").select("_row.*")


def share(spark: SparkSession, value):
    """Broadcast an object of this package; ``shared(handle)`` gives it back inside a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(handle):
    return cloudpickle.loads(handle.value)


def kept_by_worker(name: str, make: Callable):
    """An object that a Python worker keeps from task to task, such as a loaded vocabulary."""
    holder = sys.modules.setdefault("_trajtable_worker", types.ModuleType("_trajtable_worker"))
    if name not in holder.__dict__:
        setattr(holder, name, make())
    return getattr(holder, name)


def size_of(df: DataFrame, text: str) -> tuple[int, int]:
    """Rows and bytes of a text column, to decide whether it may be held whole."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return row["n"], row["b"] or 0


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def smallest(df: DataFrame, by: str, n: int) -> DataFrame:
    """One row for each of the ``n`` smallest values of a hash column; only hashes are sorted and moved."""
    cut = df.select(by).distinct().orderBy(by).limit(n).agg(F.max(by)).first()[0]
    return df.limit(0) if cut is None else df.where(F.col(by) <= cut).dropDuplicates([by])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, chars: int):
    """A bounded sample to fit a classifier on: texts, labels 0/1, and how many rows each stands for.

    The labelled ids with the smallest hashes, at most ``rows`` / 2 of either class, and of these the
    whole texts of at most ``chars`` characters. A null label is not used; of several labels for an
    id the largest counts.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    count = dict(known.groupBy("y").count().collect())
    pick = lambda y: known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2)
    chosen = pick(0).union(pick(1))  # at most ``rows`` ids: small enough to broadcast
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # of several texts with one id, the one with the least hash
    one = found.where(F.length("text") <= chars).groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    got = one.orderBy("doc_id").collect()
    y = np.array([r.y for r in got], np.int64)
    weight = np.array([count[r.y] for r in got]) / np.maximum(1, np.bincount(y, minlength=2))[y] if got else np.zeros(0)
    return [r.text for r in got], y, weight


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (src, dst): one row (id, root) per vertex, root the least id.

    Rounds of neighbour minimum with pointer jumping, on ids alone; every round is a written table,
    and the loop ends at the first round that changes nothing. A vertex with many edges is safe:
    the minimum is reduced in the tasks first.
    """
    both = written(
        edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct()
    )
    labels = written(both.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("m")).select("id", F.least("id", "m").alias("root")))
    while True:
        near = both.join(labels.select(F.col("id").alias("dst"), "root"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("root").alias("near"))
        step = labels.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("id").alias("root"), F.col("root").alias("up"))
        moved = written(step.join(jump, "root", "left").select("id", "old", F.least("root", F.coalesce("up", "root")).alias("root")))
        labels = moved.select("id", "root")
        if moved.where("old <> root").isEmpty():
            return labels
