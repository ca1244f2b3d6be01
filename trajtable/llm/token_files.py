"""Token ids in files: one zstandard frame per document with a shared dictionary, and an offset index.

Layout of a folder: ``dictionary`` holds one row (dict_hash, dictionary, id_type); ``shards`` holds rows
(part, shard, before, dict_hash, doc_ids, n_ids, offsets, payload). Parts follow the order of doc_id, and so
do the shards of a part and the documents of a shard; ``before`` counts the ids of earlier shards of the part. ``payload`` is the frames one after another,
frame k at ``offsets[k]:offsets[k + 1]``, so a short document is read without its neighbours.
Ids are little-endian unsigned 32-bit. Spark writes and commits the files, so a task that runs
again on another executor leaves nothing twice, in any store Spark can reach.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajtable.llm.bpe import default_tokenizer
from trajtable.llm.common import kept_by_worker, smallest, table, text_slices
from trajtable.llm.pieces import PieceEncoder, gather, plain
from trajtable.session import scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD_IDS = 1_000_000  # ids in a shard, more only if one document has more
SAMPLE_DOCS = 2_000  # documents the dictionary is trained on
SAMPLE_CHARS = 100_000  # bytes of the longest text taken into that sample
SAMPLE_BYTES = 4_000_000  # bytes of the sample's serialized ids
DICTIONARY_BYTES = 64 * 1024
REMEMBERED = 64_000_000  # bytes of pieces a Python worker remembers; a matter of speed only
SLICE_BYTES = 8_000_000  # text whose distinct pieces are encoded together
CALL = 4_000  # pieces in a call of the library


def shard_schema(id_type: str) -> str:
    return f"part int, shard int, before bigint, dict_hash string, doc_ids array<{id_type}>, n_ids bigint, offsets array<bigint>, payload binary"


def library_encoder(path: str) -> PieceEncoder:
    """The tokenizers library on distinct pieces of text (pieces end where no token reaches over)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    run = lambda texts: [np.array(e.ids, np.int32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    (line,) = run(["\n"])  # a line end between two pieces is a word of its own

    def encode_new(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One call of the library for many pieces, with a line end between them."""
        order = [i for i, p in enumerate(pieces) if plain(p)] if len(line) == 1 else []
        found, sizes = [], []
        for a in range(0, len(order), CALL):
            some = [pieces[i] for i in order[a : a + CALL]]
            (ids,) = run(["\n".join(some)])
            ends = np.flatnonzero(ids == line[0])
            if len(ends) == len(some) - 1:
                sizes.append(np.diff(ends, prepend=-1, append=len(ids)) - 1)
                found.append(np.delete(ids, ends))
            else:  # not the usual pattern of words: each piece gets a call of its own
                each = run(some)
                sizes.append(np.array([len(x) for x in each], np.int64))
                found += each
        there = set(order)
        others = [i for i in range(len(pieces)) if i not in there]
        each = run([pieces[i] for i in others])
        sizes.append(np.array([len(x) for x in each], np.int64))
        flat, sizes = np.concatenate([*found, *each]), np.concatenate(sizes)
        counts, begin = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64)
        order = np.array(order + others, np.int64)
        counts[order], begin[order] = sizes, np.cumsum(sizes) - sizes
        return gather(flat, begin, counts), counts

    special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
    return PieceEncoder(encode_new, special, REMEMBERED)


def train_dictionary(docs: DataFrame, tokenizer: str, text: str, doc_id: str) -> bytes:
    """A dictionary from the serialized ids of a bounded sample (smallest row hashes).

    Empty, and then unused, when the sample is too small to train on.
    """
    sample = docs.select(F.col(text).alias("t"), F.xxhash64(doc_id, text).alias("h")).where(F.octet_length("t") <= SAMPLE_CHARS)
    texts = [r.t for r in smallest(sample, "h", SAMPLE_DOCS).orderBy("h", "t").collect()]
    packed, total = [], 0
    ids, counts = library_encoder(tokenizer)(pa.array(texts, pa.string()))
    for part in np.split(ids, np.cumsum(counts)[:-1]) if texts else []:
        if total + part.nbytes <= SAMPLE_BYTES:
            packed.append(part.tobytes())
            total += part.nbytes
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, packed).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int | None = 2, text: str = "text", doc_id: str = "doc_id"
) -> None:
    """Encode whole texts and write them in ascending order of doc_id (null first; a number or else as text).

    A null or empty text has only the end id. Rows with the same doc_id follow each other by a hash
    of the text; each keeps its own frame. An empty table writes no shards.
    """
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    dictionary = train_dictionary(docs, path, text, doc_id)
    name = hashlib.sha256(dictionary).hexdigest()
    id_type = "bigint" if isinstance(docs.schema[doc_id].dataType, T.IntegralType) else "string"
    spark.createDataFrame([(name, dictionary, id_type)], "dict_hash string, dictionary binary, id_type string").write.parquet(f"{folder}/dictionary")
    tail = [] if end_id is None else [end_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_by_worker(f"library:{path}", lambda: library_encoder(path))
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        pack = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        ids, offsets, frames, n_ids = [], [0], [], 0

        def full() -> pa.RecordBatch:
            row = {"part": [part], "shard": [shard], "before": [before], "dict_hash": [name], "doc_ids": [ids], "n_ids": [n_ids], "offsets": [offsets], "payload": [b"".join(frames)]}
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64() if id_type == "bigint" else pa.string()), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], names=list(row))

        for batch in batches:
            for a, b in text_slices(batch.column(1), SLICE_BYTES):
                keys = batch.column(0).slice(a, b - a).to_pylist()
                flat, counts = encoder(batch.column(1).slice(a, b - a))
                ends = np.cumsum(counts)
                if len(tail):
                    flat, ends = np.insert(flat, ends, tail[0]), ends + np.arange(1, len(ends) + 1)
                data, ends = memoryview(flat.astype("<i4").tobytes()), (ends * 4).tolist()
                for key, x, y in zip(keys, [0, *ends], ends):
                    if ids and n_ids + (y - x) // 4 > SHARD_IDS:
                        yield full()
                        shard, before = shard + 1, before + n_ids
                        ids, offsets, frames, n_ids = [], [0], [], 0
                    frames.append(pack.compress(data[x:y]))
                    ids.append(key)
                    offsets.append(offsets[-1] + len(frames[-1]))
                    n_ids += (y - x) // 4
        if ids:
            yield full()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast(id_type).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ordered.mapInArrow(run, shard_schema(id_type)).write.option("compression", "none").parquet(f"{folder}/shards")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and the serialized ids (binary)."""
    name, dictionary, id_type = spark.read.parquet(f"{folder}/dictionary").select("dict_hash", "dictionary", "id_type").first()
    shards = spark.read.schema(shard_schema(id_type)).parquet(f"{folder}/shards")
    # ids before each part: one number for each write task
    first, total = {}, 0
    for part, n in sorted(shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):
        first[part], total = total, total + n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if row["dict_hash"] != name:
                    raise ValueError(f"shard {row['part']}/{row['shard']} was written with another dictionary")
                at, packed = row["offsets"], row["payload"]
                data = [unpack.decompress(packed[a:b]) for a, b in zip(at, at[1:])]
                counts = np.array([len(x) // 4 for x in data], np.int64)
                start = first[row["part"]] + row["before"] + np.cumsum(counts) - counts
                columns = [pa.array(row["doc_ids"], pa.int64() if id_type == "bigint" else pa.string()), pa.array(start), pa.array(counts), pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "data"])

    return shards.mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, data binary")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark)
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("data").alias("ids_crc32"))
