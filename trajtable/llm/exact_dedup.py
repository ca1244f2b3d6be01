"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text without white space is cut after sentence marks into chunks of 512 to 4,096 characters, so
equal texts have equal chunks wherever they stand. Each distinct chunk gets a verified identifier:
its 64-bit fingerprint where all chunks with that fingerprint are the same text, and a digest of
the chunk itself where they are not. Documents are then compared by their ordered identifier
lists; a long text is read by the scan and moved at most once, as distinct chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import keep_rows, row_key, table, written

CHUNK = r"(?s).{512,4095}?[.!?;:,。！？]|.{1,4096}"
SPACES = " \t\n\u000b\f\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def fingerprint(chunk: Column) -> Column:
    return F.xxhash64(chunk, F.length(chunk))


def recipes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``_row`` (a number for the row), id, length, digest, row key and recipe."""
    local = written(
        docs.select(*row_key(text, doc_id), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
        .withColumn("norm", normalised(F.col("t")))
        .select(
            F.monotonically_increasing_id().alias("_row"),
            "_k1",
            "_k2",
            "doc_id",
            F.length("t").cast("bigint").alias("n_chars"),
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.transform(chunks(F.col("norm")), fingerprint).alias("recipe"),
        )
    )
    # distinct chunks are compared as texts, tasks reduce their own first; a fingerprint of two texts is doubtful
    parts = docs.select(F.explode(chunks(normalised(F.col(text)))).alias("chunk")).distinct()
    doubtful = written(
        parts.select(fingerprint(F.col("chunk")).alias("mark")).groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    if doubtful.isEmpty():
        return local
    flagged = local.select("_row", F.explode("recipe").alias("mark")).join(doubtful, "mark", "left_semi").select("_row").distinct()
    whole = F.when(F.col("_doubt"), F.array(F.xxhash64("text_sha256"), F.xxhash64(F.reverse("text_sha256"))))
    return (
        local.join(flagged.withColumn("_doubt", F.lit(True)), "_row", "left")
        .withColumn("recipe", F.coalesce(whole, "recipe"))
        .drop("_doubt")
    )


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and the row key: one row per document.

    Texts are equal when identical without the characters of ``[\\x20\\x09-\\x0D]``; null counts as
    empty, and all empty texts are one group. The row with the most characters stays, then the
    smallest doc_id (null last); of rows equal in both exactly one is kept. An empty table gives an
    empty result; other columns of the input are not read.
    """
    rows = recipes(docs, text, doc_id).withColumn("_key", F.xxhash64("recipe"))
    best = F.min(F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), "doc_id", "_row"))
    groups = rows.groupBy("_key", "recipe").agg(best.alias("b"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups.select("_key", "recipe", F.col("b.doc_id").alias("keep_id"), F.col("b._row").alias("_keep"), "group_size"))
    # both sides are shuffled for this join alone, so a skewed partition is split at run time
    return rows.join(groups, ["_key", "recipe"]).select(
        "doc_id", "keep_id", "group_size", (F.col("_row") == F.col("_keep")).alias("kept"), "text_sha256", "_k1", "_k2"
    )


def without_exact_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row of each group of equal texts, with its own columns.

    Which row stays, and what null and empty texts, repeated rows and empty tables give, is said at
    ``exact_groups``. Columns may have any names.
    """
    return keep_rows(docs, exact_groups(docs, text, doc_id).where("kept"), text, doc_id)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).drop("_k1", "_k2")


OP3_SQL = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm,
         row_number() OVER () AS r FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER g = 1 AS kept, sha256(norm) AS text_sha256
FROM rows WINDOW g AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST, r)
"""
