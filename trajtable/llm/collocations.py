"""Phrase collocations by Toivonen's method: a sample proposes, full passes count, failures expand.

A phrase can only be frequent if its first and its last words but one are. The sample proposes the
phrases that may be frequent; a full pass counts every proposed phrase and the negative border
(phrases that are not proposed though both their shorter parts are) exactly. A border phrase that
turns out frequent may have frequent extensions that were not counted: it joins the proposed ones,
and a further pass counts what it newly admits, until a pass proposes nothing new.

Proposed phrases are told by a bit table of fixed size, the only thing sent to the tasks. Two phrases
on one bit admit some phrases too many, which are then counted like all others: a table that fills up
prunes less and loses nothing. These passes count 64-bit hashes of phrases, which are small to shuffle;
a hash never counts less than a phrase that has it. A last pass spells out the phrases whose hash
is frequent and counts them by their text, so the result does not depend on hashes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajtable.llm.common import share, shared, table, text_slices, written
from trajtable.plans.skew import ranked

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 4  # words of a phrase
MIN_COUNT = 30
SHARE = 8  # one row in so many is in the sample
BITS = 1 << 26  # bits of the table of proposed phrases: 8 MB
SLICE = 4_000_000  # bytes of text counted at once inside a task
BREAKS, SPACES = b".,;:!?\x0a\x0b\x0c\x0d", b" \t"  # ends of a piece; between words


def byte_kinds() -> np.ndarray:
    """0 for a byte of a word, 1 for a space, 2 for the end of a piece."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(SPACES)], kinds[list(BREAKS)] = 1, 2
    return kinds


def split_words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of all texts in order, lower-cased in A-Z, and the number of the piece each is in."""
    ended = pc.binary_join_element_wise(pc.ascii_lower(texts), "", "\n")  # a text ends its last piece
    offsets = np.frombuffer(ended.buffers()[1], np.int32)[ended.offset : ended.offset + len(ended) + 1]
    data = np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    kinds = byte_kinds()[data]
    inside = np.concatenate([[False], kinds == 0])
    turns = np.flatnonzero(inside[1:] != inside[:-1])  # starts and ends by turns; the last byte is no word's
    starts, ends = turns[0::2], turns[1::2]
    lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(data[kinds == 0])])
    return words.dictionary_encode(), np.cumsum(kinds == 2, dtype=np.int32)[starts]


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all its words but the last, and that of the last."""
    x = (left ^ (left >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + right
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def marked(h: np.ndarray, k: int) -> np.ndarray:
    """The hash with the number of words, less one, in its last two bits."""
    return (h & ~np.uint64(3)) | np.uint64(k - 1)


def proposed(bits: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(h), bool)
    at = (h >> np.uint64(2)) & np.uint64(BITS - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def near_new(words: np.ndarray, same: np.ndarray, h: np.ndarray, word_hash: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """Places of the words that a phrase with a part in ``fresh`` can reach."""
    mark = proposed(fresh, h)[words]
    reach = np.zeros(len(words) + 1, np.int32)  # +1 where a stretch of words begins, -1 behind its end
    here, open_ = h[words], np.ones(len(words), bool)
    for k in range(1, LONGEST):
        if k > 1:
            open_ = open_[:-1] & same[k - 2 :]
            here = marked(mixed(here[:-1], word_hash[words[k - 1 :]]), k)
            mark = open_ & proposed(fresh, here)
        at = np.flatnonzero(mark)
        np.add.at(reach, np.maximum(at - (LONGEST - k), 0), 1)
        np.add.at(reach, np.minimum(at + LONGEST, len(words)), -1)
    return np.flatnonzero(np.cumsum(reach[:-1]) > 0)


def phrases(texts: pa.Array, lang: str, bits: np.ndarray, before: np.ndarray | None = None, longest: int = LONGEST) -> Iterator[tuple]:
    """(k, hashes, counts, known, spell) of the phrases that ``bits`` admit, by their number of words.

    A phrase of several words is admitted when its parts without the last and without the first word
    are admitted and proposed; single words are always admitted. ``known``: ``before`` admitted it too.
    ``spell`` gives the texts of chosen ones.
    """
    coded, piece = split_words(texts)
    if not len(coded):
        return
    words, vocabulary = coded.indices.to_numpy(), coded.dictionary
    seed = xxhash.xxh64_intdigest(lang)
    word_hash = np.array([xxhash.xxh3_64_intdigest(w, seed) for w in vocabulary.to_pylist()], np.uint64)
    at, h = words, marked(word_hash, 1)
    known = np.full(len(h), before is not None)  # counted by an earlier pass
    yield 1, h, np.bincount(words, minlength=len(vocabulary)), known, lambda chosen: vocabulary.take(pa.array(chosen))
    same = piece[:-1] == piece[1:]
    if before is not None:  # all that is new has a part that is newly proposed: the words around such parts will do
        at = near_new(words, same, h, word_hash, bits & ~before)
        if not len(at):
            return
        same = same[np.minimum(at[:-1], len(same) - 1)] & (np.diff(at) == 1) if len(same) else same
        words = words[at]
        at = words
    for k in range(2, longest + 1):
        on, was = proposed(bits, h), known & proposed(before, h)
        ok = np.append(on, False)[at]  # -1, no such phrase here, reads the last entry
        # the part without the first word begins one word later, in the same piece
        spot = np.flatnonzero(ok[:-1] & ok[1:] & same)
        if not len(spot):
            return
        code, which = pd.factorize(at[spot].astype(np.int64) * len(vocabulary) + words[spot + k - 1])
        example = np.empty(len(which), np.int64)
        example[code] = spot
        head, tail, last = at[example], at[example + 1], words[example + k - 1]
        known = was[head] & was[tail]
        h = marked(mixed(h[head], word_hash[last]), k)
        at = np.full(len(words), -1, np.int32)
        at[spot] = code

        def spell(chosen: np.ndarray, k: int = k, example: np.ndarray = example) -> pa.Array:
            return pc.binary_join_element_wise(*[vocabulary.take(pa.array(words[example[chosen] + j])) for j in range(k)], " ")

        yield k, h, np.bincount(code, minlength=len(which)), known, spell


def by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Slices of the texts (second column) of one language (first column)."""
    for batch in batches:
        for a, b in text_slices(batch.column(1), SLICE):
            part = batch.slice(a, b - a)
            for lang in pc.unique(part.column(0)).to_pylist():
                yield lang, part.column(1).filter(pc.equal(part.column(0), lang))


def counted(docs: DataFrame, bits: np.ndarray, before: np.ndarray | None = None, lengths: range = range(1, LONGEST + 1)) -> DataFrame:
    """(h, n): counts of the hashes of phrases that ``bits`` admit and ``before`` did not."""
    handle = share(docs.sparkSession, (bits, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, old = shared(handle)
        for lang, texts in by_lang(batches):
            for k, h, n, known, _ in phrases(texts, lang, new, old, lengths[-1]):
                if k in lengths and not known.all():
                    yield pa.RecordBatch.from_arrays([pa.array(h[~known].view(np.int64)), pa.array(n[~known].astype(np.int64))], names=["h", "n"])

    return docs.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


def spelled_out(docs: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(lang, phrase, k, n): exact counts of the phrases whose hash is wanted; k = 0 counts all words of a language."""
    handle = share(docs.sparkSession, wanted)

    def rows(lang: str, found: pa.Array, k: int, n: np.ndarray) -> pa.RecordBatch:
        columns = [pa.repeat(pa.scalar(lang, pa.string()), len(n)), found, pa.repeat(pa.scalar(k, pa.int32()), len(n)), pa.array(n.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "k", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared(handle)
        for lang, texts in by_lang(batches):
            for k, h, n, _, spell in phrases(texts, lang, bits):
                keep = np.flatnonzero(proposed(bits, h))
                if k == 1:
                    yield rows(lang, pa.array([""]), 0, np.array([n.sum()]))
                yield rows(lang, spell(keep), k, n[keep])

    found = docs.mapInArrow(run, "lang string, phrase string, k int, n bigint")
    return found.groupBy("lang", "phrase", "k").agg(F.sum("n").alias("n"))


def with_bits(bits: np.ndarray, found: DataFrame) -> np.ndarray:
    """The bit table with the hashes of ``found``."""
    at = F.shiftrightunsigned("h", 2).bitwiseAND(F.lit(BITS - 1))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    # at most BITS / 64 rows, however many phrases there are
    got = found.groupBy(F.shiftright(at, 6).alias("i")).agg(F.bit_or(mask).alias("m")).toArrow()
    out = bits.copy()
    np.bitwise_or.at(out, got.column("i").to_numpy(), got.column("m").to_numpy().view(np.uint64))
    return out


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, share_of: int = SHARE, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, phrase, k, n): every phrase of 1 to 4 words with ``min_count`` occurrences, and n of all words as k = 0."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"), *_row_hash(docs, text))
    sample = written(rows.where(F.pmod("_row", F.lit(share_of)) == 0).select("lang", "text"))
    rows = rows.select("lang", "text")
    low = max(2, int(0.6 * min_count / share_of))
    bits = np.zeros(max(1, BITS // 64), np.uint64)
    for k in range(1, LONGEST):
        bits = with_bits(bits, counted(sample, bits, None, range(k, k + 1)).where(F.col("n") >= low))
    extendable = F.col("h").bitwiseAND(F.lit(3)) < LONGEST - 1
    wanted, before = np.zeros_like(bits), None
    while True:
        found = written(counted(rows, bits, before).where(F.col("n") >= min_count))
        wanted, wider = with_bits(wanted, found), with_bits(bits, found.where(extendable))
        if np.array_equal(wider, bits):
            break
        before, bits = bits, wider
    return spelled_out(rows, wanted).where((F.col("n") >= min_count) | (F.col("k") == 0))


def _row_hash(docs: DataFrame, text: str):
    """A hash of the row, so that copies of a text are sampled on their own."""
    return [F.xxhash64(*[F.col(c) for c in docs.columns if c == "doc_id"], F.col(text)).alias("_row")]


def collocations(docs: DataFrame, top: int = 2000, min_count: int = MIN_COUNT, share_of: int = SHARE, text: str = "text", lang: str = "lang") -> DataFrame:
    """The best phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased in A-Z and cut into pieces and words; a null text is empty, a null language
    ``und``. Of the cuts of a phrase the one with the lowest floor(2000000 a / (l + r)) counts, ties
    to the earlier cut; a phrase inside a longer frequent one with at least 80 % of its occurrences
    goes. Equal scores: more occurrences first, then byte order. Repeated rows count each time; an
    empty table or one without frequent phrases gives no rows. Other columns are not used.
    """
    found = written(frequent(docs, min_count, share_of, text, lang))
    words = F.split("phrase", " ")
    several = found.where("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"), words.alias("w"))
    parts, joined = [], lambda x: F.array_join(x, " ")
    for c in range(1, LONGEST):
        cut = F.col("k") > c
        for side, part in (("l", F.slice("w", 1, c)), ("r", F.slice("w", F.lit(c + 1), F.greatest(F.col("k") - c, F.lit(0))))):
            parts.append(F.when(cut, F.struct(F.lit(f"{side}{c}").alias("place"), joined(part).alias("part"))))
    cuts = several.select("lang", "phrase", "a", F.explode(F.array_compact(F.array(*parts))).alias("_c")).select("lang", "phrase", "a", "_c.*")
    sizes = found.where(f"k between 1 and {LONGEST - 1}").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    sides = [F.max(F.when(F.col("place") == f"{s}{c}", F.col("f"))).alias(f"{s}{c}") for s in "lr" for c in range(1, LONGEST)]
    cuts = cuts.join(sizes, ["lang", "part"]).groupBy("lang", "phrase", "a").agg(*sides)
    big = lambda c: F.col(c).cast("decimal(20,0)")

    def scored(c: int):
        score = F.expr(f"(cast(a as decimal(20,0)) * 2000000) div (cast(l{c} as decimal(20,0)) + cast(r{c} as decimal(20,0)))")
        return F.when(score.isNotNull(), F.struct(score.alias("score"), F.lit(c).alias("c"), F.col(f"l{c}").alias("l"), F.col(f"r{c}").alias("r")))

    best = cuts.select("lang", "phrase", "a", F.array_min(F.array(*[scored(c) for c in range(1, LONGEST)])).alias("_b"))
    inner = [
        F.when(F.col("k") >= start + size, joined(F.slice("w", start + 1, size)))
        for size in range(2, LONGEST) for start in range(LONGEST - size + 1)
    ]
    longer = several.where("k >= 3").select("lang", "k", "a", F.explode(F.array_compact(F.array(*inner))).alias("phrase"))
    longer = longer.where(F.size(F.split("phrase", " ")) < F.col("k")).groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("_longer").isNull() | (big("_longer") * 100 < big("a") * 80))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    listed = ranked(kept.select("lang", "phrase", "a", "_b.l", "_b.r", "_b.score"), ["lang"], order, out="_rank").where(F.col("_rank") <= top)
    totals = found.where("k = 0").select("lang", F.col("n"))
    return listed.join(totals, "lang").select("lang", F.col("_rank").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of ``documents``."""
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, coalesce(lang, 'und') AS lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS cut
  FROM documents),
pieces AS (SELECT row_no, lang, unnest(cut) AS piece, generate_subscripts(cut, 1) AS piece_no FROM texts),
split AS (SELECT row_no, lang, piece_no, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
words AS (SELECT row_no, lang, piece_no, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
ahead AS (
  SELECT lang, w AS w1, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3, lead(w, 3) OVER s AS w4
  FROM words WINDOW s AS (PARTITION BY row_no, piece_no ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
counts AS (
  SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM ahead GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM ahead WHERE w4 IS NOT NULL GROUP BY ALL),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM counts WHERE k >= 2 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, k)) AS c FROM candidates),
scored AS (
  SELECT p.lang, p.phrase, p.c, a, x.f AS l, y.f AS r, (a::HUGEINT * 2000000 // (x.f + y.f))::BIGINT AS score
  FROM cuts p JOIN counts x ON x.lang = p.lang AND x.phrase = array_to_string(p.ws[:p.c], ' ')
  JOIN counts y ON y.lang = p.lang AND y.phrase = array_to_string(p.ws[p.c + 1:], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(ws[s:s + z - 1], ' ') AS phrase
  FROM candidates, range(2, 4) AS sizes(z), range(1, 4) AS starts(s) WHERE z < k AND s + z - 1 <= k),
longer AS (SELECT lang, phrase, max(a) AS longest FROM inner_parts GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM best b JOIN totals t ON t.lang = b.lang LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
WHERE longest IS NULL OR 100 * longest < 80 * a
QUALIFY rank <= 2000
"""
