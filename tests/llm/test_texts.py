"""Exact dedup, decontamination, BPE, token files: compared with plain loops and with the library."""

import hashlib
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from trajtable.llm import bpe, decontaminate, exact_dedup, token_files
from trajtable.llm.common import table
from trajtable.session import scratch

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    """Rows of (id, text); the other columns are null."""
    return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)


LONG = "word and word, again. " * 20_000
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a b"), (5, "ab"), (6, " a  b "), (6, " a  b "), (None, "a b"), (7, "AB"),
    (8, LONG), (9, LONG.replace(" ", "\n") + " "), (10, LONG + "x"), (11, "漢字。" * 3000), (12, "漢字。" * 3000), (13, "x" * 9000), (14, "x" * 9000 + "y"),
]


def groups_by_loop(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    out = []
    for i, t in rows:
        same = [(-len(u or ""), j is None, j or 0, k) for k, (j, u) in enumerate(rows) if norm(u) == norm(t)]
        best = min(same)
        out.append((i, rows[best[3]][0], len(same), hashlib.sha256(norm(t).encode()).hexdigest()))
    return out


def test_exact_groups_equal_loop(spark):
    got = exact_dedup.exact_groups(documents(spark, ODD)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(groups_by_loop(ODD), key=key)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})


def test_exact_doubtful_fingerprints(spark, monkeypatch):
    """With a fingerprint that cannot tell chunks apart the digest of the text decides."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup, "fingerprint", lambda c: F.length(c).cast("bigint"))
    got = exact_dedup.exact_groups(documents(spark, ODD)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == sorted(groups_by_loop(ODD), key=key)


def test_exact_keeps_rows_and_columns(spark):
    clash = documents(spark, ODD).withColumnRenamed("lang", "keep_id").withColumnRenamed("source", "_row")
    kept = exact_dedup.without_exact_copies(clash)
    assert kept.columns == clash.columns
    assert kept.count() == len({r[3] for r in groups_by_loop(ODD)})
    assert exact_dedup.without_exact_copies(clash.limit(0)).count() == 0
    assert exact_dedup.exact_groups(clash.limit(0)).count() == 0


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hits_by_loop(text, items, window=10):
    w, hit, named = words(text), set(), set()
    for item, t in items:
        x = words(t)
        n = min(window, len(x))
        for i in range(len(x) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == x[i : i + n]:
                    hit.update(range(j, j + n))
                    named.add("null" if item is None else str(item))
    return len(w), len(hit), sorted(named)


PASSAGE = "One two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, PASSAGE), (2, "alone"), (3, "Été, two"), (4, None), (5, "..."), (None, "one two three"), (1, "alone"), (10, "a b a b a b a b a b a b")]
TEXTS = [
    (1, None), (2, ""), (3, "x " * 500 + PASSAGE.upper() + " y" * 500), (4, "one-two three four five six seven eight nine ten"), (5, "ALONE at last"),
    (6, "Été two; ét two"), (7, "a b " * 300), (8, "one two three four five six seven eight nine"), (9, "w" * 20_000 + " alone"), (9, "w" * 20_000 + " alone"), (None, "alone"),
]


@pytest.mark.parametrize("block_bytes", [4_000_000, 40])
def test_hits_equal_loop(spark, block_bytes):
    """Also with the items dealt over several passes."""
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = decontaminate.find_benchmark(documents(spark, TEXTS), items, block_bytes=block_bytes)
    rows = got.select("doc_id", "text", "n_words", decontaminate.hit_words(got.hit_spans).alias("n_hit"), "item_ids").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.n_words, r.n_hit, r.item_ids) == hits_by_loop(r.text, ITEMS), r.text


def test_decontamination_keeps_clean_rows(spark):
    docs = documents(spark, TEXTS).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "item_ids")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    clean = decontaminate.without_benchmark(docs, items)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(i) for i, t in TEXTS if not hits_by_loop(t, ITEMS)[1])
    assert decontaminate.without_benchmark(docs, items.limit(0)).count() == len(TEXTS)
    assert decontaminate.without_benchmark(docs.limit(0), items).count() == 0


STRANGE = [
    "", " ", "  a  b\n\n c", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>", "it's we'll 'll", "x y z\x1c\x85", "é漢字🙂 é", "0" * 400, "ab" * 4000,
    "\n \n", "tab\t tab", "a" * 3000, " the the the", "...!!! ###",
]


def library():
    return Tokenizer.from_file(bpe.default_tokenizer())


def test_encoders_equal_library(spark):
    texts = STRANGE + [r.text for r in table(spark, FOLDER, "documents").collect()]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    for encoder in (bpe.trie_encoder(bpe.default_tokenizer()), token_files.library_encoder(bpe.default_tokenizer())):
        for held in (pa.array(texts), pa.array(["x", *texts]).slice(1), pa.array(texts[::-1])):
            ids, counts = encoder(held)
            got = [part.tolist() for part in np.split(ids, np.cumsum(counts)[:-1])]
            assert got == (want[::-1] if held[0].as_py() == texts[-1] else want)


def test_encode_decode(spark):
    rows = [(i, t) for i, t in enumerate(STRANGE)] + [(None, None), (0, "")]
    docs = documents(spark, rows).withColumnRenamed("n_chars", "ids")
    encoded = bpe.encode(docs)
    assert encoded.columns == ["doc_id", "text", "lang", "source", "n_tokens", "ids"]
    for r in bpe.decode(encoded).collect():
        assert r.decoded == (r.text or "")
        assert r.n_tokens == len(library().encode(r.text or "", add_special_tokens=False).ids)
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0
    broken = spark.createDataFrame([([188, 50256, 99_999, -1],), (None,)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(broken).collect()] == [library().decode([188, 50256], skip_special_tokens=False), ""]


def test_op1_equals_library(spark):
    tokenizer = library()
    texts = {r.doc_id: r.text for r in table(spark, FOLDER, "documents").collect()}
    for r in bpe.op1_bpe_trie(spark, FOLDER).collect():
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def files_by_loop(rows):
    tokenizer, at, out = library(), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = array("I", tokenizer.encode(t or "", add_special_tokens=False).ids + [2])
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_op10_equals_loop(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    got = sorted(map(tuple, token_files.op10_token_files(spark, FOLDER).collect()))
    assert got == files_by_loop(rows)


def test_token_files_edges(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_IDS", 50)  # many shards; one text is longer than a shard
    rows = [(i * 7 % 31, f"text {i} " * i) for i in range(31)] + [(40, None), (41, ""), (None, "null id"), (3, "twice"), (3, "twice")]
    folder = scratch(spark)
    token_files.write_tokens(documents(spark, rows).withColumnRenamed("lang", "part"), folder)
    got = [tuple(r) for r in token_files.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "data").collect()]
    ends = sorted((s, s + n) for _, s, n, _ in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    order = [d for d, s, _, _ in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    crc = lambda r: (str(r[0]), r[2], zlib.crc32(bytes(r[3])))
    assert sorted(map(crc, got)) == sorted((str(i), n, c) for i, _, n, c in files_by_loop(rows))
    empty = scratch(spark)
    token_files.write_tokens(documents(spark, rows).limit(0), empty)
    assert token_files.read_tokens(spark, empty).count() == 0
