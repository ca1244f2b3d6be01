"""Nearest vectors, phrases and Merkle manifests against plain loops, on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from trajtable.llm import collocations, merkle, neighbours
from trajtable.llm.common import table

FOLDER = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# --- Merkle manifest ----------------------------------------------------------------------------


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, add=0):
    n = row["n_chars"]
    values = [row["doc_id"], row["source"], row["lang"], n if n is None else n + add, row["text"]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Root, and the path (side, sibling) of every node."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            beside = p ^ 1
            paths[i].append(("L" if p & 1 else "R", nodes[beside] if beside < len(nodes) else ""))
        nodes, at = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [p >> 1 for p in at]
    return nodes[0] if nodes else None, paths


def manifest_by_loop(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    subroots, found = [], []
    for lang in langs:
        ordered = sorted(groups[lang], key=lambda r: (first(r["doc_id"]), leaf_of(r)))
        subroot, paths = climb([leaf_of(r) for r in ordered])
        subroots.append(subroot)
        found.append((ordered, subroot, paths))
    root, tops = climb(subroots)
    out = []
    for (ordered, subroot, paths), top in zip(found, tops):
        for r, path in zip(ordered, paths):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            node = leaf_of(r, 1 if hit else 0)
            for side, beside in path + top:
                node = h(beside, node) if side == "L" else h(node, beside)
            out.append((r["doc_id"], leaf_of(r), subroot, root, h(*[s for _, s in path + top]), node, node == root))
    return out


def manifest_rows(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "de", "é", "", None, "solo" if i == 0 else "en"])
        rows.append((i if rng.random() > 0.05 else None, rng.choice(["", "abc", "ünï", None, "x" * 3000]), lang, rng.choice([None, "s"]), rng.choice([None, i])))
    return rows + rows[:5]  # repeated rows


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("n, height", [(1, 10), (2, 1), (37, 1), (150, 2), (70, 10)])
def test_manifest_equals_loop(spark, n, height):
    from pyspark.sql import functions as F

    rows = manifest_rows(n)
    docs = spark.createDataFrame(rows, DOC).withColumns({c: F.lit(9) for c in ("grp", "id", "node", "place", "root", "path", "depth", "block", "_n", "_rank", "all", "levels")})
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.manifest(docs, tampered={"n_chars": F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))}, height=height)
    want = manifest_by_loop([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows])
    assert Counter(tuple(r[c] for c in MANIFEST) for r in got.collect()) == Counter(want)


def test_manifest_of_nothing(spark):
    assert merkle.manifest(spark.createDataFrame([], DOC)).collect() == []


def test_manifest_without_tampering_verifies(spark):
    rows = merkle.manifest(table(spark, FOLDER, "documents")).collect()
    assert rows and all(r.verified for r in rows)
    assert all(len(r.path) >= math.ceil(math.log2(2)) for r in rows)


# --- phrases ------------------------------------------------------------------------------------

PHRASE_DOCS = "doc_id bigint, text string, lang string"


def phrases_by_loop(docs, top, min_count):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    frequent = {(g, " ".join(p), len(p), n) for g, c in counts.items() for p, n in c.items() if n >= min_count}
    frequent |= {(g, "", 0, n) for g, n in totals.items() if n}
    rows = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in cand.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 80 * a and inside(q) for q, b in cand.items()):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        rows += [(lang, i, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top], 1)]
    return frequent, rows


def phrase_docs(seed=5):
    rng = random.Random(seed)
    vocabulary = ["The", "cat", "sat", "on", "mat", "é x", "ÉA", "a-b", "\x00z", "İ"]
    stock = ["new york city hall", "New York", "as soon as possible", "in spite of", "la la la la la la"]
    docs = []
    for i in range(120):
        words = [rng.choice(stock) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r", "!"]) for w in words)
        docs.append((i, text, rng.choice(["en", "en", "de", None, "und"])))
    return docs + [(None, None, None), (1, "", "fr"), (2, "rare words only", "it"), *docs[:10]]


@pytest.mark.parametrize("share_of", [1, 2, 100_000])
def test_phrases_equal_loop(spark, share_of):
    docs = phrase_docs()
    df = spark.createDataFrame(docs, PHRASE_DOCS).selectExpr("*", "1 as k", "2 as phrase", "3 as h", "4 as n", "5 as _row")
    frequent, rows = phrases_by_loop(docs, 25, 12)
    found = collocations.frequent(df, 12, share_of)
    assert {tuple(r) for r in found.select("lang", "phrase", "k", "n").collect()} == frequent
    got = [tuple(r) for r in collocations.collocations(df, 25, 12, share_of).orderBy("lang", "rank").collect()]
    assert got == sorted(rows, key=lambda r: r[:2])


def test_phrases_when_the_bit_table_is_full(spark, monkeypatch):
    """Every phrase seems proposed: all are counted, and the result is the same."""
    docs = phrase_docs(6)
    monkeypatch.setattr(collocations, "BITS", 64)
    frequent, _ = phrases_by_loop(docs, 25, 12)
    found = collocations.frequent(spark.createDataFrame(docs, PHRASE_DOCS), 12, 2)
    assert {tuple(r) for r in found.select("lang", "phrase", "k", "n").collect()} == frequent


def test_phrases_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], PHRASE_DOCS)).collect() == []


def test_scores_pass_64_bits(spark):
    """2,000,000 times a count over 2^63 / 2,000,000 is computed exactly."""
    a, parts = 2**52 + 1, 2**53 + 7
    exact = spark.sql(f"select (cast({a}L as decimal(20,0)) * 2000000) div (cast({parts}L as decimal(20,0)) + {parts}L) as s").first().s
    assert exact == 2_000_000 * a // (2 * parts)


def test_words_of_slices():
    """Slices of an Arrow array, and texts that end inside a word or a piece."""
    import pyarrow as pa

    texts = pa.array(["skip me", "One two", "three. Four", "", "  ", "five!"]).slice(1)
    coded, piece = collocations.split_words(texts)
    assert coded.to_pylist() == ["one", "two", "three", "four", "five"]
    assert len(set(piece.tolist())) == 4 and piece[0] == piece[1]


# --- nearest vectors ----------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int"


def nearest_by_loop(rows, top):
    items = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = {}
    for q, x in items:
        if q % 20:
            continue
        best = {}
        for i, y in items:
            if i != q:
                best[i] = max(best.get(i, -np.inf), math.fsum(x * y))
        for i, s in best.items():
            best[i] = max(s, out.get((q, i), -np.inf))
            out[q, i] = best[i]
    ranked = defaultdict(list)
    for (q, i), s in out.items():
        ranked[q].append((-s, i))
    return {q: [(i, -s) for s, i in sorted(v)[:top]] for q, v in ranked.items()}


def found_of(df):
    out = defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def vectors(rng, n, d, centres=0):
    x = rng.normal(size=(n, d))
    if centres:
        x = 0.35 * x + rng.normal(size=(centres, d))[rng.integers(0, centres, n)]
    return x.astype(np.float32)


def search(spark, rows, **options):
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in rows], VECTORS)
    df = df.selectExpr("*", "1 as id", "2 as part", "3 as parts", "4 as tile", "5 as score", "6 as rank")
    return neighbours.search(df, df.where("vec_id % 20 = 0"), **options)


def test_few_vectors_are_searched_exactly(spark):
    rng = np.random.default_rng(1)
    rows = list(enumerate(vectors(rng, 15, 6)))
    rows += [(15, rows[3][1]), (16, rows[3][1]), (3, rows[3][1]), (4, rows[5][1])]  # ties, a repeated row, two vectors of one id
    got, want = found_of(search(spark, rows)), nearest_by_loop(rows, 20)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a - b) < 1e-12 for q in got for (_, a), (_, b) in zip(got[q], want[q]))


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(0, None), (20, [0.0, 0.0]), (40, [None, 1.0]), (60, [nan, 1.0]), (80, [inf, 1.0]), (None, [1.0, 1.0]), (100, [1.0]), (120, [])]
    rows = odd + [(i, [1.0, float(i)]) for i in (140, 141, 142)]
    assert found_of(search(spark, rows)) == {140: [(142, 1 + 140.0 * 142), (141, 1 + 140.0 * 141)]}


def test_no_vectors(spark):
    assert search(spark, []).collect() == []
    assert search(spark, [(1, [1.0, 2.0])]).collect() == []
    assert search(spark, [(20, [1.0, 2.0])]).collect() == []


@pytest.mark.parametrize("kind", ["spread", "clusters", "lengths", "common"])
def test_recall_and_scores(spark, kind):
    """At least nine tenths of the true neighbours, with their exact scores, also where a third of all rows are one vector."""
    rng = np.random.default_rng(2)
    x = vectors(rng, 1500, 16, 40 if kind == "clusters" else 0)
    if kind == "lengths":
        x *= np.exp(rng.normal(size=(len(x), 1))).astype(np.float32)
    if kind == "common":
        x[rng.random(len(x)) < 0.34] = x[0]
    rows = [(int(i), v) for i, v in zip(rng.permutation(len(x)), x)]
    got, want = found_of(search(spark, rows)), nearest_by_loop(rows, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    true = {(q, i): s for q, v in want.items() for i, s in v}
    assert all(abs(s - true[q, i]) < 1e-9 for q, v in got.items() for i, s in v if (q, i) in true)
    assert all(v == sorted(v, key=lambda t: (-t[1], t[0])) for v in got.values())


def test_parts_are_balanced_and_learnt():
    rng = np.random.default_rng(3)
    x = neighbours.unit(vectors(rng, 800, 8, 16).astype(float))
    near = neighbours.neighbour_graph(x, 10)
    part = neighbours.balanced_parts(near, 8, rng)
    assert np.bincount(part, minlength=8).tolist() == [100] * 8
    cut = (part[near] != part[:, None]).mean()
    assert cut < 0.4  # a random balanced cut leaves 7/8
    w = neighbours.fit_router(x, near, part, 8, rng)
    assert (neighbours.routed(w, x, 1)[:, 0] == part).mean() > 0.7
