"""Near duplicates and the pipeline against all pairs, on small tables."""

import random
from collections import Counter

import numpy as np
import pytest
from test_texts import DOCS, groups_by_loop, hits_by_loop, library, words

import corpus_pipeline
from trajtable.llm import near_dedup, toxicity
from trajtable.llm.common import components, table

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    w = words(text)
    rows = [tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))]
    seen = Counter()
    out = []
    for r in rows:  # the t-th occurrence is labelled t
        out.append((r, seen[r]))
        seen[r] += 1
    return out


def common_subsequence(x, y):
    row = [0] * (len(y) + 1)
    for a in x:
        last = 0
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if a == b else max(row[j], row[j - 1])
    return row[-1]


def classes_by_loop(docs):
    """Least id of the class of each document, from all pairs."""
    docs = sorted(docs, key=lambda d: d[0])
    kinds = {i: shingles(t) or t for i, t in docs}
    root = {i: i for i, _ in docs}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, (i, _) in enumerate(docs):
        for j, _ in docs[:a]:
            x, y = kinds[i], kinds[j]
            same = x == y
            if not same and isinstance(x, list) and isinstance(y, list):
                most = len(set(x) & set(y))
                enough = lambda c: c >= 0.8 * (len(x) + len(y) - c) - 1e-9
                same = enough(most) and enough(common_subsequence(x, y))
            if same:
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: find(i) for i, _ in docs}


def variant(rng, text, share):
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(4)
    fresh = lambda n: " ".join(f"w{rng.randrange(3000)}" for _ in range(n))
    passage = fresh(60)
    rows, bases = [], [fresh(n) for n in (3, 5, 8, 40, 150, 600)]
    for b in bases:
        rows += [b, b, b.upper() + "!"] + [variant(rng, b, s) for s in (0.005, 0.01, 0.02, 0.05, 0.2) for _ in range(3)]
    rows += [fresh(60) + " " + passage + " " + fresh(60) for _ in range(12)]
    rows += ["", "", "...", "a b c", "a b c", "A, b; c", "same line here\n" * 40, "same line here\n" * 41, fresh(4000)]
    rows += [" ".join(reversed(bases[4].split(" ")))]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [512, 4])
def test_classes_equal_all_pairs(spark, planted, monkeypatch, block):
    """Also with buckets cut into many blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in planted], DOCS).withColumnRenamed("lang", "node").withColumnRenamed("source", "group_id")
    got = near_dedup.near_groups(docs).collect()
    want = classes_by_loop(planted)
    assert {r.doc_id: r.group_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.group_size == sizes[r.group_id] and r.kept == (r.doc_id == r.group_id) for r in got)
    kept = near_dedup.without_near_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(sizes)


def test_documents_equal_all_pairs(spark):
    docs = table(spark, FOLDER, "documents")
    want = classes_by_loop([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: r.group_id for r in near_dedup.op6_order_minhash(spark, FOLDER).collect()} == want


def test_near_edges(spark):
    rows = [(None, "one two three four five six"), (1, None), (2, ""), (3, "one two three four five six"), (3, "one two three four five six"), (4, "x" * 50_000)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    got = sorted((str(r.doc_id), str(r.group_id), r.group_size) for r in near_dedup.near_groups(docs).collect())
    assert got == [("1", "1", 2), ("2", "1", 2), ("3", "3", 3), ("3", "3", 3), ("4", "4", 1), ("None", "3", 3)]
    assert near_dedup.without_near_copies(docs).count() == 3
    assert near_dedup.near_groups(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100 + rng.randrange(50), 100 + rng.randrange(50)) for _ in range(40)] + [(500, 500 + i) for i in range(200)]
    root = {v: v for e in edges for v in e}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in edges:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "src bigint, dst bigint")).collect()}
    alone = {a for a, b in edges if a == b}
    assert got == {i: find(i) for i in root if i in got} and set(root) - set(got) <= alone


def test_alignment_against_dynamic_programming():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.permutation(60)[: rng.integers(1, 40)].astype(np.uint32)
        y = np.concatenate([x[rng.random(len(x)) > 0.1], rng.integers(100, 200, 3)]).astype(np.uint32)
        if rng.random() < 0.3:
            rng.shuffle(y)
        y = y[np.sort(np.unique(y, return_index=True)[1])]
        most = common_subsequence(x.tolist(), y.tolist())
        got = near_dedup.aligned(x, y)
        assert got <= most
        if near_dedup.similar(most, len(x), len(y)):
            assert got == most


def test_pipeline_stage_by_stage(spark):
    docs = table(spark, FOLDER, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, toxicity.training_labels(table(spark, FOLDER, "labels")))
    left = {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
    stages = dict(corpus_pipeline.STAGES)
    now = stages["toxicity"](spark, docs, FOLDER)
    assert now.columns == docs.columns and {r.doc_id for r in now.collect()} == left
    texts = [(i, rows[i].text) for i in sorted(left)]
    left = {k for i, k, _, _ in groups_by_loop(texts)}
    left = set(classes_by_loop([(i, rows[i].text) for i in left]).values())
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    left = {i for i in left if not hits_by_loop(rows[i].text, items)[1]}
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == {i: library().encode(rows[i].text, add_special_tokens=False).ids for i in left}
