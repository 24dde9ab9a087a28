"""The Jaccard join, the classifier and the pipeline."""

import random
import re
from collections import defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest

from tidelog.llm import jaccard
from tidelog.llm.classifier import best_bound, classify, fit, kth_largest
from tidelog.llm.components import components
from tidelog.llm.jaccard import jaccard_components, one_of_each
from tidelog.llm.shingles import shingle_sets

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    k = min(size, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def test_shingle_sets_are_those_of_words():
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["a", "B", "b", "é", "É", "c\u00a0d", "x\x1cy"], k=rng.randint(0, 30))) for _ in range(300)]
    texts += [None, "", "  ", "\n a\tb ", "A b", "a b c", "one " * 10]
    by_hash, by_words = defaultdict(set), defaultdict(set)
    for i, (text, found) in enumerate(zip(texts, shingle_sets(texts, 4), strict=True)):
        assert len(found) == len(shingles(text, 4))
        by_hash[found.tobytes()].add(i)
        by_words[shingles(text, 4)].add(i)
    assert sorted(map(sorted, by_hash.values())) == sorted(map(sorted, by_words.values()))


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 977}é" for i in range(5000))
    whole = [s.tolist() for s in shingle_sets([text, "a b"], 4)]
    monkeypatch.setattr("tidelog.llm.shingles.CHUNK", 1000)
    assert [s.tolist() for s in shingle_sets([text, "a b"], 4)] == whole


def near_copies():
    rng = random.Random(8)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randint(0, 400)}" for _ in range(120)]
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 5)):
                words[rng.randrange(len(words))] = f"n{rng.randint(0, 10**6)}"
            rows.append(" ".join(words))
            if rng.random() < 0.3:
                base = words
    rows += ["common start of page\n" + " ".join(f"u{i}x{j}" for j in range(30)) for i in range(20)]
    rows += ["a b c", "A B C", "a b", "a b c d", None, "", " \n", rows[0], rows[0].upper()]
    return list(enumerate(rows, 10))


@pytest.mark.parametrize(("block", "hot"), [(1000, 10_000), (3, 1)])
def test_components_equal_all_pairs(spark, monkeypatch, block, hot):
    """Blocks of three cut the lists of n-grams, classes of two are hot."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows = near_copies()
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, token int")
    got = {r["id"]: r for r in jaccard_components(df).collect()}
    sets = {i: shingles(t, 4) for i, t in rows}
    links = [
        (a, b)
        for a, b in combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    expected = roots(sets, links)
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}


def test_a_long_list_is_not_copied(spark, monkeypatch):
    """One list of 10,000 near copies: each row goes to one place in the pass over
    neighbours, and none is left when they are one component."""
    monkeypatch.setattr(jaccard, "BLOCK", 100)
    lists = spark.range(10_000).selectExpr("7L AS token", "id AS cls", "cast(50 + id % 3 AS int) AS n", "0 AS pos").repartition(4)
    pairs = jaccard.neighbours(lists, 85)
    assert 10_000 * 0.99 < pairs.count() < 2 * 10_000
    one = jaccard._in_blocks(lists.selectExpr("*", "1L AS comp"))
    assert one.count() == 0
    roots_ = components(pairs, "a", "b").select("root").distinct().count()
    assert roots_ <= 8  # a batch or range partition each at most


def test_one_row_of_each_component_stays(spark):
    rows = near_copies()
    rows += [rows[3], rows[3], (None, rows[3][1]), (None, "an only text without id"), (None, "an only text without id")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, key int")
    kept = one_of_each(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    sets = {i: shingles(t, 4) for i, t in rows if i is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    least = set(roots(sets, links).values())
    assert sorted(i for i in ids if i is not None) == sorted(least) and ids.count(None) == 1
    assert one_of_each(df.limit(0)).count() == 0 and jaccard_components(df.limit(0)).count() == 0


def test_components_of_chains(spark):
    rng = random.Random(6)
    nodes = list(range(60))
    links = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    linked = {n for a, b in links if a != b for n in (a, b)}
    expected = roots(linked, [x for x in links if x[0] != x[1]])
    assert {r["node"]: r["root"] for r in got} == expected and len(got) == len(expected)


def test_classifier_parts_held_out_labels(spark):
    sf = SF_DIR.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    fitted = fit(docs, labels, labelled=200)  # half of the labels
    judged = fitted.weights.join(labels, fitted.weights["id"] == labels["doc_id"]).collect()
    good = [r["kept"] for r in judged if r["quality"] == 1]
    bad = [r["kept"] for r in judged if r["quality"] == 0]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.1
    again = classify(docs.withColumn("kept", docs["lang"]), fitted)
    assert {r["doc_id"] for r in again.where("kept").collect()} == {r["id"] for r in fitted.weights.where("kept").collect()}


def test_classifier_edges(spark):
    schema = "doc_id long, text string, log_weight string"
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", "x"), (4, "plain words here", "x"), (4, "plain words here", "x"), (None, "a text", "x")]
    df = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(4, None, None), (None, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        got = classify(df, fit(df, known)).collect()
        assert [r["kept"] for r in got] == [False] * 3 + [True] * 3
    assert classify(df.limit(0), fit(df.limit(0), labels)).count() == 0


def test_bound_and_kth(spark):
    w = np.array([-5.0, -4, -1, 0, 0, 3])
    assert best_bound(w, np.array([0, 0, 1, 1, 0, 1], bool), np.array([1, 1, 0, 0, 0, 0], bool)) == -2.5
    assert best_bound(w, np.ones(6, bool), np.zeros(6, bool)) == -np.inf
    rng = random.Random(1)
    numbers = [rng.gauss(0, 1) for _ in range(500)] + [0.25] * 300 + [1e9, -1e9]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for k in (1, 2, 300, 500, 802):
        assert kth_largest(df, "x", k, small=20) == sorted(numbers, reverse=True)[k - 1]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, before, SF_DIR), "test")
        assert after.columns == names and 0 < after.count()
        if not name.startswith("mixing"):
            assert after.count() <= before.count()
        before = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in before.collect()}
    sets = [shingles(r["text"], 5) for r in before.select("text").distinct().collect()]
    whole = [s for s in sets if len(s) > 1]
    near = [1 for a, b in combinations(whole, 2) if 0.8 * len(a | b) <= len(a & b) and not (a <= b or b <= a)]
    assert not near
