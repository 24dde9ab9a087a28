"""Hard negatives and whitening against plain definitions."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import hard_negatives as hard
from tidelog.llm.hard_negatives import Best, hard_negatives, spanning_tree
from tidelog.llm.whitening import deviations, whiten

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, x string, dim string, `a.b` int"


def vectors(spark, rows):
    """Extra columns have the names of results and of working columns."""
    return spark.createDataFrame([(*r, "r", "x", "d", 1) for r in rows], SCHEMA).repartition(3)


def fits(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


@pytest.fixture
def edge_rows():
    rng = random.Random(3)
    centres = [[rng.gauss(0, 0.4) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(400):
        c = centres[rng.randrange(4)]
        rows.append((i, [x + rng.gauss(0, 0.1) for x in c], rng.randrange(3)))
    rows += [(1000 + i, rows[7][1], i % 2) for i in range(300)]  # ties
    rows += [rows[10], rows[10], rows[20], rows[20]]  # repeated rows, one of them an anchor
    rows += [(None, rows[3][1], 1), (2000, None, 1), (2010, [0.1] * 6, None), (2020, [None] * 6, 1)]
    rows += [(2030, [float("nan")] * 6, 0), (2040, [float("inf")] * 6, 0), (2050, [1.0, 2.0], 1), (2060, [], 2)]
    rows += [(2051, [1.0, 2.0], 1), (2052, [0.9, 2.0], 2)]
    return rows


def plain_negatives(rows, every):
    kept = [(i, [math.floor(256 * c) for c in v], y) for i, v, y in rows if fits(v) and y is not None]
    last = lambda i: (i is None, i or 0)
    anchors = {}
    for i, x, y in kept:
        if i is not None and i % every == 0:
            anchors[i] = min(anchors.get(i, (y, len(x), x)), (y, len(x), x))
    out = Counter()
    for a, (label, _, x) in anchors.items():
        scores = [(-sum(map(lambda p, q: p * q, x, z)), last(i), i, y) for i, z, y in kept if i != a and len(z) == len(x)]
        for p, _, i, _ in sorted(s for s in scores if s[3] == label)[:5]:
            found = sorted(s for s in scores if s[3] != label and 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            for rank, (n, _, j, _) in enumerate(found, 1):
                out[a, i, rank, j, -p, -n] += 1
    return out


@pytest.mark.parametrize(("block", "chunk", "group"), [(512, 2048, 1 << 20), (8, 16, 500)])
def test_negatives_are_those_of_brute_force(spark, edge_rows, monkeypatch, block, chunk, group):
    monkeypatch.setattr(hard, "BLOCK", block)
    monkeypatch.setattr(hard, "CHUNK", chunk)
    monkeypatch.setattr(hard, "GROUP_BYTES", group)
    got = hard_negatives(vectors(spark, edge_rows), F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain_negatives(edge_rows, 10)
    assert len(expected) > 200
    assert Counter(map(tuple, got.collect())) == expected


def test_negatives_of_nothing(spark, edge_rows):
    assert hard_negatives(vectors(spark, []), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives(vectors(spark, edge_rows), F.lit(False)).count() == 0
    one_label = [(i, [0.1 * i, 1.0], 1) for i in range(20)]
    assert hard_negatives(vectors(spark, one_label), F.col("vec_id") % 10 == 0).count() == 0


def test_large_entries_stay_exact(spark):
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 2.0**20 for _ in range(5)], i % 2) for i in range(60)]
    got = hard_negatives(vectors(spark, rows), F.col("vec_id") % 5 == 0).collect()
    assert Counter(map(tuple, got)) == plain_negatives(rows, 5)
    assert hard_negatives(vectors(spark, [(i, [1e300, 1.0], i % 2) for i in range(9)]), F.lit(True)).count() == 0
    assert hard_negatives(vectors(spark, [(i, [1e13, 1.0], i % 2) for i in range(9)]), F.lit(True)).count() > 0


def test_bounds_spare_scores():
    """Anchors close together: most rows are out of reach without a score."""
    rng = np.random.default_rng(1)
    near = rng.normal(size=(1, 16)) * 500 + rng.normal(size=(40, 16)) * 5
    order, parent, edge = spanning_tree(near.astype(np.int64))
    assert sorted(order) == list(range(40)) and (parent[1:] < np.arange(1, 40)).all()
    tree = hard.Tree(16, 0, list(range(40)), near.astype(np.int64)[order], parent, edge, [[]] * 40)
    x = (rng.normal(size=(2000, 16)) * 300).astype(np.int64)
    rows = hard.Rows(x, np.sqrt((x.astype(float) ** 2).sum(axis=1)), np.arange(2000), np.zeros(2000, bool))
    best = [Best(5) for _ in range(40)]
    scored = hard.walk(
        tree,
        rows,
        lambda a, low, high: high >= np.sort(low)[-5],
        lambda a, at, s: best[a].offer(s, rows.key[at], rows.unknown[at]),
    )
    assert scored < 0.2 * 39 * 2000
    for a in range(40):
        assert best[a].ids() == np.lexsort((rows.key, -(x @ tree.x[a])))[:5].tolist()


def plain_whitening(rows, dim):
    x = np.array([[math.floor(256 * c) for c in v] for _, v, _ in rows if fits(v) and len(v) == dim], np.int64)
    fit = np.unique(x, axis=0)
    c = fit - fit.mean(axis=0)
    values, turn = np.linalg.eigh(c.T @ c / len(fit))
    return fit, values[::-1], turn[:, ::-1]


def test_whitening_is_that_of_the_covariance(spark, edge_rows):
    got = whiten(vectors(spark, edge_rows)).collect()
    fit, values, turn = plain_whitening(edge_rows, 6)
    sums = fit.sum(axis=0)
    taking = [(i, [math.floor(256 * c) for c in v]) for i, v, _ in edge_rows if fits(v) and len(v) == 6]
    assert len(got) == 4 * len(taking)
    assert Counter((r["id"], r["component"]) for r in got) == Counter((i, k) for i, _ in taking for k in (1, 2, 3, 4))
    of = dict(taking)
    signs = {}
    for r in got:
        k, x = r["component"], of[r["id"]]
        assert r["n"] == len(fit) and r["identity_error"] < 1e-10
        assert r["deviation"] == sum((len(fit) * v - int(s)) ** 2 for v, s in zip(x, sums, strict=True))
        assert r["explained"] == pytest.approx(values[k - 1] / values.sum(), rel=1e-10)
        expected = float((np.array(x) - sums / len(fit)) @ turn[:, k - 1] / np.sqrt(values[k - 1]))
        sign = signs.setdefault(k, 1 if expected * r["whitened"] > 0 else -1)
        assert r["whitened"] == pytest.approx(sign * expected, abs=1e-8)


def test_whitening_without_full_rank(spark):
    """A constant dimension, one that repeats another, fewer rows than dimensions."""
    rng = random.Random(4)
    rows = []
    for i in range(50):
        a, b = rng.gauss(0, 1), rng.gauss(0, 0.01)
        rows.append((i, [a, a, 3.0, b, b], 1))
    got = whiten(vectors(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2}
    assert all(r["identity_error"] < 1e-9 for r in got)
    _, values, _ = plain_whitening(rows, 5)
    for r in got:
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
    few = [(i, [rng.gauss(0, 1) for _ in range(8)], 1) for i in range(3)]
    got = whiten(vectors(spark, few)).collect()
    assert {r["component"] for r in got} == {1, 2} and all(r["identity_error"] < 1e-9 for r in got)


def test_whitening_of_nothing(spark):
    for rows in ([], [(1, None, 1)], [(1, [0.5, 0.25], 1)], [(i, [0.5, 0.25], 1) for i in range(9)], [(1, [], 1)]):
        assert whiten(vectors(spark, rows)).count() == 0


def test_deviation_beyond_a_long_is_null():
    x = np.array([[1 << 40, 0], [0, 0]], np.int64)
    assert deviations(x, 2, [1 << 40, 0]) == [None, None]
    x = np.array([[1 << 30, 0], [0, 5]], np.int64)
    assert deviations(x, 2, [1 << 30, 5]) == [(1 << 60) + 25, (1 << 60) + 25]
