"""Removal of repeated passages against its definition."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidelog.llm import substring_dedup as sub
from tidelog.llm.substring_dedup import drop_repeats, from_planes, planes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, id string, name string, `a.b` int, spans string, n_words int"


def documents(spark, rows, parts=3):
    """Extra columns have the names of results and of working columns."""
    return spark.createDataFrame([(*r, "i", "n", 1, "s", 5) for r in rows], SCHEMA).repartition(parts, "doc_id")


def plain(rows, k):
    least = {}
    words = [WORD.findall(t or "") for _, t in rows]
    order = lambda i: (i is None, i or 0)
    for (i, _), w in zip(rows, words, strict=True):
        for s in range(len(w) - k + 1):
            gram = tuple(w[s : s + k])
            least[gram] = min(least.get(gram, order(i)), order(i))
    out = Counter()
    for (i, _), w in zip(rows, words, strict=True):
        gone = {s + j for s in range(len(w) - k + 1) if least[tuple(w[s : s + k])] < order(i) for j in range(k)}
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        out[i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest(), left] += 1
    return out


@pytest.fixture
def rows():
    rng = random.Random(2)
    words = ["ab", "Ab", "cd.", "Éf", "g|h", "IJ", "k l", "𝒳y", "x\x00y"] + [f"w{i}" for i in range(200)]
    fresh = lambda n: rng.choices(words, k=n)
    passages = [fresh(rng.randint(3, 60)) for _ in range(12)]
    docs = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            # whole passages, their beginnings and their ends
            a, b = rng.choice([(0, len(p)), (0, len(p) // 2), (len(p) // 3, len(p))])
            parts += fresh(rng.randint(0, 25)) + p[a:b]
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(parts)))
    docs += [(200 + i, docs[7][1]) for i in range(30)]  # copies
    docs += [docs[50], docs[50], docs[60]]  # repeated rows
    docs += [(70, docs[3][1]), (300, None), (301, ""), (302, " \n\t"), (303, "one two"), (None, docs[9][1]), (None, docs[7][1])]
    docs += [(-5, " ".join(passages[0])), (400, "la " * 3000), (401, "la " * 50), (399, " ".join(fresh(20000)))]
    docs += [(500, docs[-1][1] + " tail"), (501, "ab" * 30000)]
    return docs


@pytest.mark.parametrize(("k", "bits", "chunk"), [(13, 64, 8 << 20), (13, 64, 2000), (13, 12, 20_000), (5, 16, 8 << 20)])
def test_what_is_kept_is_what_the_definition_keeps(spark, rows, monkeypatch, k, bits, chunk):
    """Few bits make hashes of different windows meet all the time."""
    monkeypatch.setattr(sub, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(sub, "GROUP_BYTES", chunk // 10)
    if bits < 64:
        rows = [r for r in rows if r[0] not in (399, 500, 400)]
    got = drop_repeats(documents(spark, rows), k=k, texts=True, hash_bits=bits)
    expected = plain(rows, k)
    assert sum(n * c[2] for c, n in expected.items()) > 1000
    assert Counter(map(tuple, got.collect())) == expected


def test_nothing_to_drop(spark):
    assert drop_repeats(documents(spark, [])).count() == 0
    got = drop_repeats(documents(spark, [(1, None), (2, "a b c"), (2, "a b c")])).collect()
    assert sorted((r["id"], r["n_words"], r["n_removed"]) for r in got) == [(1, 0, 0), (2, 3, 0), (2, 3, 0)]


def test_a_passage_of_many_documents_is_a_few_rows(spark):
    """One path however long, and a hot edge goes to its bucket once a chunk."""
    passage = " ".join(f"p{i}" for i in range(400))
    rows = [(i, f"own{i} {passage} end{i}") for i in range(1000)]
    docs = documents(spark, rows, 2).selectExpr("doc_id AS id", "xxhash64(text) AS key", "text")
    assert sub.repeated_spans(docs, 13, 6, 64).selectExpr("count(*)", "count(DISTINCT path)", "max(n)").first()[:] == (1000, 1, 388)
    sent = sub.sent_edges(docs, 13, 6, 64).where("NOT head").selectExpr("sum(length(pos)) / 4").first()[0]
    assert sent < 2 * (388 + 1000 * 24) + 1


def test_planes_come_back():
    a = np.array([0, 1, 1 << 40, (1 << 64) - 1], np.uint64)
    assert (from_planes(planes(a), np.uint64) == a).all()
