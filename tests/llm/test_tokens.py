"""Token ids, retrieval packing and matrices against direct computation."""

import math
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidelog.llm.packing import Bm25Index, fill_windows, inverse_frequency, pack
from tidelog.llm.token_matrix import RoomTree, best_fit, pack_matrix
from tidelog.llm.tokens import PieceTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, World's end!! 42x", "Été naïve ß Ünï", "", None, " \n ", "don't 're I'LL", "x<|endoftext|>y <| z", "a\x1cb\x85c\xa0d",
    "ΑΣ Σ. İstanbul K", "日本語 text", "é combined", "½²3 9,9", "w" * 5000, "ﬁ \u200b zero", "Tab\tand\x0bvt", "''s '' 's't",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer(tokenizer):
    mine = PieceTokenizer(PATH)
    assert mine.by_piece
    alphabet = "aB é'.,!3<|>ß½\n\tsté日́"
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    for some in (texts, texts[::-1]):
        expected = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in some]
        assert [np.frombuffer(b, mine.dtype).tolist() for b in mine.encode(some)] == expected
    other = PieceTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_piece and len(other.encode(["Ab c"])[0]) > 0


@pytest.fixture
def rows():
    rng = random.Random(9)
    words = [f"{a}{b}" for a in ("ra", "to", "mi", "le") for b in ("n", "st", "ck", "x1")]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 400)))) for i in range(60)]
    return rows + list(enumerate(TEXTS, 1000)) + [(3, rows[3][1])] * 2 + [(None, "no id"), (2000, "many words " * 2500)]


def expected_ids(rows, tokenizer):
    found = defaultdict(list)
    for doc_id, text in rows:
        found[doc_id].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [1])
    return found


def test_pack(spark, rows, tokenizer):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, shard string")
    got = pack(df, window=256, shard_tokens=4000).collect()
    expected = expected_ids(rows, tokenizer)
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["doc_tokens"], ids))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    full = sum(sum(n for _, n in p) == 256 for p in sequences.values())
    assert len(sequences) - full <= 8  # at most one open window a shard
    for doc_id, docs in expected.items():
        # copies of a document give equal pieces of ids; each id is in one piece
        assert sum(len(p[2]) for p in pieces[doc_id]) == sum(map(len, docs))
        for start, n, ids in pieces[doc_id]:
            assert n == len(docs[0]) and ids == docs[0][start : start + len(ids)]
        if len(docs) == 1:
            starts = sorted((s, len(i)) for s, _, i in pieces[doc_id])
            assert all(a[0] + a[1] == b[0] for a, b in zip(starts, starts[1:], strict=False)) and starts[0][0] == 0
    assert pack(df.limit(0)).count() == 0


def test_bm25_is_bm25():
    docs = [np.array(d) for d in ([1, 2, 2, 3], [2, 3, 4], [5, 5, 6], [1, 6], [7], [8], [9])]
    df = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=10)
    idf, mean = inverse_frequency(df, len(docs)), np.mean([len(d) for d in docs])
    scores = Bm25Index(docs, idf, mean).scores(0)
    for k, d in enumerate(docs):
        want = 0.0
        for t in {1, 2, 3}:
            tf = int((d == t).sum())
            weight = max(0.0, math.log((len(docs) - df[t] + 0.5) / (df[t] + 0.5)))
            want += weight * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
        assert scores[k] == pytest.approx(want)


def test_seeds_take_their_neighbours_first():
    near = {0: [2], 2: [0], 1: [3], 3: [1]}

    def scores(seed):
        s = np.zeros(4)
        s[near[seed]] = 1.0
        return s

    windows = list(fill_windows(np.array([5, 5, 5, 5]), scores, window=10))
    assert [[p[0] for p in w] for w in windows] == [[0, 2], [1, 3]]
    assert list(fill_windows(np.array([], int), scores)) == []


def ranked_to_the_end(lengths, scores, window):
    """Windows by a whole ranking of all unused neighbours."""
    unused, left, windows = set(range(len(lengths))), None, []
    while left or unused:
        seed, at = left or (min(unused), 0)
        unused.discard(seed)
        left = None
        taken = min(lengths[seed] - at, window)
        pieces, room = [(seed, at, taken)], window - taken
        if at + taken < lengths[seed]:
            left = (seed, at + taken)
        score = scores(seed)
        for k in sorted((k for k in unused if score[k] > 0), key=lambda k: (-score[k], k)):
            if lengths[k] <= room and room:
                pieces.append((k, 0, lengths[k]))
                unused.remove(k)
                room -= lengths[k]
        while room and unused:
            k = min(unused, key=lambda k: (score[k] <= 0, -max(score[k], 0), k))
            unused.remove(k)
            pieces.append((k, 0, min(lengths[k], room)))
            if lengths[k] > room:
                left = (k, room)
            room -= min(lengths[k], room)
        windows.append(pieces)
    return windows


def test_windows_of_short_rests_are_filled_by_retrieval():
    near = np.arange(601) > 300  # row order alone would give the others

    def scores(seed):
        return np.where(near, 1.0 + np.arange(601) / 1000, 0.0)

    first = next(fill_windows(np.full(601, 10), scores, window=2048))
    assert [k for k, _, _ in first] == [0, *range(600, 396, -1)] and first[-1][2] == 8
    # the 65th neighbour fits whole where the 64 before it are too long
    lengths = np.array([10] + [2000] * 64 + [90] + [5] * 3)
    ranked = np.array([0.0] + [9.0] * 64 + [1.0] + [0.0] * 3)
    first = next(fill_windows(lengths, lambda seed: ranked, window=1000))
    assert first == [(0, 0, 10), (65, 0, 90), (1, 0, 900)]


@pytest.mark.parametrize("neighbours", [1, 3, 64])
def test_windows_equal_a_whole_ranking(neighbours):
    rng = np.random.default_rng(neighbours)
    for n in (1, 30, 400):
        lengths = rng.choice([1, 2, 3, 7, 20, 90], n)
        table = rng.integers(0, 6, (n, n)) * (rng.random((n, n)) < 0.6)
        got = list(fill_windows(lengths, lambda k: table[k].astype(float), 64, neighbours))  # noqa: B023
        assert got == ranked_to_the_end(lengths.tolist(), lambda k: table[k], 64)  # noqa: B023


def test_best_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, 500)
    rows = best_fit(lengths, 100)
    assert sorted(k for r in rows for k in r) == list(range(500))
    plain = []  # best fit decreasing by trying every row
    for k in sorted(range(500), key=lambda k: -lengths[k]):
        fits = [r for r in plain if sum(lengths[r]) + lengths[k] <= 100]
        if fits:
            max(fits, key=lambda r: sum(lengths[r])).append(k)
        else:
            plain.append([k])
    assert sorted(int(sum(lengths[r])) for r in rows) == sorted(int(sum(lengths[r])) for r in plain)
    tree = RoomTree(8)
    for room in (3, 7, 8):
        tree.add(room, 1)
    assert [tree.least(n) for n in (1, 3, 4, 7, 8)] == [3, 3, 7, 7, 8]
    tree.add(8, -1)
    assert tree.least(8) is None


def test_matrix(spark, rows, tokenizer):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pack_matrix(df, window=256, shard_tokens=6000).collect()
    expected = expected_ids(rows, tokenizer)
    seen = defaultdict(int)
    assert len({r["sequence_id"] for r in got}) == len(got)
    for r in got:
        ids, positions = (np.frombuffer(bytes(r[c]), "<u4") for c in ("ids", "positions"))
        before = r["lengths_before"]
        assert len(ids) == len(positions) == 256 and before[0] == 0 and before[-1] == r["used"]
        for doc_id, start, a, b in zip(r["doc_ids"], r["starts"], before, before[1:], strict=False):
            assert ids[a:b].tolist() == expected[doc_id][0][start : start + b - a]
            assert positions[a:b].tolist() == list(range(b - a))
            seen[doc_id] += b - a
        assert not ids[r["used"] :].any() and not positions[r["used"] :].any()
    assert seen == {d: sum(map(len, x)) for d, x in expected.items()}
    assert pack_matrix(df.limit(0)).count() == 0
