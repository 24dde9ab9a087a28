"""The registered queries without SQL: columns, types and what their rows must say."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidelog.llm import queries

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def ids_of(documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in documents}


def types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def gapless(places):
    at = 0
    for offset, length in sorted(places):
        assert offset == at
        at += length
    return at


def pieces_are_right(rows, ids_of):
    sequences, lengths = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = ids_of[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(ids) == r["length"] > 0 and r["doc_tokens"] == len(ids_of[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        lengths[r["doc_id"]].append((r["start"], r["length"]))
    assert max(gapless(p) for p in sequences.values()) <= 2048
    assert {i: gapless(p) for i, p in lengths.items()} == {i: len(x) for i, x in ids_of.items()}
    return len(sequences)


def test_op1(spark, ids_of):
    df = queries.QUERIES["op1_packing"](spark, SF_DIR)
    assert types(df) == dict.fromkeys(
        ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), "bigint"
    )
    count = pieces_are_right(df.collect(), ids_of)
    assert count <= 1.1 * sum(map(len, ids_of.values())) / 2048 + 2


def test_op4(spark, documents):
    df = queries.QUERIES["op4_sharding"](spark, SF_DIR)
    longs = dict.fromkeys(("doc_id", "size", "text_crc32", "slot"), "bigint")
    assert types(df) == longs | {"law": "string", "shard": "int", "grown_shard": "int"}
    text = {i: t or "" for i, t in documents}
    shards, slots, bytes_ = {}, defaultdict(list), Counter()
    rows = df.collect()
    for r in rows:
        raw = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 16, zlib.crc32(raw))
        assert (r["law"], r["grown_shard"]) == ("bytes", None) and 0 <= r["shard"] < 40
        assert shards.setdefault(raw, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
    assert len(rows) == len(documents) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for t in text.values():
        groups[t] += len(t.encode()) + 16
    assert max(bytes_.values()) <= max(max(groups.values()), 1.02 * sum(groups.values()) / 40)


def test_op5(spark, documents):
    df = queries.QUERIES["op5_fingerprints"](spark, SF_DIR)
    strings = dict.fromkeys(("edited_sha256", "fingerprint", "edited_fingerprint"), "string")
    assert types(df) == {"doc_id": "bigint", "n_chars": "bigint", "near_edited": "double", "near_next": "double"} | strings
    text = {i: t or "" for i, t in documents}
    order = sorted(text, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    prints = defaultdict(set)
    rows = df.collect()
    for r in rows:
        own, other = text[r["doc_id"]], text[following[r["doc_id"]]]
        need = len(own) // 3
        edited = own[: len(own) - need] + other[:need]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints[own].add(r["fingerprint"])
    assert len(rows) == len(documents) and all(len(p) == 1 for p in prints.values())
    assert np.mean([r["near_edited"] for r in rows]) > np.mean([r["near_next"] for r in rows]) + 0.3


def test_op7(spark, ids_of):
    df = queries.QUERIES["op7_token_matrix"](spark, SF_DIR)
    assert {"sequence_id", "doc_ids", "starts", "lengths_before", "used"} <= set(df.columns)
    assert sum(r["used"] for r in df.collect()) == sum(map(len, ids_of.values()))


def test_op9(spark, documents):
    df = queries.QUERIES["op9_quality_classifier"](spark, SF_DIR)
    assert types(df) == {"doc_id": "bigint", "log_weight": "double", "gumbel_weight": "double", "kept": "boolean"}
    rows = df.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in documents)
    text = {i: t or "" for i, t in documents}
    assert all((r["log_weight"] is None) == (not WORD.search(text[r["doc_id"]])) for r in rows)


def test_op10(spark, documents):
    df = queries.QUERIES["op10_ngram_jaccard"](spark, SF_DIR)
    assert types(df) == dict.fromkeys(("doc_id", "n_shingles", "component_id"), "bigint")
    sets = {}
    for i, t in documents:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]
        sets[i] = {tuple(words[k : k + 4]) for k in range(len(words) - 3)} or ({tuple(words)} if words else set())
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ordered = sorted(sets)
    for n, a in enumerate(ordered):
        for b in ordered[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()} == {i: (len(s), top(i)) for i, s in sets.items()}


def test_op12(spark):
    df = queries.QUERIES["op12_whitening"](spark, SF_DIR)
    assert types(df) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    vectors = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet'").fetchall()
    x = {i: [math.floor(256 * float(np.float32(c))) for c in v] for i, v in vectors}
    fit = np.unique(np.array(list(x.values())), axis=0)
    c = fit - fit.mean(axis=0)
    values, turn = np.linalg.eigh(c.T @ c / len(fit))
    values, turn = values[::-1], turn[:, ::-1]
    sign = {}
    rows = df.collect()
    assert len(rows) == 4 * len(x)
    for r in rows:
        k = r["component"] - 1
        want = float((np.array(x[r["vec_id"]]) - fit.mean(axis=0)) @ turn[:, k] / np.sqrt(values[k]))
        s = sign.setdefault(k, np.sign(want * r["whitened"]))
        assert r["whitened"] == pytest.approx(s * want, abs=1e-7)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9) and r["identity_error"] < 1e-9
        assert r["deviation"] == int(((len(fit) * np.array(x[r["vec_id"]]) - fit.sum(axis=0)) ** 2).sum())


def test_pipeline_rows(spark):
    df = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"} <= set(df.columns)
    sequences = defaultdict(list)
    for r in df.collect():
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sequences and max(gapless(p) for p in sequences.values()) <= 2048
