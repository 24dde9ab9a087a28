"""Mixing, quality rules and fingerprints against plain definitions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash

from tidelog.llm import quality_rules
from tidelog.llm.fingerprints import GRAM, PIECE, WINDOW, fingerprint, read_shown
from tidelog.llm.mixing import mix, repeated
from tidelog.llm.quality_rules import judge

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, size string, kept string, _mix_src string"


def documents(spark, rows):
    """Extra columns have the names of results and of working columns."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


@pytest.fixture
def edge_rows():
    rng = random.Random(1)
    words = ["ab", "cd.", "Éf", "g|h", "IJ", "k\u2003l", "𝒳y"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 120))), f"s{i % 4}") for i in range(40)]
    rows += [(100, None, "s1"), (101, "", "s2"), (102, " \n\t", None), (None, "no id here", None)]
    rows += [(7, rows[7][1], "s3")] * 2 + [(200, "word " * 5000, "s0"), (201, "long" * 9000, "big")]
    return rows


def test_mix_takes_what_targets_say(spark, edge_rows):
    got = mix(documents(spark, edge_rows)).collect()
    sizes = defaultdict(int)
    for _, text, source in edge_rows:
        sizes[source] += len(WORD.findall(text or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held, left = {}, 1.5 * sum(sizes.values())
    while True:  # water-filling as it is told
        free = [s for s in names if s not in held]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level >= 2 * sizes[s]]
        if not over:
            break
        for s in over:
            held[s] = 2.0 * sizes[s]
            left -= held[s]
    target = {s: held.get(s, weight[s] * level) for s in names}
    taken = Counter()
    assert len(got) == len(edge_rows)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= 1
    assert sorted(map(str, got)) == sorted(map(str, mix(documents(spark, edge_rows)).collect()))


def test_repeated_documents_are_whole_and_near_the_target(spark, edge_rows):
    mixed = mix(documents(spark, edge_rows).drop("size"))
    told = mixed.collect()
    rows = repeated(mixed).collect()
    texts = {text for _, text, _ in edge_rows}
    assert all(r["text"] in texts for r in rows)
    for source in {r["source"] for r in told}:
        mine = [r for r in told if r["source"] == source]
        words = sum(len(WORD.findall(r["text"] or "")) for r in rows if r["source"] == source)
        # one document of a source is rounded
        assert abs(words - sum(r["taken"] for r in mine)) <= max(r["size"] for r in mine) / 2
    most = Counter((r["doc_id"], r["text"]) for r in told)
    for key, n in Counter((r["doc_id"], r["text"]) for r in rows).items():
        assert n <= 2 * most[key]


def test_rows_without_an_id_are_spread(spark):
    rows = [(None, f"text number {i}", "s") for i in range(200)]
    plan = mix(documents(spark, rows)).collect()
    assert 200 * 3 * 1.5 == sum(r["taken"] for r in plan)
    assert {r["taken"] for r in plan} >= {3, 6}


def test_mix_of_nothing(spark):
    assert mix(documents(spark, [])).count() == 0
    only = mix(documents(spark, [(1, None, None), (2, "", "a")])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only] == [(0, 0.0, 0)] * 2


def repeats(words):
    grams = defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i : i + 3])].append(i)
    return len({j for at in grams.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)})


@pytest.mark.parametrize("bits", [33, 3])
def test_base_measures(spark, edge_rows, monkeypatch, bits):
    """With few bits of a hash different windows meet all the time."""
    monkeypatch.setattr(quality_rules, "_HASH_BITS", bits)
    got = judge(documents(spark, edge_rows)).collect()
    expected = Counter()
    for doc_id, text, _ in edge_rows:
        words = WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * repeats(words) > 50 * len(words)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        expected[doc_id, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeats(words), failed] += 1
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(tuple(r[n] for n in names) for r in got) == expected
    assert judge(documents(spark, [])).count() == 0


def test_common_lines_go_and_depleted_documents_with_them(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, f"Subscribe   NOW\n{own(i)}", "h1") for i in range(20)]
    rows += [(50, "subscribe now\n" * 40 + "one two three", "h1")]
    rows += [(60 + i, f"Subscribe now\n{own(60 + i)}", "h2") for i in range(5)]
    # equal texts count as one document of the host
    rows += [(100 + i, f"copied line\n{own(999)}", "h2") for i in range(30)]
    got = {r["doc_id"]: r for r in judge(documents(spark, rows), max_repeated=1.0).collect()}
    assert got[0]["clean_text"] == own(0) and got[0]["kept"] and got[0]["left_words"] == 60
    assert not got[50]["kept"] and not got[50]["base_failed"] and got[50]["left_words"] == 3
    assert got[60]["clean_text"].startswith("Subscribe") and got[60]["kept"]
    assert got[100]["clean_text"].startswith("copied line") and got[100]["kept"]


def test_lines_in_many_documents_go_whatever_their_share(spark):
    own = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, f"Share THIS page\n{own(i)}", "big") for i in range(15)]
    rows += [(20 + i, f"in twelve\n{own(20 + i)}", "big") for i in range(12)]
    rows += [(50, "share this page\n" * 40 + "one two three", "big")]
    rows += [(100 + i, f"plain {i}\n{own(100 + i)}", "big") for i in range(400)]
    rows += [(600 + i, f"share this page\n{own(600 + i)}", "small") for i in range(5)]
    # 300 copies of one text are one document
    rows += [(700 + i, f"copied line\nshare this page\n{own(999)}", "big") for i in range(300)]
    rows += [(None, None, None), (None, f"share this page\n{own(0)}", None)]
    docs = documents(spark, rows)
    by_share = {r["doc_id"]: r for r in judge(docs, max_repeated=1.0).collect()}
    assert by_share[50]["kept"] and by_share[0]["clean_text"].startswith("Share")
    judged = judge(docs, max_repeated=1.0, line_most=12).collect()
    assert len(judged) == len(rows)
    got = {r["doc_id"]: r for r in judged}
    for i in range(15):
        assert got[i]["clean_text"] == own(i) and got[i]["kept"] and got[i]["left_words"] == 60
    assert got[20]["clean_text"] == f"in twelve\n{own(20)}"
    assert not got[50]["kept"] and not got[50]["base_failed"] and got[50]["left_words"] == 3
    assert got[100]["clean_text"] == f"plain 0\n{own(100)}" and got[100]["left_words"] == 62
    assert got[600]["clean_text"].startswith("share") and got[600]["kept"]
    copies = [r for r in judged if 700 <= (r["doc_id"] or 0)]
    assert {r["clean_text"] for r in copies} == {f"copied line\n{own(999)}"} and len(copies) == 300
    # lines above the share go as before
    # measures and verdicts need no text beside the removed lines
    node = judge(docs, line_most=12).select("doc_id", "n_words", "kept")._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Join":
        node = node.children().apply(0)
    assert "text#" not in node.output().mkString(" ")
    more = {r["doc_id"]: r["clean_text"] for r in judge(docs, max_repeated=1.0, line_share=0.03, line_most=400).collect()}
    assert more[0] == own(0) and more[20] == f"in twelve\n{own(20)}"


def winnow(text):
    pieces = re.findall(PIECE, text)
    if not pieces:
        return []
    gram = min(GRAM, len(pieces))
    hashes = []
    for i in range(len(pieces) - gram + 1):
        hashes.append(xxhash.xxh64_intdigest("".join(pieces[i : i + gram]).encode(), 42) >> 32)
    chosen = set()
    for i in range(max(len(hashes) - WINDOW + 1, 1)):
        window = hashes[i : i + WINDOW]
        least = min(window)
        chosen.add((least, i + max(j for j, h in enumerate(window) if h == least)))
    return sorted(chosen, key=lambda x: x[1])


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints(spark, edge_rows):
    rows = [r for r in edge_rows if r[0] not in (200, 201)] + [(300, "ab " * 3000, "s0"), (301, "x" * 3000, "s")]
    got = fingerprint(documents(spark, rows).drop("kept")).collect()
    assert len(got) == len(rows)
    ids = sorted({r[0] for r in rows if r[0] is not None}, reverse=True) + [None]
    text = {r[0]: r[1] or "" for r in rows}
    for r in got:
        own = text[r["doc_id"]]
        following = text[ids[(ids.index(r["doc_id"]) + 1) % len(ids)]]
        need = len(own) // 3
        edited = own[: len(own) - need] + following[:need]
        assert r["n_chars"] == len(own)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert read_shown(r["fingerprint"]) == winnow(own)
        assert read_shown(r["edited_fingerprint"]) == winnow(edited)
        assert r["near_edited"] == pytest.approx(alike(winnow(own), winnow(edited)))
        assert r["near_next"] == pytest.approx(alike(winnow(own), winnow(following)))
    one = fingerprint(documents(spark, [(1, "a b c d e f g h i", None)]).drop("kept")).first()
    assert one["near_next"] == 1.0
    assert fingerprint(documents(spark, [])).count() == 0


def test_a_shift_without_white_space_leaves_the_fingerprint(spark):
    rng = random.Random(5)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(3000))
    spaced = " ".join("".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(400))
    shared = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(GRAM + WINDOW - 1))
    rows = [(1, chinese, ""), (2, "x" + chinese, ""), (3, spaced, ""), (4, "x" + spaced.replace(" ", "\n\n"), "")]
    rows += [(5, "ab" * 40 + shared + "c" * 90, ""), (6, "𝒳 d" * 70 + shared + "yz" * 33, "")]
    got = {r["doc_id"]: read_shown(r["fingerprint"]) for r in fingerprint(documents(spark, rows)).collect()}
    assert alike(got[1], got[2]) > 0.95
    assert alike(got[3], got[4]) > 0.95
    assert {h for h, _ in got[5]} & {h for h, _ in got[6]}
