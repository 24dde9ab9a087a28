"""What each stage of the pipeline keeps, and what op4 and op9 give, in plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tidelog.llm import classifier, jaccard, packing
from tidelog.llm.classifier import BUCKETS, SEED, NGrams, fit
from tidelog.llm.sharding import difference
from tidelog.session import BATCH_BYTES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that have the names of results, of working columns, and a dot.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " kept string, size int, taken int, `a.b` string, id string, _mix_src string"
)
NAMES = ["doc_id", "text", "lang", "source", "n_chars", "kept", "size", "taken", "a.b", "id", "_mix_src"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def row(i, text, source):
    return (i, text, "en", source, None if text is None else len(text), "k", 1, 2, "dot", "i", None)


@pytest.fixture(scope="module")
def corpus():
    """Good prose, junk, near and exact copies, boilerplate, nulls and ties."""
    rng = random.Random(12)
    words = [f"{a}{b}{c}" for a in ("ma", "re", "to", "li") for b in ("n", "st", "ck", "v") for c in ("er", "o", "ing", "a")]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    junk = lambda n: " ".join(rng.choice(("$$$ 99", "XX9 #1", "|| %%", "A1B2")) for _ in range(n))
    rows, labels = [], []
    for i in range(260):
        bad = i % 4 == 3
        text = junk(rng.randint(30, 90)) if bad else prose(rng.randint(60, 200))
        source = (None, "a", "b", "c", "d")[i % 5]
        if source == "a" and not bad:
            text = f"Share   THIS page\n{text}"
        rows.append(row(i, text, source))
        if i % 2:
            labels.append((i, 0 if bad else 1, int(i % 22 == 1)))
    for i in range(20):  # near copies: one word of many is another
        copy = rows[i * 4][1].split(" ")
        copy[len(copy) // 2] = "changed"
        rows.append(row(1000 + i, " ".join(copy), "b"))
    rows += [row(2000 + i, rows[8][1], "c") for i in range(15)]
    rows += [rows[12], rows[12], row(None, rows[16][1], "a"), row(3000, None, "a"), row(3001, "", None), row(3002, " \n", "d")]
    rows += [row(None, prose(150), "d"), row(3003, "short text", "a"), row(3004, "\n".join([prose(20)] * 12), "b"), row(-7, prose(4000), "c")]
    labels += [(None, 1, 0), (4, None, 0), (5, 1, 0), (3001, 1, 0)]
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    frame(spark, corpus[0]).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(corpus[1], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


# --- 9 ----------------------------------------------------------------------


def n_grams(text):
    words = WORD.findall(text or "")
    forms = []
    for i, w in enumerate(words):
        f = re.sub(r"\d+", "0", re.sub(r"[A-Z]+", "A", re.sub(r"[^\W\dA-Z_]+", "a", w)))
        forms.append("=" if i and words[i - 1] == w else f)
    form = [zlib.crc32(b"f" + f.encode()) for f in forms]
    word = [zlib.crc32(b"w" + w.encode()) for w in words]
    found = word + form
    for items in (form, word):
        for a, b in zip(items, items[1:], strict=False):
            found.append(((a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F) % (1 << 64)) >> 24)
    return [x % BUCKETS for x in found]


def gumbel(doc_id):
    seeded = xxhash.xxh64_intdigest(SEED.to_bytes(4, "little"), 42)
    drawn = xxhash.xxh64_intdigest(("" if doc_id is None else str(doc_id)).encode(), seeded)
    return -math.log(-math.log(((drawn >> 11) + 0.5) / (1 << 53)))


def plain_classifier(rows, labels):
    """``(id, text)`` to weight, drawn weight and whether it is kept."""
    quality, toxic = defaultdict(list), defaultdict(list)
    for i, q, t in labels:
        if i is not None and q is not None:
            quality[i].append(q)
            toxic[i].append(t or 0)
    good = {i for i in quality if min(quality[i]) == 1 and max(toxic[i]) == 0}
    bad = {i for i in quality if min(quality[i]) == 0}
    raw, target = Counter(), Counter()
    for r in rows:
        found = Counter(n_grams(r[1]))
        raw.update(found)
        if r[0] in good:
            target.update(found)
    every, wanted = sum(raw.values()) + BUCKETS, sum(target.values()) + BUCKETS
    weigh = lambda t: sum(math.log((target[b] + 1) / wanted) - math.log((raw[b] + 1) / every) for b in n_grams(t))
    weights = {(r[0], r[1]): weigh(r[1]) for r in rows if WORD.search(r[1] or "")}
    judged = [(w, i in good, i in bad) for r in rows for i, w in [(r[0], weights.get((r[0], r[1])))] if w is not None and i in quality]
    cuts = sorted({w for w, _, _ in judged})
    places = [-math.inf, *[(a + b) / 2 for a, b in zip(cuts, cuts[1:], strict=False)], math.inf]
    goods, bads = sum(g for _, g, _ in judged), sum(b for _, _, b in judged)
    gain = lambda c: sum(b for w, _, b in judged if w < c) / bads - sum(g for w, g, _ in judged if w < c) / goods
    bound = max(places, key=lambda c: (round(gain(c), 12), -c))
    of_rows = [weights[r[0], r[1]] for r in rows if (r[0], r[1]) in weights]
    k = sum(w >= bound for w in of_rows)
    drawn = {key: w + gumbel(key[0]) for key, w in weights.items()}
    least = sorted((drawn[r[0], r[1]] for r in rows if (r[0], r[1]) in weights), reverse=True)[k - 1]
    return {(r[0], r[1]): (weights.get((r[0], r[1])), drawn.get((r[0], r[1])), drawn.get((r[0], r[1]), -math.inf) >= least) for r in rows}


def test_classifier_counts_weighs_and_draws(spark, corpus, folder):
    rows, labels = corpus
    expected = plain_classifier(rows, labels)
    fitted = fit(frame(spark, rows).select("doc_id", "text", "lang"), spark.read.parquet(f"{folder}/labels.parquet"), columns=["text"])
    got = fitted.weights.collect()
    assert len(got) == len(rows)
    for r in got:
        weight, drawn, kept = expected[r["id"], r["text"]]
        assert r["kept"] == kept
        if weight is None:
            assert r["log_weight"] is None and r["gumbel_weight"] is None
        else:
            assert r["log_weight"] == pytest.approx(weight, abs=1e-8)
            assert r["gumbel_weight"] == pytest.approx(drawn, abs=1e-8)
    assert 100 < sum(r["kept"] for r in got) < 300


# --- 4 ----------------------------------------------------------------------


def plain_difference(sizes, k):
    """Karmarkar-Karp on lists: the two partitions of largest spread, the first
    of equal ones, joined in opposite order."""
    open_ = [(i, [(s, [i])] + [(0, [])] * (k - 1)) for i, s in enumerate(sizes)]
    while len(open_) > 1:
        open_.sort(key=lambda x: (-(x[1][0][0] - x[1][-1][0]), x[0]))
        (i, a), (_, b) = open_[:2]
        joined = [(x + y, p + q) for (x, p), (y, q) in zip(a, b[::-1], strict=True)]
        open_ = [(i, sorted(joined, key=lambda part: -part[0]))] + open_[2:]
    return open_[0][1]


def test_a_worker_keeps_few_words():
    texts = [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(120)]
    grams = NGrams(BUCKETS)
    for text in [*texts, *texts[:3]]:
        assert (grams.of(text) == NGrams(BUCKETS).of(text)).all()
        assert len(grams.word) <= 50_000


def test_texts_go_to_python_in_bounded_batches(spark, corpus, folder, monkeypatch):
    """While a stage sends texts to Python its batches have a bound in bytes."""
    bounds = {}
    for module in (classifier, jaccard, packing):

        def watched(df, name, compression=None, real=module.stored):
            bounds[name] = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
            return real(df, name, compression)

        monkeypatch.setattr(module, "stored", watched)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert all(bounds[n] == str(BATCH_BYTES) for n in ("weights", "shingles", "lists", "sets", "links", "tokens"))


@pytest.mark.parametrize(("count", "k"), [(1, 3), (40, 2), (60, 3), (200, 7), (90, 40)])
def test_difference_is_the_direct_one(count, k):
    rng = random.Random(count)
    sizes = [rng.randint(1, 500) for _ in range(count)]
    sums = np.zeros((count, k), np.int64)
    sums[:, 0] = sizes
    got = defaultdict(list)
    for i, part in enumerate(difference(sums)[:, 0]):
        got[int(part)].append(i)
    expected = plain_difference(sizes, k)
    assert sorted(map(sorted, got.values())) == sorted(sorted(members) for _, members in expected if members)


# --- the stages -------------------------------------------------------------


def plain_rules(rows):
    """What the quality rules keep, with the text that is left."""
    plain = lambda line: re.sub(r"[\x20\x09-\x0D]+", " ", line.lower()).strip(" ")
    held, documents = defaultdict(set), defaultdict(set)
    for r in rows:
        documents[r[3]].add(r[1])
        for line in (r[1] or "").split("\n"):
            if WORD.search(line):
                held[r[3], plain(line)].add(r[1])
    gone = {x for x, t in held.items() if len(t) > 100 or len(t) > 10 and len(t) > 0.05 * len(documents[x[0]])}
    out = Counter()
    for r in rows:
        words = WORD.findall(r[1] or "")
        grams = defaultdict(list)
        for i in range(len(words) - 2):
            grams[tuple(words[i : i + 3])].append(i)
        repeats = len({j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 3)})
        left = [x for x in (r[1] or "").split("\n") if (r[3], plain(x)) not in gone]
        text = "\n".join(left)
        if len(words) >= 50 and 2 * repeats <= len(words) and len(WORD.findall(text)) >= 0.3 * len(words):
            out[r[0], text, r[3], len(text)] += 1
    return out


def plain_near(rows):
    """One row of each component of near copies: its least id, null last."""
    words = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]
    sets = []
    for r in rows:
        w = words(r[1])
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            root[top(i)] = top(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[top(i)].append((r[0] is None, r[0] or 0, r[0]))
    return Counter(min(g)[2] for g in groups.values())


def plain_mix(rows):
    """How often each row is in the mix."""
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    total = Counter()
    for r, s in zip(rows, size, strict=True):
        total[r[3]] += s
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held, left = {}, 1.5 * sum(size)
    while True:
        free = [s for s in names if s not in held]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * level >= 2 * total[s]]
        if not over:
            break
        for s in over:
            held[s] = 2.0 * total[s]
            left -= held[s]
    out = Counter()
    for s in names:
        target = held.get(s, weight[s] * level)
        epochs = int(target // total[s]) if total[s] else 0
        rest = round(target) - epochs * total[s]
        seeded = lambda r: hashlib.md5(
            f"17:{r[0] if r[0] is not None else ':' + hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()
        ).hexdigest()
        mine = sorted((seeded(r), r[0] is not None, r[0] or 0, n, r) for r, n in zip(rows, size, strict=True) if r[3] == s)
        for _, _, _, n, r in mine:
            part = max(0, min(n, rest))
            rest -= n
            times = epochs + (2 * part >= n) if n else 0
            out[r[0], r[1]] += times
    return +out


def test_stages_keep_what_they_should(spark, corpus, folder):
    rows, labels = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert docs.columns == NAMES
    plain = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = [tuple(r) for r in before.collect()]
        after = corpus_pipeline.stored(stage(spark, before, folder), "test")
        assert after.columns == NAMES and after.dtypes == docs.dtypes
        got = [tuple(r) for r in after.collect()]
        assert {r[5:10] for r in got} == {("k", 1, 2, "dot", "i")}
        if name == "quality classifier":
            verdict = plain_classifier(given, labels)
            assert Counter(got) == Counter(r for r in given if verdict[r[0], r[1]][2])
        elif name == "quality rules":
            assert Counter((r[0], r[1], r[3], r[4]) for r in got) == plain_rules(given)
            shares = lambda rows: sum(r[3] == "a" and "Share" in (r[1] or "") for r in rows)
            assert shares(given) > 10 and shares(got) == 0
        elif name == "n-gram Jaccard join":
            assert Counter(r[0] for r in got) == plain_near(given)
            assert len(got) < len(given) and set(got) <= set(given)
        else:
            assert Counter((r[0], r[1]) for r in got) == plain_mix(given)
        plain[name] = len(got)
        before = after
    assert min(plain.values()) > 50
    pieces = corpus_pipeline.run(spark, folder).collect()
    whole, told = Counter(), {}
    for r in pieces:
        whole[r["doc_id"]] += r["length"]
        told[r["doc_id"]] = r["doc_tokens"]
    copies = Counter(r["doc_id"] for r in before.collect())
    assert set(whole) == set(copies)
    assert all(whole[i] == n * told[i] for i, n in copies.items() if i is not None)


def test_stages_of_nothing(spark, folder):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == NAMES and after.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
