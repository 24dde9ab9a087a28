import random
from collections import Counter, defaultdict

import numpy as np

from tidelog.llm import sharding
from tidelog.llm.sharding import difference, shard


def test_difference_places_every_part_and_balances():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 1000, 200)
    sums = np.zeros((200, 7), np.int64)
    sums[:, 0] = sizes
    parts = difference(sums)
    total = np.bincount(parts[:, 0], sizes, 7)
    assert (np.sort(parts, axis=1) == np.arange(7)).all()
    assert total.max() - total.min() <= 3
    # the textbook case for two parts: {8, 7, 6, 5, 4} differ by 2
    two = np.zeros((5, 2), np.int64)
    two[:, 0] = [8, 7, 6, 5, 4]
    total = np.bincount(difference(two)[:, 0], two[:, 0], 2)
    assert abs(total[0] - total[1]) == 2


def test_shards(spark, monkeypatch):
    """Small blocks, so that several levels are taken."""
    monkeypatch.setattr(sharding, "BLOCK", 8)
    monkeypatch.setattr(sharding, "FAN_IN", 3)
    rng = random.Random(2)
    rows = [(i, "é" * rng.randint(0, 300)) for i in range(300)]
    rows += [(1000 + i, "same " * 200) for i in range(60)] + [(5, rows[5][1])] * 3 + [(None, None), (9000, ""), (9001, "z" * 90000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, slot int")
    got = shard(df, shards=6).collect()
    assert len(got) == len(rows)
    group, slots, bytes_ = {}, defaultdict(list), Counter()
    for r in got:
        text = r["text"] or ""
        assert r["size"] == len(text.encode()) + 16
        assert group.setdefault(text, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        bytes_[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # two groups larger than a share stand alone; the others are near equal
    rest = sorted(bytes_.values())[:4]
    assert len(bytes_) == 6 and rest[-1] - rest[0] < 1000


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert {r["slot"] for r in shard(df, shards=40).collect()} <= {0, 1}
    assert shard(df.limit(0)).count() == 0
