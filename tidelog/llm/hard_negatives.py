"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors of one label (and length of vector) are dealt into blocks, and each
block is joined by its minimum spanning tree. Rows are read in chunks. For a
chunk the tree is walked from its root, whose scores are all taken. Where an
anchor's score of a row is known to lie between two numbers, the score of an
anchor at distance d lies at most d times the norm of the row outside of them.
A row is scored anew only if these bounds reach into what the anchor still
looks for: better than the worst positive so far or, of the other labels,
between the worst negative so far and the positive's score.

The first walk finds the positives, the second the negatives. Rows stay where
they are; blocks of anchors go to the executors in groups of ``GROUP_BYTES`` at
most, a pass over the rows for each group. A task passes on
its best few of each anchor only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import ref
from tidelog.llm.vectors import scaled_rows
from tidelog.session import scratch_folder, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative has at least so many hundredths of the positive's score.
LEAST_PERCENT = 80

CHUNK = 2048
BLOCK = 512
GROUP_BYTES = 32 << 20

FOUND = "anchor_id long, bound long, score array<bigint>, id array<bigint>"


@dataclass(frozen=True)
class Tree:
    """A block of anchors, parents before children; ``bounds`` are the scores
    of the positives of each, falling."""

    dim: int
    label: int
    ids: list[int]
    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    bounds: list[list[int]]


def _held(x: np.ndarray) -> np.ndarray:
    """Entries held to what keeps every score within a long."""
    most = int(np.sqrt(2.0**61 / max(x.shape[1], 1)))
    return np.clip(x, -most, most)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in the order in which Prim's method takes them, with the place of
    each one's parent in that order (-1 for the first) and its distance."""
    m = len(x)
    points = x.astype(np.float64)
    first = int(np.argmin(((points - points.mean(axis=0)) ** 2).sum(axis=1)))
    order, place = [first], {first: 0}
    nearest = np.full(m, first)
    far = np.sqrt(((points - points[first]) ** 2).sum(axis=1))
    away = far.copy()
    away[first] = np.inf
    parent, edge = [-1], [0.0]
    while len(order) < m:
        new = int(np.argmin(away))
        parent.append(place[nearest[new]])
        edge.append(far[new])
        place[new] = len(order)
        order.append(new)
        away[new] = np.inf
        distance = np.sqrt(((points - points[new]) ** 2).sum(axis=1))
        closer = (distance < far) & np.isfinite(away)
        nearest[closer], far[closer], away[closer] = new, distance[closer], distance[closer]
    return np.array(order), np.array(parent), np.array(edge)


TREE = "dim int, label long, block int, slot int, anchor_id long, x binary, parent int, edge double"


def trees(anchors: DataFrame) -> DataFrame:
    """``id, label, dim, x`` to a row per anchor with its place in a tree. Of rows
    with one id that with the least label and vector is the anchor."""
    one = anchors.groupBy("id").agg(F.min(F.struct("label", "dim", "x")).alias("a")).select("id", "a.*")
    one = stored(one, "anchors")
    counts = one.groupBy("dim", "label").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = one.join(counts, ["dim", "label"]).withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id", ignore_index=True)
        dim = int(group["dim"].iloc[0])
        order, parent, edge = spanning_tree(_held(np.frombuffer(b"".join(group["x"]), "<i8").reshape(len(group), dim)))
        out = group.iloc[order].rename(columns={"id": "anchor_id"})
        out["slot"], out["parent"], out["edge"] = range(len(out)), parent, edge
        return out[[f.split()[0] for f in TREE.split(", ")]]

    return dealt.drop("blocks").groupBy("dim", "label", "block").applyInPandas(grow, TREE)


def groups_of(grown: DataFrame) -> Iterator[list[Tree]]:
    """Whole trees, as many at a time as ``GROUP_BYTES`` hold."""
    fields = ["slot", "anchor_id", "x", "parent", "edge", "bounds"]
    packed = grown.groupBy("dim", "label", "block").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("rows"))
    held: list[Tree] = []
    size = 0
    for r in packed.toLocalIterator():
        x = _held(np.frombuffer(b"".join(a["x"] for a in r["rows"]), "<i8").reshape(len(r["rows"]), r["dim"]))
        tree = Tree(
            *(r["dim"], r["label"], [a["anchor_id"] for a in r["rows"]], x),
            *(np.array([a[f] for a in r["rows"]]) for f in ("parent", "edge")),
            [a["bounds"] for a in r["rows"]],
        )
        if held and size + x.nbytes > GROUP_BYTES:
            yield held
            held, size = [], 0
        held.append(tree)
        size += x.nbytes
    if held:
        yield held


class Best:
    """The ``count`` best rows seen: highest score first, then by id, null last."""

    def __init__(self, count: int) -> None:
        self.count = count
        self.score = np.empty(0, np.int64)
        self.key = np.empty(0, np.int64)
        self.unknown = np.empty(0, bool)

    @property
    def full(self) -> bool:
        return len(self.score) == self.count

    def worst(self) -> float:
        return float(self.score[-1]) if self.full else -np.inf

    def offer(self, score: np.ndarray, key: np.ndarray, unknown: np.ndarray) -> None:
        if self.full:
            last = self.score[-1]
            after = unknown & ~self.unknown[-1] | (unknown == self.unknown[-1]) & (key >= self.key[-1])
            better = (score > last) | (score == last) & ~after
            score, key, unknown = score[better], key[better], unknown[better]
        if not len(score):
            return
        score = np.concatenate((self.score, score))
        key = np.concatenate((self.key, key))
        unknown = np.concatenate((self.unknown, unknown))
        first = np.lexsort((key, unknown, -score))[: self.count]
        self.score, self.key, self.unknown = score[first], key[first], unknown[first]

    def ids(self) -> list[int | None]:
        return [None if u else int(k) for k, u in zip(self.key, self.unknown, strict=True)]


@dataclass
class Rows:
    """The rows of a chunk that a tree looks at."""

    x: np.ndarray
    norm: np.ndarray
    key: np.ndarray
    unknown: np.ndarray

    def taken(self, mask: np.ndarray) -> Rows:
        return Rows(self.x[mask], self.norm[mask], self.key[mask], self.unknown[mask])


Reach = Callable[[int, np.ndarray, np.ndarray], np.ndarray]
Take = Callable[[int, np.ndarray, np.ndarray], None]


def walk(tree: Tree, rows: Rows, reaches: Reach, take: Take) -> int:
    """Walk down the tree; ``reaches(a, low, high)`` says which rows anchor
    ``a`` has to score, ``take(a, at, scores)`` gets them. Returns how many
    scores of anchors below the root were taken."""
    if not len(rows.x):
        return 0
    exact = float(np.abs(rows.x).max(initial=0)) * float(np.abs(tree.x).max(initial=0)) * max(tree.dim, 1) < 2.0**53
    points, against = (rows.x.astype(np.float64), tree.x.astype(np.float64)) if exact else (rows.x, tree.x)
    bounds: list[tuple[np.ndarray, np.ndarray]] = []
    scored = 0
    for a, p in enumerate(tree.parent):
        if p < 0:
            at = np.arange(len(points))
            low, high = np.zeros(len(at)), np.zeros(len(at))
        else:
            low, high = bounds[p]
            # a little more than the distance, for what doubles round away
            slack = tree.edge[a] * rows.norm * (1 + 1e-9) + 1e-12 * np.maximum(np.abs(low), np.abs(high)) + 1e-6
            low, high = low - slack, high + slack
            at = np.flatnonzero(reaches(a, low, high))
            scored += len(at)
        if len(at):
            some = points if len(at) == len(points) else points[at]
            scores = (some @ against[a]).astype(np.int64)
            low[at] = high[at] = scores
            take(a, at, scores)
        bounds.append((low, high))
    return scored


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, Rows]]:
    """``dim``, labels and rows of at most ``CHUNK`` rows of one length, by id."""
    for batch in batches:
        ids = batch.column("id")
        unknown = ids.is_null().to_numpy(zero_copy_only=False)
        key = ids.fill_null(0).to_numpy()
        labels, dims, raws = batch.column("label").to_numpy(), batch.column("dim").to_numpy(), batch.column("x")
        order = np.lexsort((key, dims))
        ends = np.append(np.flatnonzero(np.diff(dims[order])) + 1, len(order))
        for start, end in zip(np.append(0, ends[:-1]), ends, strict=True):
            for first in range(start, end, CHUNK):
                at = order[first : min(first + CHUNK, end)]
                dim = int(dims[at[0]])
                x = _held(np.frombuffer(b"".join(raws.take(at).to_pylist()), "<i8").reshape(len(at), dim))
                norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
                yield dim, labels[at], Rows(x, norm, key[at], unknown[at])


def _told(found: Iterator[tuple[int, int, Best]]) -> pa.RecordBatch:
    out = [
        {"anchor_id": a, "bound": bound, "score": best.score.tolist(), "id": best.ids()}
        for a, bound, best in found
        if len(best.score)
    ]
    longs = pa.list_(pa.int64())
    return pa.RecordBatch.from_pylist(
        out, pa.schema([("anchor_id", pa.int64()), ("bound", pa.int64()), ("score", longs), ("id", longs)])
    )


def positives_in(group: list[Tree], count: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[Best(count) for _ in tree.ids] for tree in group]
        for dim, labels, rows in _chunks(batches):
            for tree, mine in zip(group, best, strict=True):
                if tree.dim != dim:
                    continue
                same = rows.taken(labels == tree.label)

                def take(a: int, at: np.ndarray, scores: np.ndarray, tree=tree, mine=mine, same=same) -> None:
                    other = same.unknown[at] | (same.key[at] != tree.ids[a])
                    mine[a].offer(scores[other], same.key[at][other], same.unknown[at][other])

                walk(tree, same, lambda a, low, high, mine=mine: high >= mine[a].worst(), take)
        yield _told((i, 0, b) for tree, mine in zip(group, best, strict=True) for i, b in zip(tree.ids, mine, strict=True))

    return run


def negatives_in(group: list[Tree], count: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[[Best(count) for _ in bounds] for bounds in tree.bounds] for tree in group]
        for dim, labels, rows in _chunks(batches):
            for tree, mine in zip(group, best, strict=True):
                if tree.dim != dim:
                    continue
                other = rows.taken(labels != tree.label)

                def reaches(a: int, low: np.ndarray, high: np.ndarray, tree=tree, mine=mine) -> np.ndarray:
                    some = np.zeros(len(low), bool)
                    for bound, b in zip(tree.bounds[a], mine[a], strict=True):
                        some |= (high >= max(b.worst(), -(-percent * bound // 100))) & (low <= bound)
                    return some

                def take(a: int, at: np.ndarray, scores: np.ndarray, tree=tree, mine=mine, other=other) -> None:
                    for bound, b in zip(tree.bounds[a], mine[a], strict=True):
                        fits = (scores >= -(-percent * bound // 100)) & (scores <= bound)
                        b.offer(scores[fits], other.key[at][fits], other.unknown[at][fits])

                walk(tree, other, reaches, take)
        yield _told(
            (i, bound, b)
            for tree, mine in zip(group, best, strict=True)
            for i, bounds, bs in zip(tree.ids, tree.bounds, mine, strict=True)
            for bound, b in zip(bounds, bs, strict=True)
        )

    return run


def _passes(rows: DataFrame, grown: DataFrame, run: Callable, count: int) -> DataFrame:
    """``anchor_id, bound, id, score, rank``: the ``count`` best of all tasks, a
    pass over the rows for each group of trees."""
    spark = rows.sparkSession
    path = scratch_folder(spark, "best")
    spark.createDataFrame([], FOUND).write.parquet(path)
    for group in groups_of(grown):
        shared = spark.sparkContext.broadcast(group)

        def task(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from run(shared.value)(batches)

        rows.mapInArrow(task, FOUND).write.mode("append").parquet(path)
        shared.unpersist()
    each = spark.read.schema(FOUND).parquet(path).select(
        "anchor_id", "bound", F.explode(F.arrays_zip("score", "id")).alias("c")
    )
    order = Window.partitionBy("anchor_id", "bound").orderBy(F.desc("c.score"), F.col("c.id").asc_nulls_last())
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("anchor_id", "bound", F.col("c.id").alias("id"), F.col("c.score").alias("score"), "rank")


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least_percent: int = LEAST_PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the rows where ``is_anchor`` holds.

    Null labels, null vectors and vectors with a null or non-finite entry (or
    one of 2^53 or more after scaling) take no part. Vectors of different
    lengths never score with each other. Entries beyond ``sqrt(2^61 / length)``
    count as that, so that scores are longs. An anchor's other rows are those
    with another id; a null id is another id, is no anchor and comes last
    among equal scores. Repeated rows count each; of rows with one id that are
    anchors the one with the least label and vector speaks. An anchor without
    positives, or a positive without negatives, gives no row; a negative
    positive score has none. An empty table gives no rows. Other columns are
    not read.
    """
    picked = df.select(
        ref(id_col).cast("long").alias("id"),
        ref(label_col).cast("long").alias("label"),
        F.when(F.coalesce(is_anchor, F.lit(False)), 1).otherwise(0).cast("long").alias("anchor"),
        ref(vec_col).alias("v"),
    )
    rows = stored(scaled_rows(picked.where("label IS NOT NULL"), scale), "vectors")
    anchors = rows.where("anchor = 1 AND id IS NOT NULL").select("id", "label", "dim", "x")
    grown = stored(trees(anchors), "trees")
    alone = grown.withColumn("bounds", F.array().cast("array<bigint>"))
    found = _passes(rows, alone, lambda group: positives_in(group, positives), positives)
    found = stored(found.select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("bound")), "positives")
    bounds = found.groupBy("anchor_id").agg(F.sort_array(F.collect_set("bound"), asc=False).alias("bounds"))
    # a tree needs all its anchors, those without positives as well
    aimed = grown.join(bounds, "anchor_id", "left").withColumn("bounds", F.coalesce("bounds", F.array()))
    best = _passes(rows, aimed, lambda group: negatives_in(group, negatives, least_percent), negatives)
    return found.join(best, ["anchor_id", "bound"]).select(
        *("anchor_id", "positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        F.col("bound").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
