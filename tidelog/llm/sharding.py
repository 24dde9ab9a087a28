"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

A partial partition is a vector of ``shards`` sums. Differencing takes the two
partial partitions with the largest spread again and again and adds them in
opposite order, large sums to small ones, until one is left. It runs in levels:
blocks of groups are differenced in one task each, the partial partitions of
the blocks are the items of the next level, and so on up to a single one, so
that no task or driver sees more than a block. Groups that are at least as
large as what a shard may hold get a shard of their own before that.

Groups are rows with equal texts. Rows of a shard are numbered in two steps,
counts of 1,024 ranges first, so that a large shard is not one task.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import free_prefix, ref, text_of
from tidelog.session import stored

SHARDS = 40
#: Groups differenced in one task, and partial partitions in one of a later level.
BLOCK = 4096
FAN_IN = 256
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
_RANGES = 1024


def difference(sums: np.ndarray) -> np.ndarray:
    """The part of the result that each part of each partial partition joins.

    ``sums`` has a row per partial partition; so has the result.
    """
    count, k = sums.shape
    order = np.argsort(-sums, axis=1, kind="stable")
    nodes = list(np.take_along_axis(sums, order, axis=1))
    heap = [(-int(v[0] - v[-1]), i) for i, v in enumerate(nodes)]
    heapq.heapify(heap)
    joined = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        both = nodes[a] + nodes[b][::-1]
        rank = np.argsort(-both, kind="stable")
        nodes[a], nodes[b] = both[rank], None
        joined.append((a, b, rank))
        heapq.heappush(heap, (-int(nodes[a][0] - nodes[a][-1]), a))
    # from the last step back: which part each rank of a partial partition is in
    part = [np.arange(k)] * count
    for a, b, rank in reversed(joined):
        of_a = np.empty(k, np.int64)
        of_a[rank] = part[a]
        part[a], part[b] = of_a, of_a[::-1]
    result = np.empty((count, k), np.int64)
    for i in range(count):
        result[i, order[i]] = part[i]
    return result


def _place_groups(k: int):
    def place(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["bytes", "group"], ascending=[False, True], kind="stable")
        sums = np.zeros((len(block), k), np.int64)
        sums[:, 0] = block["bytes"].to_numpy()
        block["part"] = difference(sums)[:, 0].astype("int32")
        return block[["group", "block", "part", "bytes"]]

    return place


def _place_blocks(k: int):
    def place(level: pd.DataFrame) -> pd.DataFrame:
        children = sorted(level["child"].unique())
        row = {c: i for i, c in enumerate(children)}
        sums = np.zeros((len(children), k), np.int64)
        sums[[row[c] for c in level["child"]], level["slot"]] = level["bytes"]
        parts = difference(sums)
        return pd.DataFrame(
            {
                "parent": np.repeat(level["parent"].iloc[0], len(children) * k),
                "child": np.repeat(children, k),
                "slot": np.tile(np.arange(k, dtype="int32"), len(children)),
                "part": parts.reshape(-1).astype("int32"),
                "bytes": sums.reshape(-1),
            }
        )

    return place


def assign(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``group, bytes`` to ``group, shard``. No groups give no rows.

    What reaches the driver is a count and the ``shards`` largest groups.
    """
    largest = groups.orderBy(F.desc("bytes"), "group").limit(shards).collect()
    count, total = groups.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    alone: list = []
    for row in largest:
        if shards - len(alone) > 1 and row["bytes"] * (shards - len(alone)) >= total:
            alone.append(row["group"])
            total -= row["bytes"]
        else:
            break
    k = shards - len(alone)
    if alone:
        own = F.array_position(F.array(*[F.lit(g) for g in alone]), F.col("group")).cast("int") - 1
    else:
        own = F.lit(-1)
    groups = groups.withColumn("own", own)
    blocks = max(1, -(-count // BLOCK))
    placed = stored(
        groups.where("own < 0")
        .withColumn("block", F.pmod(F.xxhash64("group"), F.lit(blocks)))
        .groupBy("block")
        .applyInPandas(_place_groups(k), "group binary, block long, part int, bytes long"),
        "shards",
    )
    level = placed.groupBy(F.col("block").alias("child"), F.col("part").alias("slot")).agg(
        F.sum("bytes").alias("bytes")
    )
    levels = []
    while True:
        level = level.withColumn("parent", F.floor(F.col("child") / FAN_IN).cast("long"))
        level = stored(
            level.groupBy("parent").applyInPandas(
                _place_blocks(k), "parent long, child long, slot int, part int, bytes long"
            ),
            "shards",
        )
        levels.append(level)
        blocks = -(-blocks // FAN_IN)
        if blocks == 1:
            break
        level = level.groupBy(F.col("parent").alias("child"), F.col("part").alias("slot")).agg(
            F.sum("bytes").alias("bytes")
        )
    shard_of = levels.pop().select("child", "slot", (F.col("part") + len(alone)).alias("shard"))
    for level in reversed(levels):
        above = shard_of.select(F.col("child").alias("parent"), F.col("slot").alias("part"), "shard")
        shard_of = level.join(above, ["parent", "part"]).select("child", "slot", "shard")
    shard_of = shard_of.select(F.col("child").alias("block"), F.col("slot").alias("part"), "shard")
    rest = placed.join(shard_of, ["block", "part"]).select("group", "shard")
    return rest.union(groups.where("own >= 0").select("group", F.col("own").alias("shard")))


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``size``, ``shard`` and ``slot``.

    Null texts count as empty: no bytes but those of the row, and one group
    with the empty texts. A very long text is one group as any other, and has a
    shard of its own if it fills one. Repeated rows are rows of one group. Slots
    run from 0 without gaps in each shard, by no order that means anything.
    Columns with the name of a result give way.
    """
    p = free_prefix(docs, "shard")
    kept = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    text = text_of(text_col)
    group, size, span, tie = f"{p}group", f"{p}size", f"{p}range", f"{p}tie"
    rows = docs.select(
        *[ref(c) for c in kept],
        F.unhex(F.md5(text)).alias(group),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias(size),
        # with the text, so that rows without an id are spread as well
        F.pmod(F.xxhash64(ref(id_col), text), F.lit(_RANGES)).alias(span),
    )
    groups = stored(rows.groupBy(F.col(group).alias("group")).agg(F.sum(size).alias("bytes")), "groups")
    placed = stored(assign(groups, shards), "placed")
    rows = rows.join(placed.withColumnsRenamed({"group": group, "shard": f"{p}shard"}), group)
    at = f"{p}shard"
    counts = rows.groupBy(at, span).agg(F.count(F.lit(1)).alias(f"{p}n"))
    ahead = Window.partitionBy(at).orderBy(span).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(f"{p}ahead", F.coalesce(F.sum(f"{p}n").over(ahead), F.lit(0))).drop(f"{p}n")
    inside = Window.partitionBy(at, span).orderBy(ref(id_col), group)
    rows = rows.withColumn(tie, F.row_number().over(inside) - 1).join(counts, [at, span])
    return rows.select(
        *[ref(c) for c in kept],
        F.col(size).alias("size"),
        F.col(at).cast("int").alias("shard"),
        (F.col(f"{p}ahead") + F.col(tie)).cast("long").alias("slot"),
    )
