"""Packed matrices of token ids by best-fit decreasing.

Documents longer than a row are split into whole rows and a rest; rests are
packed in shards of bounded size, longest first, each into the open row with
the least room that still holds it. A segment tree over the possible amounts
of room finds that row. A matrix row holds the ids, the cumulative lengths of
its segments and positions that start again at each segment; nothing is lost
or cut but by the split, and padding is what no rest fits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.packing import END_ID, WINDOW, default_tokenizer, tokenized
from tidelog.llm.tokens import id_type, load
from tidelog.session import stored

PAD_ID = 0
SHARD_TOKENS = 4 << 20

ROWS = (
    "sequence_id long, doc_ids array<long>, starts array<long>, lengths_before array<int>, used int,"
    " ids binary, positions binary"
)


class RoomTree:
    """Counts of open rows by room, with the least room that is large enough."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, by: int) -> None:
        at = self.leaves + room
        while at:
            self.count[at] += by
            at >>= 1

    def least(self, need: int) -> int | None:
        """The least room >= ``need`` of an open row, if there is one."""
        at = self.leaves + need
        if self.count[at]:
            return need
        while at > 1:
            # to the right of a left child lies larger room
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def best_fit(lengths: np.ndarray, window: int) -> list[list[int]]:
    """Rows of indices; of equal lengths the earlier comes first, of rows with
    equal room the one that got it last is filled."""
    tree, rows = RoomTree(window), []
    open_by_room: dict[int, list[int]] = {}
    for k in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[k])
        room = tree.least(need)
        if room is None:
            row, room = len(rows), window
            rows.append([])
        else:
            row = open_by_room[room].pop()
            tree.add(room, -1)
        rows[row].append(k)
        if room > need:
            open_by_room.setdefault(room - need, []).append(row)
            tree.add(room - need, 1)
    return rows


def _row(sequence: int, pieces: list[tuple], window: int, pad_id: int) -> tuple:
    """``pieces``: (doc_id, start, ids)."""
    lengths = [len(p[2]) for p in pieces]
    ids = np.full(window, pad_id, "<u4")
    positions = np.zeros(window, "<u4")
    before = np.concatenate(([0], np.cumsum(lengths))).astype(int).tolist()
    for (_, _, piece), at in zip(pieces, before, strict=False):
        ids[at : at + len(piece)] = piece
        positions[at : at + len(piece)] = np.arange(len(piece))
    doc_ids = [None if p[0] is None or p[0] is pd.NA else int(p[0]) for p in pieces]
    return sequence, doc_ids, [p[1] for p in pieces], before, before[-1], ids.tobytes(), positions.tobytes()


def pack_matrix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    pad_id: int = PAD_ID,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """A matrix row per sequence, ids and positions as little-endian unsigned
    32-bit; ``lengths_before`` are the cumulative segment lengths from 0.

    A null or empty text is its end id alone. Repeated rows are packed each for
    itself, null ids stay null, an empty table gives no rows. Other columns
    are not read.
    """
    tokenizer = tokenizer or default_tokenizer()
    dtype = id_type(max(load(tokenizer).vocabulary, end_id + 1))
    width = np.dtype(dtype).itemsize
    names = [f.split()[0] for f in ROWS.split(", ")]
    found = stored(tokenized(docs, id_col, text_col, tokenizer, end_id, window), "tokens", compression="zstd")
    tokens = found.where("n IS NOT NULL").select("row_id", "doc_id", "ids", "n", "whole")
    rest = F.col("n") % window
    total = tokens.agg(F.sum(rest)).first()[0] or 0
    shards = max(1, -(-int(total) // shard_tokens))

    def whole_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for x in batch.itertuples(index=False):
                ids = np.frombuffer(x.ids, dtype)
                for k in range(len(ids) // window):
                    piece = (None if pd.isna(x.doc_id) else int(x.doc_id), k * window, ids[k * window : (k + 1) * window])
                    rows.append(_row(2 * (x.whole + k) + 1, [piece], window, pad_id))
                if len(rows) >= 500:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_id").reset_index(drop=True)
        pieces = [np.frombuffer(raw, dtype) for raw in group["ids"]]
        base = int(group["shard"].iloc[0]) << 32
        doc_id = [None if pd.isna(d) else int(d) for d in group["doc_id"]]
        n = group["n"].tolist()
        rows = best_fit(np.array([len(p) for p in pieces]), window)
        return pd.DataFrame(
            [
                _row(2 * (base + r), [(doc_id[k], n[k] - len(pieces[k]), pieces[k]) for k in row], window, pad_id)
                for r, row in enumerate(rows)
            ],
            columns=names,
        )

    full = tokens.where(F.col("n") >= window).mapInPandas(whole_rows, ROWS)
    rests = tokens.where(rest > 0).select(
        F.pmod(F.xxhash64("row_id"), F.lit(shards)).alias("shard"),
        *("row_id", "doc_id", "n"),
        F.expr(f"substring(ids, int({width} * (n - n % {window})) + 1)").alias("ids"),
    )
    return full.union(rests.groupBy("shard").applyInPandas(fit, ROWS))


def write_matrix(rows: DataFrame, path: str) -> None:
    """The matrix as Parquet with zstd, a row per sequence."""
    rows.write.parquet(path, compression="zstd")


def read_matrix(spark, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(path)
