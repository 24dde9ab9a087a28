"""Packing of documents into sequences by lexical retrieval.

Whole windows of long documents become sequences as they are. What is left of
each document is packed in shards: a shard has an inverted index with BM25
weights of its pieces, and each window takes a seed, asks the index for the
seed's best unused neighbours and fills itself with them, whole ones first,
the best of the rest cut at the end of the window. All unused pieces with a
positive score are neighbours, and only when none is left does the window
take the next unused piece. What is cut off seeds the next window. So all
windows but the last of a shard are full.

Document frequencies count every document; they are one number per token id,
bounded by the vocabulary. Documents go to shards by the term that stands for
them, so that neighbours meet, and a term with many documents is spread over
as many shards as its tokens need: a shard stays near ``SHARD_TOKENS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ref
from tidelog.llm.tokens import id_type, load
from tidelog.session import bounded_batches, stored

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 512 * 1024
#: Neighbours ranked at first; each time they do not fill a window, four times as many.
NEIGHBOURS = 64
K1, B = 1.2, 0.75

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


TOKENS = (
    "row_id long, doc_id long, ids binary, n long, whole long, head int, term int, docs long"  # by row, or by term
)


def tokenized(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Rows of documents: ids that end with ``end_id``, their number ``n``, in
    ``whole`` the full windows of earlier documents of the partition, and in
    ``head`` the term that stands for the document: count times the logarithm
    of the id is largest, as ids of such vocabularies grow with rarity. And
    rows of terms: the documents of the partition that hold ``term``."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = load(tokenizer)
        size = max(words.vocabulary, end_id + 1)
        end = np.array([end_id], words.dtype).tobytes()
        partition = TaskContext.get().partitionId()
        rarity = np.log(np.arange(size) + 2.0)
        holders = np.zeros(size, np.int64)
        seen = whole = 0
        for batch in batches:
            texts = batch["text"].tolist()
            for first in range(0, len(texts), 1000):
                ids = [b + end for b in words.encode(texts[first : first + 1000])]
                n = np.array([len(raw) for raw in ids], np.int64) // np.dtype(words.dtype).itemsize
                document, term, tf = frequencies(np.frombuffer(b"".join(ids), words.dtype), n)
                holders += np.bincount(term, minlength=size)
                head = term[_first_best(document, tf * rarity[term])]
                full = n // window
                rows = {
                    "row_id": (partition << 33) + seen + np.arange(len(ids)),
                    "doc_id": batch["doc_id"].iloc[first : first + 1000].array,
                    "ids": ids,
                    "n": n,
                    "whole": (partition << 32) + whole + np.cumsum(full) - full,
                    "head": head,
                }
                yield _with_nulls(rows, len(ids))
                seen, whole = seen + len(ids), whole + int(full.sum())
        found = np.flatnonzero(holders)
        yield _with_nulls({"term": found, "docs": holders[found]}, len(found))

    rows = docs.select(ref(id_col).cast("long").alias("doc_id"), ref(text_col).cast("string").alias("text"))
    return rows.mapInPandas(encode, TOKENS)


def _with_nulls(columns: dict, count: int) -> pd.DataFrame:
    frame = pd.DataFrame(index=range(count))
    for field in TOKENS.split(", "):
        name, kind = field.split()
        if name in columns:
            values = columns[name]
            frame[name] = pd.array(values, dtype="Int64") if name == "doc_id" else values
        else:
            frame[name] = pd.Series([None] * count, dtype=object if kind == "binary" else "Int64")
    return frame


def by_number(rows: DataFrame, size: int) -> np.ndarray:
    """``number, value`` rows as an array; at most ``size`` of them."""
    result = np.zeros(size, np.int64)
    for number, value in rows.collect():
        result[number] = value
    return result


def inverse_frequency(docs: np.ndarray, count: int) -> np.ndarray:
    """BM25's weight of a term; terms in half of the documents weigh nothing."""
    return np.maximum(np.log((count - docs + 0.5) / (docs + 0.5)), 0.0)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def frequencies(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term and how often, in this order, of documents one after
    another in ``ids``: one sort for all of them."""
    # half the width where it is enough
    kind, shift = (np.uint32, 16) if ids.itemsize == 2 and len(lengths) <= 1 << 16 else (np.uint64, 32)
    document = np.repeat(np.arange(len(lengths), dtype=kind), lengths)
    key = np.sort((document << kind(shift)) | ids.astype(kind))
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    tf = np.diff(np.append(starts, len(key)))
    key = key[starts].astype(np.int64)
    return key >> shift, key & ((1 << shift) - 1), tf


def _first_best(document: np.ndarray, score: np.ndarray) -> np.ndarray:
    """The place of the largest score of each document, the first of equal ones."""
    starts = np.flatnonzero(np.append(True, document[1:] != document[:-1])[: len(document)])
    best = np.repeat(np.maximum.reduceat(score, starts), np.diff(np.append(starts, len(score))))
    at = np.flatnonzero(score == best)
    return at[np.append(True, document[at][1:] != document[at][:-1])]


class Bm25Index:
    """Postings of a shard by term, with the weight of each document."""

    def __init__(self, pieces: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(x) for x in pieces], np.int64)
        document, term, tf = frequencies(np.concatenate(pieces), lengths)
        useful = idf[term] > 0
        document, term, tf = document[useful], term[useful], tf[useful]
        self.terms = np.split(term, np.searchsorted(document, np.arange(1, len(pieces))))
        scale = K1 * (1 - B + B * lengths / mean)
        order = np.argsort(term, kind="stable")
        self.docs = document[order].astype(np.int32)
        self.weights = (idf[term] * tf * (K1 + 1) / (tf + scale[document]))[order]
        self.starts = np.searchsorted(term[order], np.arange(len(idf) + 1))
        self.size = len(pieces)

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the terms of ``seed``."""
        term = self.terms[seed]
        lists = list(zip(self.starts[term].tolist(), self.starts[term + 1].tolist(), strict=True))
        if not lists:
            return np.zeros(self.size)
        docs = np.concatenate([self.docs[a:b] for a, b in lists])
        weights = np.concatenate([self.weights[a:b] for a, b in lists])
        return np.bincount(docs, weights, self.size)


def fill_windows(
    lengths: np.ndarray, scores, window: int = WINDOW, neighbours: int = NEIGHBOURS
) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length); ``scores(seed)`` ranks.

    Every document is placed exactly once, in one or more pieces; only the
    last window is not full. Ties go to the earlier document.
    """
    unused = np.ones(len(lengths), bool)
    left: tuple[int, int] | None = None
    following = 0
    while True:
        while following < len(lengths) and not unused[following]:
            following += 1
        if left is None and following == len(lengths):
            return
        seed, at = left if left is not None else (following, 0)
        unused[seed], left = False, None
        taken = min(int(lengths[seed]) - at, window)
        pieces, room = [(seed, at, taken)], window - taken
        if at + taken < lengths[seed]:
            left = (seed, at + taken)
        if room:
            score = scores(seed)
            near = np.flatnonzero(unused & (score > 0))
            fits, count = near[lengths[near] <= room], neighbours
            while room and len(fits):
                for k in _best(score, fits, count).tolist():
                    if lengths[k] <= room:
                        pieces.append((k, 0, int(lengths[k])))
                        unused[k] = False
                        room -= int(lengths[k])
                    if not room:
                        break
                fits, count = fits[unused[fits] & (lengths[fits] <= room)], 4 * count
            rest = near[unused[near]]
        while room:
            while following < len(lengths) and not unused[following]:
                following += 1
            if not len(rest) and following == len(lengths):
                break
            # the best one that is too long fills the window
            k = int(rest[np.argmax(score[rest])]) if len(rest) else following
            unused[k] = False
            taken = min(int(lengths[k]), room)
            pieces.append((k, 0, taken))
            room -= taken
            if taken < lengths[k]:
                left = (k, taken)
        yield pieces


def _best(scores: np.ndarray, open_: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` best of ``open_`` by falling score, equal ones in order."""
    if len(open_) > count:
        least = np.partition(scores[open_], len(open_) - count)[len(open_) - count]
        open_ = open_[scores[open_] >= least]
    return open_[np.lexsort((open_, -scores[open_]))][:count]


def _spread(row_id: np.ndarray) -> np.ndarray:
    """An even number in [0, 1) from each row number."""
    x = row_id.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id,
    offset``; ``ids`` are little-endian unsigned 32-bit.

    A null or empty text is its end id alone. Null ids stay null. Repeated
    rows are packed each for itself. An empty table gives no rows. Other
    columns are not read. Sequence ids are unique, not dense; a sequence that
    is not full is to be padded.
    """
    tokenizer = tokenizer or default_tokenizer()
    vocabulary = max(load(tokenizer).vocabulary, end_id + 1)
    dtype = id_type(vocabulary)
    width = np.dtype(dtype).itemsize
    with bounded_batches(docs.sparkSession):
        found = stored(tokenized(docs, id_col, text_col, tokenizer, end_id, window), "tokens", compression="zstd")
    tokens = found.where("n IS NOT NULL").drop("term", "docs")
    count, total = tokens.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not count:
        return docs.sparkSession.createDataFrame([], PIECES)
    holders = found.where("term IS NOT NULL").groupBy("term").agg(F.sum("docs"))
    idf = inverse_frequency(by_number(holders, vocabulary), count)
    mean = total / count
    rest = F.col("n") % window
    # tokens left over by head: a row per term at most, which fixes the shards
    by_head = by_number(tokens.groupBy("head").agg(F.sum(rest)), vocabulary)
    ahead = np.concatenate(([0], np.cumsum(by_head)))

    def whole_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for x in batch.itertuples(index=False):
                ids = np.frombuffer(x.ids, dtype)
                for k in range(len(ids) // window):
                    piece = ids[k * window : (k + 1) * window].astype("<u4").tobytes()
                    rows.append((x.doc_id, k * window, window, piece, x.n, 2 * (x.whole + k) + 1, 0))
            yield _pieces(rows)

    def routed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for head, row_id in batches:
            place = ahead[head] + _spread(row_id.to_numpy()) * by_head[head]
            yield pd.Series((place // shard_tokens).astype(np.int64))

    routed.__annotations__ = {
        "batches": Iterator[tuple[pd.Series, pd.Series]],
        "return": Iterator[pd.Series],
    }

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_id").reset_index(drop=True)
        pieces = [np.frombuffer(raw, dtype) for raw in group["ids"]]
        lengths = np.array([len(x) for x in pieces], np.int64)
        base, number = int(group["shard"].iloc[0]) << 32, 0
        doc_id, n = group["doc_id"].tolist(), group["n"].tolist()
        index = Bm25Index(pieces, idf, mean)
        rows = []
        for pieces_in in fill_windows(lengths, index.scores, window):
            offset = 0
            for k, at, length in pieces_in:
                raw = pieces[k][at : at + length].astype("<u4").tobytes()
                start = n[k] - int(lengths[k]) + at
                rows.append((doc_id[k], start, length, raw, n[k], 2 * (base + number), offset))
                offset += length
            number += 1
        return _pieces(rows)

    full = tokens.where(F.col("n") >= window).mapInPandas(whole_windows, PIECES)
    rests = tokens.where(rest > 0).select(
        F.pandas_udf(routed, "long")("head", "row_id").alias("shard"),
        *("row_id", "doc_id", "n"),
        F.expr(f"substring(ids, int({width} * (n - n % {window})) + 1)").alias("ids"),
    )
    packed = rests.groupBy("shard").applyInPandas(fill, PIECES)
    return full.union(packed)


def _pieces(rows: list[tuple]) -> pd.DataFrame:
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    frame = pd.DataFrame(rows, columns=names)
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame
