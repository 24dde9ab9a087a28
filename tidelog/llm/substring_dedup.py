"""Removal of passages that an earlier document has, on a De Bruijn graph.

Every window of ``k`` words is an edge of the graph of words. Only edges that
two documents have matter, and few do. To find them, chunks of documents send
the hashes of their edges, sorted and as differences, to buckets of hash
values; a bucket numbers the edges that come from two documents and answers
with their places. Consecutive ones are a run of a document. Equal runs are
one from there on.

An edge is joined to the next one if wherever either occurs the other does,
that is, if there is no branch, beginning or end between them. Branches are
found by a group by edge and joined back to the runs, which they cut into
nonbranching paths. A path is all of it in a document or none of it, so the
least document of its first edge is that of all its edges, and one row stands
for a path however long.

Hashes find paths; words decide. The digest of a path's words is taken at every
place it occurs. Where places differ (hashes that met by chance) the path is
taken apart and its windows are compared one by one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import ref
from tidelog.llm.shingles import _STEP, _mixed, word_hashes
from tidelog.session import stored

WINDOW = 13
#: Text that makes a chunk, and text for which there is a bucket.
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
#: Edges of the runs that ask for branches together.
GROUP_BYTES = 4 << 20
#: Bits of a hash that are compared inside a bucket.
REST = 40
_SEVERAL = np.uint32(1 << 31)
_NONE = -1


def planes(a: np.ndarray) -> bytes:
    """Numbers as all their lowest bytes, then all the next, and so on: high
    bytes that are zero lie together and compress to nothing."""
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def from_planes(raw: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def window_hashes(words: np.ndarray, lengths: np.ndarray, k: int, hash_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the windows of some documents, one after another in
    ``words``; no window reaches into the next document."""
    count = len(words) - k + 1
    if count <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    value = np.zeros(count, np.uint64)
    for j in range(k):
        value = value * _STEP + words[j : j + count]
    ends = np.repeat(np.cumsum(lengths), lengths)[:count]
    place = np.flatnonzero(np.arange(count) + k <= ends)
    left = np.uint64(64 - hash_bits)
    return (_mixed(value[place]) >> left) << left, place


SENT = "bucket int, chunk long, head boolean, hash binary, pos binary"
_SENT = pa.schema(
    [("bucket", pa.int32()), ("chunk", pa.int64()), ("head", pa.bool_()), ("hash", pa.binary()), ("pos", pa.binary())]
)


def sent_edges(docs: DataFrame, k: int, bits: int, hash_bits: int) -> DataFrame:
    """``id, key, text`` to what chunks send to the ``2 ** bits`` buckets: each
    edge once with its first place, marked if two documents of the chunk have
    it. A row with ``head`` carries documents and repeats to the chunk itself."""

    def sent(chunk: int, held: list[tuple]) -> pa.RecordBatch:
        found = list(word_hashes([raw for _, _, raw in held], lower=False))
        lengths = np.array([len(w) for w in found], np.int64)
        value, place = window_hashes(np.concatenate(found), lengths, k, hash_bits)
        order = np.argsort(value, kind="stable")
        value, place = value[order], place[order]
        new = np.append(True, value[1:] != value[:-1])[: len(value)]
        starts = np.flatnonzero(new)
        document = np.repeat(np.arange(len(held)), lengths)
        ends = np.append(starts[1:], len(value))[: len(starts)] - 1
        several = document[place[starts]] != document[place[ends]]
        again = np.flatnonzero(~new)
        repeats = np.stack((place[again], place[starts[np.cumsum(new) - 1][again]])).astype("<u4")
        head = np.array(
            [[0 if i is None else i for i, _, _ in held], [i is not None for i, _, _ in held], [y for _, y, _ in held], lengths],
            "<i8",
        )
        one = value[starts]
        bucket = (one >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(one), np.int64)
        rest = (one << np.uint64(bits)) >> np.uint64(64 - REST)
        first = place[starts].astype("<u4") | np.where(several, _SEVERAL, np.uint32(0))
        cuts = np.searchsorted(bucket, np.arange((1 << bits) + 1))
        used = np.flatnonzero(np.diff(cuts))
        # chunks of one number in different partitions go apart
        to = ((chunk >> 32) + (chunk & 0xFFFFFFFF)) % (1 << bits)
        rows = [(to, chunk, True, head.tobytes(), repeats.tobytes())]
        for b in used:
            part = slice(cuts[b], cuts[b + 1])
            steps = np.diff(rest[part], prepend=np.uint64(0))
            rows.append((int(b), chunk, False, planes(steps), planes(first[part])))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SENT, strict=True)], schema=_SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        size = 0
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i, key, raw in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), texts, strict=True):
                raw = raw.as_py() or b""
                if held and size + len(raw) > CHUNK_BYTES:
                    yield sent(chunk, held)
                    chunk, held, size = chunk + 1, [], 0
                held.append((i, key, raw))
                size += len(raw)
        if held:
            yield sent(chunk, held)

    return docs.select("id", "key", "text").mapInArrow(run, SENT)


def repeated_edges(sent: DataFrame) -> DataFrame:
    """Of what a bucket got, the edges that come from two documents, numbered,
    back to their chunks."""

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        heads, rows = group[group["head"]], group[~group["head"]]
        if not len(rows):
            return heads
        rest = [np.cumsum(from_planes(raw, np.uint64)) for raw in rows["hash"]]
        sizes = [len(x) for x in rest]
        rest = np.concatenate(rest)
        first = np.concatenate([from_planes(raw, np.uint32) for raw in rows["pos"]])
        of = np.repeat(np.arange(len(rows)), sizes)
        order = np.argsort(rest, kind="stable")
        new = np.append(True, rest[order][1:] != rest[order][:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(rest)) - 1
        hit = of[order[starts]] != of[order[ends]]
        hit |= np.logical_or.reduceat((first[order] & _SEVERAL) != 0, starts)
        number = np.cumsum(hit) - 1
        edge = np.full(len(rest), _NONE, np.int64)
        edge[order] = np.where(hit, number, _NONE)[np.cumsum(new) - 1]
        out = []
        begin = 0
        bucket = int(rows["bucket"].iloc[0])
        for chunk, size in zip(rows["chunk"], sizes, strict=True):
            mine = slice(begin, begin + size)
            begin += size
            known = edge[mine] != _NONE
            if known.any():
                places = first[mine][known] & ~_SEVERAL
                out.append((bucket, chunk, False, planes(edge[mine][known].astype(np.uint32)), planes(places)))
        return pd.concat([heads, pd.DataFrame(out, columns=heads.columns)]) if out else heads

    return sent.groupBy("bucket").applyInPandas(answer, SENT)


RUNS = "id long, key long, start long, n int, run binary, edges binary"


def runs_of(answered: DataFrame) -> DataFrame:
    """Runs of consecutive repeated edges in each document. The edges of a run
    that a chunk has twice are told once."""

    def assemble(group: pd.DataFrame) -> pd.DataFrame:
        head = group[group["head"]].iloc[0]
        ids, known, keys, lengths = np.frombuffer(head["hash"], "<i8").reshape(4, -1)
        edge_at = np.full(int(lengths.sum()), _NONE, np.int64)
        for bucket, raw, pos in group.loc[~group["head"], ["bucket", "hash", "pos"]].itertuples(index=False):
            edge_at[from_planes(pos, np.uint32)] = (np.int64(bucket) << 32) | from_planes(raw, np.uint32).astype(np.int64)
        again, first = np.frombuffer(head["pos"], "<u4").reshape(2, -1)
        edge_at[again] = edge_at[first]
        at = np.flatnonzero(edge_at != _NONE)
        begins = np.cumsum(lengths) - lengths
        document = np.repeat(np.arange(len(lengths)), lengths)[at]
        if not len(at):
            return pd.DataFrame({f.split()[0]: [] for f in RUNS.split(", ")})
        new = np.append(True, (np.diff(at) != 1) | (np.diff(document) != 0))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(at))
        seen: set[bytes] = set()
        run, edges = [], []
        for s, e in zip(starts, ends, strict=True):
            raw = edge_at[at[s:e]].tobytes()
            run.append(xxhash.xxh3_128_digest(raw))
            edges.append(None if run[-1] in seen else raw)
            seen.add(run[-1])
        d = document[starts]
        return pd.DataFrame(
            {
                "id": pd.arrays.IntegerArray(ids[d].copy(), known[d] == 0),
                "key": keys[d],
                "start": at[starts] - begins[d],
                "n": (ends - starts).astype(np.int32),
                "run": run,
                "edges": edges,
            }
        )

    return answered.groupBy("chunk").applyInPandas(assemble, RUNS)


def _place(id_: str = "id", key: str = "key", start: str | Column = "start") -> Column:
    """Order of places: by id, null last, then any fixed order."""
    start = F.col(start) if isinstance(start, str) else start
    return F.struct(F.col(id_).isNull().alias("o"), F.col(id_).alias("id"), F.col(key).alias("key"), start.alias("start"))


def branches(runs: DataFrame) -> DataFrame:
    """``edge, before, after``: whether a path ends before or after an edge,
    because not every place has the same edge (or any) there."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [np.frombuffer(raw, np.int64) for raw in batch["edges"]]
            if not parts:
                continue
            edge = np.concatenate(parts)
            sizes = np.array([len(p) for p in parts])
            ends = np.cumsum(sizes)
            before, after = np.roll(edge, 1), np.roll(edge, -1)
            before[ends - sizes] = _NONE
            after[ends - 1] = _NONE
            order = np.argsort(edge, kind="stable")
            starts = np.flatnonzero(np.append(True, edge[order][1:] != edge[order][:-1]))
            sides = {"edge": edge[order][starts]}
            for name, side in (("b", before[order]), ("a", after[order])):
                sides[f"{name}0"] = np.minimum.reduceat(side, starts)
                sides[f"{name}1"] = np.maximum.reduceat(side, starts)
            yield pd.DataFrame(sides)

    rows = runs.select("edges").mapInPandas(run, "edge long, b0 long, b1 long, a0 long, a1 long")
    each = rows.groupBy("edge").agg(
        *[F.min(c).alias(c) for c in ("b0", "a0")], *[F.max(c).alias(c) for c in ("b1", "a1")]
    )
    return each.select("edge", (F.col("b0") != F.col("b1")).alias("before"), (F.col("a0") != F.col("a1")).alias("after")).where(
        "before OR after"
    )


def in_groups(once: DataFrame) -> DataFrame:
    """Runs with a number of their own and that of a group of runs, together
    ``GROUP_BYTES`` of edges or one run."""
    schema = T.StructType([*once.schema.fields, T.StructField("no", T.LongType()), T.StructField("group", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        no, size = first, 0
        group = first
        for batch in batches:
            groups = []
            for raw in batch.column("edges"):
                size += len(raw.as_buffer())
                if size > GROUP_BYTES:
                    group, size = group + 1, len(raw.as_buffer())
                groups.append(group)
            numbers = pa.array(range(no, no + len(groups)), pa.int64())
            no += len(groups)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, numbers, pa.array(groups, pa.int64())], names=[*batch.schema.names, "no", "group"]
            )

    return once.mapInArrow(run, schema)


def paths_of(runs: DataFrame) -> DataFrame:
    """``no, group, n, edges, least`` (runs, each once) to ``no, at, n, path,
    unnamed, least``: the nonbranching paths they are made of, with the least
    id of each and whether that is null. A path is named by its first edge.

    A group asks once for an edge or a path, however many of its runs have it.
    """

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            parts = [np.frombuffer(raw, np.int64) for raw in batch["edges"]]
            edge, group = np.concatenate(parts), np.repeat(batch["group"].to_numpy(), [len(p) for p in parts])
            order = np.lexsort((edge, group))
            edge, group = edge[order], group[order]
            new = np.append(True, (edge[1:] != edge[:-1]) | (group[1:] != group[:-1]))
            yield pd.DataFrame({"edge": edge[new], "group": group[new]})

    asked = runs.select("group", "edges").mapInPandas(ask, "edge long, group long")
    cut = asked.join(branches(runs), "edge")

    def split(mine: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(mine):
            return pd.DataFrame({"no": [], "group": [], "at": [], "n": [], "path": []})
        edges = np.concatenate([np.frombuffer(raw, np.int64) for raw in mine["edges"]])
        sizes = mine["n"].to_numpy().astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        known = told["edge"].to_numpy()
        head = np.isin(edges, known[told["before"].to_numpy(bool)])
        head[1:] |= np.isin(edges, known[told["after"].to_numpy(bool)])[:-1]
        head[begins] = True
        at = np.flatnonzero(head)
        run = np.searchsorted(begins, at, side="right") - 1
        return pd.DataFrame(
            {
                "no": mine["no"].to_numpy()[run],
                "group": mine["group"].iloc[0],
                "at": at - begins[run],
                "n": np.diff(np.append(at, len(edges))),
                "path": edges[at],
            }
        )

    whole = runs.select("no", "group", "n", "edges").groupBy("group")
    made = "no long, group long, at int, n int, path long"
    rows = stored(whole.cogroup(cut.groupBy("group")).applyInPandas(split, made), "paths")
    placed = rows.join(runs.select("no", "least"), "no")
    least = placed.groupBy("path").agg(
        F.min(_place("least.id", "least.key", F.col("least.start") + F.col("at"))).alias("least")
    )
    named = rows.select("path", "group").distinct().join(least, "path")
    named = named.select(
        F.col("group").alias("to"),
        F.col("path").alias("name"),
        F.col("least.o").alias("unnamed"),
        F.coalesce("least.id", F.lit(0)).alias("least"),
    )

    def name(mine: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        both = mine.merge(told, left_on="path", right_on="name")
        return both[["no", "at", "n", "path", "unnamed", "least"]]

    return rows.groupBy("group").cogroup(named.groupBy("to")).applyInPandas(
        name, "no long, at int, n int, path long, unnamed boolean, least long"
    )


SPANS = "array<struct<start:bigint,n:int,path:bigint,gone:boolean>>"


def repeated_spans(docs: DataFrame, k: int, bits: int, hash_bits: int) -> DataFrame:
    """``name, key, start, n, path, gone``: the places of all paths, ``n`` edges
    long, with whether a document with a smaller id has it."""
    runs = stored(runs_of(repeated_edges(sent_edges(docs, k, bits, hash_bits))), "runs")
    once = runs.groupBy("run").agg(
        F.max("n").alias("n"), F.max("edges").alias("edges"), F.min(_place()).alias("least")
    )
    once = stored(in_groups(once), "once")
    cut = paths_of(once)
    parts = cut.groupBy("no").agg(
        F.collect_list(F.struct("at", "n", "path", F.expr("if(unnamed, NULL, least)").alias("least"))).alias("parts")
    )
    parts = parts.join(once.select("no", "run"), "no").select("run", "parts")
    each = runs.select("id", "key", "start", "run").join(parts, "run").select("id", "key", "start", F.explode("parts").alias("p"))
    # an id that is null comes after all others
    gone = F.coalesce(F.col("p.least") < F.col("id"), F.col("id").isNull() & F.col("p.least").isNotNull())
    return each.select(
        _name("id").alias("name"),
        *("key", (F.col("start") + F.col("p.at")).alias("start")),
        *(F.col("p.n").alias("n"), F.col("p.path").alias("path"), gone.alias("gone")),
    )


def _name(id_: str) -> Column:
    return F.coalesce(F.col(id_).cast("string"), F.lit(""))


def _by_text(docs: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` with an array of their ``spans``."""
    fields = F.struct("start", "n", "path", "gone")
    listed = spans.groupBy("name", "key").agg(F.collect_set(fields).cast(SPANS).alias("spans"))
    return docs.withColumn("name", _name("id")).join(listed, ["name", "key"], how)


def _starts(span: dict, k: int) -> tuple[int, int]:
    """First word and word after the last of a span."""
    return span["start"], span["start"] + span["n"] + k - 1


KEPT = (
    "id long, name string, key long, n_words long, n_removed long, kept_sha256 string, kept_text string,"
    " checks array<struct<path:bigint,digest:binary>>"
)


def kept_words(docs: DataFrame, spans: DataFrame, k: int, texts: bool = False) -> DataFrame:
    """What is left of each row without the spans that are ``gone``, and the
    digest of the words of every span."""
    checks = pa.list_(pa.struct([("path", pa.int64()), ("digest", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, sha, kept_texts, digests = [], [], [], [], []
            for raw, found in zip(batch.column("text").cast(pa.binary()), batch.column("spans").to_pylist(), strict=True):
                words = (raw.as_py() or b"").split()
                keep = np.ones(len(words), bool)
                told = []
                for span in found or []:
                    first, end = _starts(span, k)
                    told.append({"path": span["path"], "digest": xxhash.xxh3_128_digest(b" ".join(words[first:end]))})
                    if span["gone"]:
                        keep[first:end] = False
                n.append(len(words))
                removed.append(len(words) - int(keep.sum()))
                left = b" ".join(words if removed[-1] == 0 else [words[i] for i in np.flatnonzero(keep)])
                sha.append(hashlib.sha256(left).hexdigest())
                kept_texts.append(left.decode("utf-8", "replace") if texts else None)
                digests.append(told)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "name", "key")),
                    *(pa.array(c, pa.int64()) for c in (n, removed)),
                    *(pa.array(c, pa.string()) for c in (sha, kept_texts)),
                    pa.array(digests, checks),
                ],
                names=[f.split()[0] for f in KEPT.split(", ")],
            )

    return _by_text(docs, spans, "left").select("id", "name", "key", "text", "spans").mapInArrow(run, KEPT)


def window_by_window(docs: DataFrame, spans: DataFrame, k: int) -> DataFrame:
    """``spans`` as spans of one window, judged by the digests of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, start, digest = [], [], []
            texts = batch.column("text").cast(pa.binary())
            for i, (raw, found) in enumerate(zip(texts, batch.column("spans").to_pylist(), strict=True)):
                words = (raw.as_py() or b"").split()
                for span in found:
                    for s in range(span["start"], span["start"] + span["n"]):
                        at.append(i)
                        start.append(s)
                        digest.append(xxhash.xxh3_128_digest(b" ".join(words[s : s + k])))
            rows = [batch.column(c).take(pa.array(at, pa.int64())) for c in ("id", "name", "key")]
            yield pa.RecordBatch.from_arrays(
                [*rows, pa.array(start, pa.int64()), pa.array(digest, pa.binary())],
                names=["id", "name", "key", "start", "digest"],
            )

    some = _by_text(docs, spans, "inner").select("id", "name", "key", "text", "spans")
    windows = stored(some.mapInArrow(run, "id long, name string, key long, start long, digest binary"), "windows")
    least = windows.groupBy("digest").agg(F.min("id").alias("least"))
    gone = F.coalesce(F.col("least") < F.col("id"), F.col("id").isNull() & F.col("least").isNotNull())
    return windows.join(least, "digest").select(
        *("name", "key", "start"), F.lit(1).alias("n"), F.lit(None).cast("long").alias("path"), gone.alias("gone")
    )


def drop_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = WINDOW,
    texts: bool = False,
    hash_bits: int = 64,
) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256, kept_text`` of every row; the text
    only if ``texts``.

    A word goes if a window of ``k`` words that covers it also starts in a
    document with a smaller id, whatever is left of that one. Null texts have
    no words. A null id is larger than all others; rows with one id, repeated
    rows too, take nothing from each other. Whole texts of any length count;
    texts with fewer than ``k`` words stay. An empty table gives no rows.
    Other columns are not read. Rows are read several times and have to come in
    the same partitions each time, as those of a table do.

    ``hash_bits`` below 64 makes hashes meet more often; the result is the same.
    """
    text = ref(text_col).cast("string")
    rows = docs.select(
        ref(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = math.ceil(math.log2(max(size / BUCKET_BYTES, 64)))
    spans = stored(repeated_spans(rows, k, bits, hash_bits), "spans")
    kept = stored(kept_words(rows, spans, k, texts), "kept")
    # two places of a path with different words
    told = kept.select(F.explode("checks").alias("c")).select("c.path", "c.digest")
    differ = told.groupBy("path").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select("path")
    differ = stored(differ, "differ")
    if not differ.isEmpty():
        wrong = stored(spans.join(differ, "path", "left_semi"), "wrong")
        touched = stored(wrong.select("name", "key").distinct(), "touched")
        right = spans.join(differ, "path", "left_anti").join(touched, ["name", "key"], "left_semi")
        again = rows.withColumn("name", _name("id")).join(touched, ["name", "key"], "left_semi").select("id", "key", "text")
        mended = right.unionByName(window_by_window(again, wrong, k))
        kept = kept.join(touched, ["name", "key"], "left_anti").unionByName(kept_words(again, mended, k, texts))
    return kept.select("id", "n_words", "n_removed", "kept_sha256", "kept_text")
