"""Jaccard join of texts on word n-grams, by rare-first prefix filtering.

Documents with equal sets are one class; classes are joined. The n-grams of a
class are ordered by how many documents hold them, rarest first, counted over
all documents in a table of fixed size (hashed, so an order, not exact
numbers; any one order for all keeps the join complete). Classes that are as
alike as asked share an n-gram of the first ``n - ceil(t n) + 1``. On these
prefixes they are joined, pairs are left out by length, by the positions of
the shared n-gram, and by how far the counts of n-grams in ``PARTS`` hash
classes let the sets overlap (which also bounds what lies behind the prefix).
What is left is verified once per pair on the whole sets.

What is asked for is components, so pairs inside a component that earlier
links have joined are not needed. The join runs three times: on neighbours in
the list of an n-gram, then on the first partner of each row, both a number of
pairs in proportion to the lists; then on all pairs left between different
components. Lists with one component left have nothing more to say and go
before each of the later two. Of the others those longer than ``BLOCK`` are cut
into blocks, and pairs of blocks are tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, free_prefix, looked_up, ref
from tidelog.llm.components import components
from tidelog.llm.shingles import shingle_sets
from tidelog.session import bounded_batches, stored

SHINGLE = 4
PERCENT = 85
#: Counters of the n-gram order: fixed, 2 MB.
COUNTERS = 1 << 18
#: Hash classes of n-grams; a byte each for every class of documents.
PARTS = 256
_FULL = 255
BLOCK = 1000
#: Classes with more documents are looked up apart from the others.
HOT = 10_000

_GROUP = 1024  # counters in a row when they are added up


def _class_of(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes()))))


def _parts(shingles: np.ndarray) -> bytes:
    """n-grams by hash class; a count of 255 stands for more as well."""
    counts = np.bincount((shingles & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS)
    return np.minimum(counts, _FULL).astype(np.uint8).tobytes()


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest overlap with 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def shingled(docs: DataFrame, size: int) -> DataFrame:
    """``id, key, text`` to a row per document: ``id, key, n, cls, parts``; and
    rows with sums of counters: ``chunk, counts``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(COUNTERS, np.int64)
        seen: set[int] = set()
        for batch in batches:
            n, cls, parts = [], [], []
            for s in shingle_sets(batch["text"].tolist(), size):
                n.append(len(s))
                cls.append(_class_of(s))
                parts.append(_parts(s))
                if cls[-1] not in seen:
                    seen.add(cls[-1])
                    counters += np.bincount(_counter(s), minlength=COUNTERS) if len(s) > COUNTERS else 0
                    if len(s) <= COUNTERS:
                        np.add.at(counters, _counter(s), 1)
            yield pd.DataFrame(
                {"id": batch["id"].astype("Int64"), "key": batch["key"], "n": n, "cls": cls, "parts": parts}
            )
        chunks = counters.reshape(-1, _GROUP)
        used = np.flatnonzero(chunks.any(axis=1))
        yield pd.DataFrame({"chunk": used, "counts": [chunks[c].astype("<i8").tobytes() for c in used]})

    return docs.mapInPandas(_whole(run), "id long, key long, n long, cls long, parts binary, chunk long, counts binary")


def _whole(run):
    """Rows of two kinds in one table: what a kind lacks is null."""
    columns = ["id", "key", "n", "cls", "parts", "chunk", "counts"]
    numbers = {"id", "key", "n", "cls", "chunk"}

    def padded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in run(batches):
            for c in columns:
                if c not in frame:
                    frame[c] = pd.Series([None] * len(frame), dtype="Int64" if c in numbers else object)
            yield frame[columns]

    return padded


def rarity(hashed: DataFrame) -> np.ndarray:
    """The counters of all tasks together."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(raw, "<i8") for raw in group["counts"]], axis=0)
        return pd.DataFrame({"chunk": group["chunk"].iloc[:1], "counts": [total.astype("<i8").tobytes()]})

    rows = hashed.where("chunk IS NOT NULL").select("chunk", "counts")
    result = np.zeros((COUNTERS // _GROUP, _GROUP), np.int64)
    for chunk, raw in rows.groupBy("chunk").applyInPandas(add, "chunk long, counts binary").collect():
        result[chunk] = np.frombuffer(raw, "<i8")
    return result.reshape(-1)


def prefixes(docs: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """``token, cls, n, pos`` of the prefix n-grams, once per class and task."""
    shared = docs.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 31) - 1).astype(np.int32))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            token, cls, n, pos = [], [], [], []
            for s in shingle_sets(batch["text"].tolist(), size):
                if not len(s) or (c := _class_of(s)) in seen:
                    continue
                seen.add(c)
                length = len(s) - (percent * len(s) + 99) // 100 + 1
                first = np.lexsort((s, shared.value[_counter(s)]))[:length]
                token.append(s[first].view(np.int64))
                cls.append(np.full(length, c))
                n.append(np.full(length, len(s)))
                pos.append(np.arange(length))
            if token:
                columns = {"token": token, "cls": cls, "n": n, "pos": pos}
                yield pd.DataFrame({k: np.concatenate(v) for k, v in columns.items()})

    return docs.select("text").mapInPandas(run, "token long, cls long, n int, pos int")


def shared_tokens(rows: DataFrame) -> DataFrame:
    """The prefix rows of n-grams that two classes or more have in theirs.

    Rows come sorted by n-gram and are read once; a task holds one batch and
    one row, whatever the length of a list.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        after = None  # the n-gram before the held row
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            token, cls = frame["token"].to_numpy(), frame["cls"].to_numpy()
            again = np.concatenate(([False], (token[1:] == token[:-1]) & (cls[1:] == cls[:-1])))
            frame, token = frame[~again].reset_index(drop=True), token[~again]
            following = np.concatenate((token[1:] == token[:-1], [False]))
            before = np.concatenate(([token[0] == after], following[:-1]))
            last = len(frame) - 1
            yield frame[(following | before) & (np.arange(len(frame)) < last)]
            held = frame.iloc[last:]
            after = token[last] if before[last] else None
        if held is not None and after is not None:
            yield held

    ordered = rows.repartition("token").sortWithinPartitions("token", "n", "cls")
    return ordered.mapInPandas(run, "token long, cls long, n int, pos int")


def _fits(x: pd.DataFrame, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of rows of one n-gram that length and positions allow."""
    a, b = x["n"].to_numpy().astype(np.int64), x["pos"].to_numpy().astype(np.int64)
    need = least_overlap(a[i], a[j], percent)
    behind = 1 + np.minimum(a[i] - b[i] - 1, a[j] - b[j] - 1)
    return (np.minimum(a[i], a[j]) >= need) & (behind >= need)


def _overlaps(x: pd.DataFrame, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose hash classes leave room for the overlap needed; sets with
    a full count are let through."""
    parts = np.frombuffer(b"".join(x["parts"]), np.uint8).reshape(-1, PARTS)
    n = x["n"].to_numpy().astype(np.int64)
    full = parts.max(axis=1) == _FULL
    fits = np.ones(len(i), bool)
    for first in range(0, len(i), 20_000):
        a, b = i[first : first + 20_000], j[first : first + 20_000]
        room = np.minimum(parts[a], parts[b]).sum(axis=1, dtype=np.int64)
        fits[first : first + 20_000] = full[a] | full[b] | (room >= least_overlap(n[a], n[b], percent))
    return fits


LISTED = "token long, cls long, n int, pos int, comp long"


def neighbours(lists: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` next to each other in the list of an n-gram, by size
    or by position, that length and positions allow.

    Lists are dealt by ranges, so a long one is many tasks, and read batch by
    batch. Neighbours in different batches are no pair here; all pairs that
    matter are tried later.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if not len(x):
                continue
            token, cls = x["token"].to_numpy(), x["cls"].to_numpy()
            found = []
            for order in (np.arange(len(x)), np.lexsort((x["pos"].to_numpy(), token))):
                same = token[order[1:]] == token[order[:-1]]
                i, j = order[:-1][same], order[1:][same]
                ok = _fits(x, i, j, percent)
                found.append(np.stack((np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])), axis=1)[ok])
            yield pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    ordered = lists.repartitionByRange("token", "n", "cls").sortWithinPartitions("token", "n", "cls")
    return ordered.mapInPandas(run, "a long, b long").where("a <> b").distinct()


def by_list(rows: DataFrame, percent: int, want: str) -> DataFrame:
    """What the lists of n-grams say about rows in different components.

    ``rows``: the rows that have any partner that length and positions allow.
    ``pairs``: all pairs ``a, b`` so, less those that ``parts`` rules out;
    ``first``: of these the first of each row. ``rows`` has the columns of
    ``LISTED``, ``i, j, block`` and, for the last two, ``parts``. A task holds
    one list, at most two blocks long.
    """

    def read(x: pd.DataFrame) -> pd.DataFrame:
        list_of = x.groupby(["token", "i", "j"], sort=False).ngroup().to_numpy()
        comp, block, cls = (x[c].to_numpy() for c in ("comp", "block", "cls"))
        crossing = (x["i"] != x["j"]).to_numpy()
        found = []
        partnered = np.zeros(len(x), bool)

        def take(i: np.ndarray, j: np.ndarray) -> None:
            ok = (comp[i] != comp[j]) & ~(crossing[i] & (block[i] == block[j]))
            if want == "first":
                ok &= ~(partnered[i] & partnered[j])
            i, j = i[ok], j[ok]
            ok = _fits(x, i, j, percent)
            i, j = i[ok], j[ok]
            if want == "rows":
                partnered[i] = partnered[j] = True
                return
            if len(i):
                ok = _overlaps(x, i, j, percent)
                i, j = i[ok], j[ok]
                partnered[i] = partnered[j] = True
            if len(i):
                found.append(np.stack((np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])), axis=1))

        ends = np.searchsorted(list_of, list_of, side="right")
        here = np.arange(len(x))
        step = 1
        while len(here := here[here + step < ends[here]]):
            take(here, here + step)
            step += 1
        if want == "rows":
            return x.loc[partnered, [f.split()[0] for f in LISTED.split(", ")]]
        if not found:
            return pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        return pd.DataFrame(np.unique(np.concatenate(found), axis=0), columns=["a", "b"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
            tail = frame[["token", "i", "j"]].iloc[-1]
            open_ = ((frame["token"] == tail["token"]) & (frame["i"] == tail["i"]) & (frame["j"] == tail["j"])).to_numpy()
            held = frame[open_].reset_index(drop=True)
            if not open_.all():
                yield read(frame[~open_].reset_index(drop=True))
        if held is not None:
            yield read(held)

    ordered = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "cls")
    if want == "rows":
        return ordered.mapInPandas(run, LISTED).dropDuplicates(["token", "cls"])
    return ordered.mapInPandas(run, "a long, b long").distinct()


def with_room(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs that the hash classes of their n-grams leave room for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            count = len(batch)
            both = pd.DataFrame(
                {"parts": [*batch["x"], *batch["y"]], "n": np.concatenate((batch["m"], batch["n"]))}
            )
            here = np.arange(count)
            yield batch.loc[_overlaps(both, here, here + count, percent), ["a", "b"]]

    left = classes.select(F.col("cls").alias("a"), F.col("parts").alias("x"), F.col("n").alias("m"))
    right = classes.select(F.col("cls").alias("b"), F.col("parts").alias("y"), "n")
    return pairs.join(left, "a").join(right, "b").mapInPandas(run, "a long, b long")


def _in_blocks(rows: DataFrame) -> DataFrame:
    """Rows of the lists that hold two components or more, with the pairs of
    blocks they belong to; short lists are one block."""
    lists = (
        rows.groupBy("token")
        .agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count(F.lit(1)).alias("rows"))
        .where("x <> y")
        .select("token", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    rows = looked_up(rows, stored(lists, "open"), ["token"]).where("blocks IS NOT NULL")
    blocks = F.col("blocks")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("cls"), blocks).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return rows.select(
        *[c for c in rows.columns if c not in ("blocks", "other")],
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
    )


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs that are as alike as asked, on their whole sets."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    keys = classes.join(wanted, "cls").select("key").distinct().withColumn("hit", F.lit(True))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for s in shingle_sets(batch["text"].tolist(), size):
                if len(s) and (c := _class_of(s)) not in seen:
                    seen.add(c)
                    rows.append((c, s.tobytes()))
            yield pd.DataFrame(rows, columns=["cls", "shingles"])

    found = looked_up(docs.select("key", "text"), stored(keys, "keys"), ["key"]).where("hit")
    whole = stored(
        found.select("text").mapInPandas(sets, "cls long, shingles binary").groupBy("cls").agg(F.first("shingles").alias("shingles")),
        "sets",
    )

    def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield batch.loc[np.array(keep, bool), ["a", "b"]]

    left = whole.withColumnsRenamed({"cls": "a", "shingles": "x"})
    right = whole.withColumnsRenamed({"cls": "b", "shingles": "y"})
    return pairs.join(left, "a").join(right, "b").mapInPandas(alike, "a long, b long")


def jaccard_groups(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """``id, key, n, cls, component_id`` of every row; ``key`` is a hash of the
    text, ``component_id`` null where no row of the component has an id, and
    ``root`` stands for the component in any case.

    Null texts and texts without words have no n-grams and link with nothing;
    they are their own component. Repeated rows and equal texts are one class.
    Null ids take part, but name a component only if it has no other id. An
    empty table gives no rows. Other columns are not read.
    """
    with bounded_batches(docs.sparkSession):
        return _jaccard_groups(docs, id_col, text_col, size, percent)


def _jaccard_groups(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """All that goes to Python is stored before this returns."""
    docs = docs.select(
        ref(id_col).cast("long").alias("id"),
        F.xxhash64(F.coalesce(ref(text_col).cast("string"), F.lit(""))).alias("key"),
        ref(text_col).cast("string").alias("text"),
    )
    hashed = stored(shingled(docs, size), "shingles")
    counts = rarity(hashed)
    rows = hashed.where("n IS NOT NULL").select("id", "key", "n", "cls", "parts")
    classes = stored(
        rows.where("n > 0").groupBy("cls").agg(F.min("id").alias("least"), F.min("key").alias("key"), F.first("parts").alias("parts"), F.first("n").alias("n"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    lists = stored(shared_tokens(prefixes(docs, size, percent, counts)), "lists")
    near = stored(neighbours(lists, percent), "pairs")
    roomy = stored(with_room(near, classes, percent), "pairs")
    links = stored(verified(roomy, docs, classes, size, percent), "links")

    def joined(rows: DataFrame, known: DataFrame) -> DataFrame:
        roots = components(known, "a", "b").withColumnRenamed("node", "cls")
        rows = looked_up(rows.drop("comp"), roots, ["cls"])
        return rows.withColumn("comp", F.coalesce("root", F.col("cls"))).drop("root")

    # rows without a partner in another component have nothing more to say
    open_rows = by_list(_in_blocks(stored(joined(lists, links), "lists")), percent, "rows")
    open_rows = stored(open_rows.join(classes.select("cls", "parts"), "cls"), "lists")
    first = by_list(_in_blocks(open_rows), percent, "first")
    first = stored(first.join(near, ["a", "b"], "left_anti"), "pairs")
    links = links.union(stored(verified(first, docs, classes, size, percent), "links"))
    rest = by_list(_in_blocks(joined(open_rows, links)), percent, "pairs")
    rest = stored(rest.join(near.union(first), ["a", "b"], "left_anti"), "pairs")
    links = links.union(stored(verified(rest, docs, classes, size, percent), "links"))
    roots = components(links, "a", "b").withColumnRenamed("node", "cls")
    named = roots.join(classes.select("cls", "least"), "cls")
    least = named.groupBy("root").agg(F.min("least").alias("named"))
    named = named.select("cls", "root").join(least, "root").select("cls", "root", "named")
    ids = classes.select("cls", "least", "copies").join(named, "cls", "left")
    ids = ids.select(
        *("cls", "copies", F.coalesce("root", "cls").alias("root")),
        F.coalesce("named", "least").alias("component_id"),
    )
    found = _by_class(rows.select("id", "key", "n", "cls"), stored(ids, "names"))
    full = F.col("n") > 0
    return found.select(
        *("id", "key", "n"),
        F.when(full, F.col("root")).alias("root"),
        F.when(full, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def _by_class(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` and ``component_id`` of their class. Classes of
    many documents, at most one of ``HOT`` rows each, are looked up first; the
    rows they take are spread in the join with the others."""
    hot = ids.where(F.col("copies") > HOT).select("cls", F.col("root").alias("hot_root"), F.col("component_id").alias("hot_id"))
    marked = looked_up(rows, hot, ["cls"])
    done = F.col("hot_root").isNotNull()
    # documents without n-grams, all of one class, are spread as well
    spread = done | (F.col("n") == 0)
    marked = marked.withColumn("at", F.when(spread, F.xxhash64("id", "key")).otherwise(F.col("cls")))
    cold = ids.where(F.col("copies") <= HOT).select(F.col("cls").alias("at"), "root", "component_id")
    joined = marked.join(cold, "at", "left")
    return joined.select(
        *("id", "key", "n", F.coalesce("hot_root", "root").alias("root")),
        F.when(done, F.col("hot_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row, as in ``jaccard_groups``."""
    rows = jaccard_groups(docs, id_col, text_col, size, percent)
    return rows.select("id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """``docs`` with one row of each component, that with the least id (null
    last, then by text); of rows equal in both, any one. Texts without words
    all stay."""
    p = free_prefix(docs, "one")
    key, name, number = f"{p}key", f"{p}name", f"{p}number"
    rows = jaccard_groups(docs, id_col, text_col, size, percent).where("n > 0")
    chosen = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("o"), "id", "key")).alias("m"))
    chosen = chosen.select(
        F.col("m.key").alias(key),
        F.coalesce(F.col("m.id").cast("string"), F.lit("")).alias(name),
        F.lit(True).alias(f"{p}chosen"),
    )
    text = F.coalesce(ref(text_col).cast("string"), F.lit(""))
    named = F.coalesce(ref(id_col).cast("long").cast("string"), F.lit(""))
    marked = docs.withColumn(key, F.xxhash64(text)).withColumn(name, named)
    spoken = marked.where(text.rlike(WORD)).join(chosen, [key, name])
    same = Window.partitionBy(key, name).orderBy(name)
    spoken = spoken.withColumn(number, F.row_number().over(same)).where(F.col(number) == 1)
    return spoken.select(*[ref(c) for c in docs.columns]).union(docs.where(~text.rlike(WORD)))
