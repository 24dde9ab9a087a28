"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are counted, one of the target (a
bounded sample of labelled good documents) and one of the raw text (every
document). The log ratio of their probabilities, added up over the n-grams of
a document, is its importance weight; a seeded Gumbel number is added and the
k documents with the largest sums are kept, which samples without replacement
in proportion to the weights.

n-grams are words, pairs of words, forms of words (runs of lower case, upper
case and digits shortened to a letter each; ``=`` for a word equal to the one
before) and pairs of forms. k is the number of documents whose weight is above the bound that
parts good from bad best among the labelled ones.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import free_prefix, ref
from tidelog.session import bounded_batches, stored

BUCKETS = 1 << 14
#: Labelled documents that the target model and the bound are fitted on, at most.
LABELLED = 20_000
SMOOTHING = 1.0
SEED = 17

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = re.compile(r"[^\W\dA-Z_]+")
_UPPER = re.compile(r"[A-Z]+")
_DIGIT = re.compile(r"\d+")
#: Hashes that a worker keeps of words, and of forms: the frequent ones are
#: soon met again, and a worker keeps its memory beside later stages.
_KEPT = 50_000


class NGrams:
    """Hashed n-grams of texts; keeps the hashes of words and forms it has met."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.word: dict[str, int] = {}
        self.form: dict[str, int] = {}

    def _hash(self, known: dict[str, int], items: list[str], kind: bytes) -> list[int]:
        new = [x for x in set(items) if x not in known]
        if len(known) + len(new) > _KEPT:
            known.clear()
            new = list(set(items))
        for x in new:
            known[x] = zlib.crc32(kind + x.encode("utf-8", "surrogatepass"))
        return list(map(known.__getitem__, items))

    def of(self, text: str | None) -> np.ndarray:
        """The bucket of every n-gram of a text, repeats included."""
        words = _WORDS.findall(text) if text else []
        if not words:
            return np.empty(0, np.int64)
        shaped = _DIGIT.sub("0", _UPPER.sub("A", _LOWER.sub("a", " ".join(words))))
        forms = shaped.split(" ")
        forms[1:] = ["=" if a == b else f for a, b, f in zip(words, words[1:], forms[1:], strict=False)]
        form = np.array(self._hash(self.form, forms, b"f"), np.uint64)
        word = np.array(self._hash(self.word, words, b"w"), np.uint64)
        found = np.concatenate((word, form, _pairs(form), _pairs(word)))
        return (found % np.uint64(self.buckets)).astype(np.int64)


def _pairs(hashes: np.ndarray) -> np.ndarray:
    """A hash of each item and the one after it."""
    both = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return both >> np.uint64(24)


def label_sample(labels: DataFrame, id_col: str, limit: int, seed: int) -> DataFrame:
    """At most ``limit`` labelled ids, in a seeded order: ``id``, ``good``, ``bad``.

    An id with several labels is bad if one of them is. Null ids and null
    qualities are left out. Toxic documents are no target, though not bad.
    """
    quality, toxic = F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))
    known = (
        labels.where(quality.isNotNull() & ref(id_col).isNotNull())
        .groupBy(ref(id_col).alias("id"))
        .agg(F.min(quality).alias("quality"), F.max(toxic).alias("toxic"))
    )
    return (
        known.orderBy(F.xxhash64(F.lit(seed), "id"), "id")
        .limit(limit)
        .select("id", ((quality == 1) & (F.col("toxic") == 0)).alias("good"), (quality == 0).alias("bad"))
    )


def log_ratios(docs: DataFrame, text: str, good: str, buckets: int, smoothing: float) -> np.ndarray:
    """Log of target over raw probability of each bucket; one pass over all
    documents, a row per bucket and task."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams = NGrams(buckets)
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            for body, is_good in zip(batch[text], batch[good], strict=True):
                found = np.bincount(grams.of(body), minlength=buckets)
                raw += found
                if is_good:
                    target += found
        at = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": at, "raw": raw[at], "target": target[at]})

    rows = docs.select(text, good).mapInPandas(count, "bucket long, raw long, target long")
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for bucket, r, t in rows.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        raw[bucket], target[bucket] = r, t
    if not target.sum():
        return np.zeros(buckets)
    p = (target + smoothing) / (target.sum() + smoothing * buckets)
    q = (raw + smoothing) / (raw.sum() + smoothing * buckets)
    return np.log(p / q)


def best_bound(weights: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The bound that parts good from bad best, each kind counting as one;
    the lowest of equal ones. Without bad documents nothing is below it."""
    if not good.any() or not bad.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    ordered = weights[order]
    good_below = np.concatenate(([0], np.cumsum(good[order]))) / good.sum()
    bad_below = np.concatenate(([0], np.cumsum(bad[order]))) / bad.sum()
    # a cut between equal weights is none
    real = np.concatenate(([True], ordered[1:] > ordered[:-1], [True]))
    gain = np.where(real, bad_below - good_below, -1)
    cut = int(np.argmax(gain))
    if cut == 0:
        return -np.inf
    if cut == len(ordered):
        return np.inf
    return float((ordered[cut - 1] + ordered[cut]) / 2)


def kth_largest(scores: DataFrame, column: str, k: int, small: int = 50_000) -> float:
    """The k-th largest number of a column by counts in ever narrower ranges;
    what is sorted in the end is at most ``small`` numbers or all equal."""
    low, high = scores.agg(F.min(column), F.max(column)).first()
    bins = 1024
    while True:
        inside = scores.where(F.col(column).between(low, high))
        if low == high:
            return low
        if inside.count() <= small:
            return inside.orderBy(F.desc(column)).limit(k).agg(F.min(column)).first()[0]
        width = (high - low) / bins
        at = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        counts = inside.groupBy(at.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(counts.collect(), key=lambda r: -r["bin"]):
            if row["n"] >= k:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]


@dataclass
class Fitted:
    """Log ratios by bucket, the bound of the drawn weights, and the weights
    of the documents it was fitted on: ``id, log_weight, gumbel_weight, kept``."""

    ratios: np.ndarray
    least: float
    weights: DataFrame
    seed: int


def weighed(docs: DataFrame, ratios: np.ndarray, seed: int, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``log_weight``, null without words, and ``gumbel_weight``."""
    buckets = len(ratios)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grams = NGrams(buckets)
        for batch in batches:
            found = [grams.of(x) for x in batch]
            sums = [float(shared.value[f].sum()) if len(f) else None for f in found]
            yield pd.Series(sums, dtype="Float64")

    weigh.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    weight = F.pandas_udf(weigh, "double")(ref(text_col).cast("string"))
    drawn = F.xxhash64(F.lit(seed), F.coalesce(ref(id_col).cast("string"), F.lit("")))
    uniform = (F.shiftrightunsigned(drawn, 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    kept = [c for c in docs.columns if c not in ("log_weight", "gumbel_weight", "kept")]
    rows = docs.select(*[ref(c) for c in kept], weight.alias("log_weight"))
    return rows.withColumn("gumbel_weight", F.col("log_weight") - F.log(-F.log(uniform)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    labelled: int = LABELLED,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
    seed: int = SEED,
    columns: Sequence[str] = (),
) -> Fitted:
    """Count both models, weigh every document and find the bound for k.

    Null texts and texts without words weigh null and are not kept. Texts of
    any length are read whole. Without labelled good and bad documents every
    other text is kept. Repeated rows have one weight and one fate, so ties may
    keep more than k. ``columns`` of ``docs`` go along with the weights, for
    those who want the documents fitted on without weighing them again; their
    names must differ from those of ``weights``.
    """
    p = free_prefix(docs, "qc")
    sample = stored(label_sample(labels, id_col, labelled, seed), "labels")
    # at most ``labelled`` rows
    known = F.broadcast(sample.where("good").select(F.col("id").alias(f"{p}id"), F.lit(True).alias(f"{p}good")))
    marked = docs.select(ref(id_col).alias(f"{p}id"), ref(text_col).cast("string").alias(f"{p}text"))
    marked = marked.join(known, f"{p}id", "left").withColumn(f"{p}good", F.coalesce(f"{p}good", F.lit(False)))
    with bounded_batches(docs.sparkSession):
        ratios = log_ratios(marked, f"{p}text", f"{p}good", buckets, smoothing)
    body = f"{p}text"
    named = docs.select(ref(id_col).alias("id"), ref(text_col).alias(body), *[ref(c) for c in columns])
    with bounded_batches(docs.sparkSession):
        weights = stored(weighed(named, ratios, seed, "id", body).drop(body), "weights")
    judged = weights.where("log_weight IS NOT NULL").join(F.broadcast(sample), "id")
    judged = judged.select("log_weight", "good", "bad").toPandas()
    bound = best_bound(*[judged[c].to_numpy() for c in ("log_weight", "good", "bad")])
    known_weight = weights.where("log_weight IS NOT NULL")
    k = known_weight.where(F.col("log_weight") >= F.lit(bound)).count()
    least = kth_largest(known_weight, "gumbel_weight", k) if k else float("inf")
    return Fitted(ratios, least, _with_kept(weights, least), seed)


def _with_kept(rows: DataFrame, least: float) -> DataFrame:
    return rows.withColumn("kept", F.coalesce(F.col("gumbel_weight") >= F.lit(least), F.lit(False)))


def classify(docs: DataFrame, fitted: Fitted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``log_weight``, ``gumbel_weight`` and ``kept``, which take
    the place of columns with these names. No shuffle. Null texts and texts
    without words are not kept; an empty table gives no rows."""
    return _with_kept(weighed(docs, fitted.ratios, fitted.seed, id_col, text_col), fitted.least)
