"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the words to take in proportion to its weight. A
source whose share is above ``max_epochs`` times its own size is held there,
and what it cannot use is shared again by weight among the others until no
source is above its bound. In closed form: with sources by bound over weight,
the held ones are a prefix, and all others get weight times one level.

A target is then taken as whole repetitions of every document and a fractional
repetition, for which documents follow a seeded order (MD5 of seed and id)
until the words are used up; only the document at the end is counted in part.
Words before a document are found in two steps, totals of 4,096 ranges of the
order first, so that no source is ordered in one task. Everything is native.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import WORD, free_prefix, ref, text_of

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
SEED = "17"


def source_targets(
    sizes: DataFrame, source: str, size: str, weights=WEIGHTS, share=SHARE, max_epochs=MAX_EPOCHS
) -> DataFrame:
    """Add ``weight``, ``target``, ``epochs`` and ``extra`` to one row per source.

    Sources take the weights in turn, by code point, null last. The windows
    hold one row per source, all in one task: right for some hundred thousand
    sources, not for every host of a crawl as one. No rows give no rows; a
    source without words gets target 0.
    """
    by_name = Window.orderBy(ref(source).asc_nulls_last())
    everything = Window.partitionBy()
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    df = sizes.withColumn("weight", weight).withColumn("bound", F.lit(float(max_epochs)) * ref(size))
    by_bound = Window.orderBy(F.col("bound") / F.col("weight"), ref(source).asc_nulls_last())
    before = by_bound.rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum(ref(size)).over(everything)
    level = (total - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    df = df.withColumn("level", level)
    # of the sources not held, the first in this order has the level that all of them get, the largest
    first_free = F.max(F.when(F.col("bound") > F.col("weight") * F.col("level"), F.col("level"))).over(everything)
    df = df.withColumn("target", F.coalesce(F.least("bound", F.col("weight") * first_free), F.col("bound")))
    has_words = ref(size) > 0
    epochs = F.when(has_words, F.floor(F.col("target") / ref(size))).otherwise(F.lit(0)).cast("long")
    df = df.withColumn("epochs", epochs)
    extra = F.round("target").cast("long") - F.col("epochs") * ref(size)
    return df.withColumn("extra", F.greatest(extra, F.lit(0).cast("long"))).drop("level", "bound")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    max_epochs: float = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``.

    Null texts and texts without words have size 0 and are taken 0 times. Null
    sources are one source; rows without an id are ordered by their texts.
    Repeated rows are rows of their own; equal ids are ordered by size and
    text. Columns of ``docs`` with the name of a result give way to it.
    """
    p = free_prefix(docs, "mix")
    results = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in results]
    src, none, order, bucket = f"{p}src", f"{p}none", f"{p}order", f"{p}bucket"
    size, tie = f"{p}size", f"{p}tie"
    rows = docs.select(
        *[ref(c) for c in kept],
        F.coalesce(ref(source_col).cast("string"), F.lit("")).alias(src),
        ref(source_col).isNull().alias(none),
        # rows without an id follow their texts
        F.md5(
            F.concat(
                F.lit(f"{seed}:"),
                F.coalesce(ref(id_col).cast("string"), F.concat(F.lit(":"), F.md5(text_of(text_col)))),
            )
        ).alias(order),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias(size),
        F.crc32(text_of(text_col)).alias(tie),
    ).withColumn(bucket, F.substring(order, 1, 3))
    keys = [src, none, bucket]
    buckets = rows.groupBy(*keys).agg(F.sum(size).alias(f"{p}words"))
    totals = buckets.groupBy(src, none).agg(F.sum(f"{p}words").alias(f"{p}source_size"))
    named = totals.withColumn(f"{p}name", F.when(~F.col(none), F.col(src)))
    targets = source_targets(named, f"{p}name", f"{p}source_size", weights, share, max_epochs)
    targets = targets.select(
        src, none, f"{p}source_size", *[F.col(c).alias(f"{p}{c}") for c in ("target", "epochs", "extra")]
    )
    ahead = Window.partitionBy(src, none).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn(f"{p}ahead", F.coalesce(F.sum(f"{p}words").over(ahead), F.lit(0)))
    buckets = buckets.drop(f"{p}words").join(targets, [src, none])
    inside = (
        Window.partitionBy(*keys)
        .orderBy(order, ref(id_col), size, tie)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn(f"{p}inside", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(buckets, keys)
    left = F.col(f"{p}extra") - F.col(f"{p}ahead") - F.col(f"{p}inside")
    part = F.greatest(F.lit(0).cast("long"), F.least(F.col(size), left))
    return rows.select(
        *[ref(c) for c in kept],
        F.col(size).alias("size"),
        F.col(f"{p}source_size").cast("long").alias("source_size"),
        F.col(f"{p}target").alias("target"),
        (F.col(f"{p}epochs") * F.col(size) + part).alias("taken"),
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The documents of a mix, a row per repetition. A repetition in part, one
    document of a source at most, is a whole one or none, whichever is nearer
    to what is taken: no text is cut."""
    taken, size = F.col("taken"), F.col("size")
    times = F.when(size > 0, F.floor((2 * taken + size) / F.greatest(2 * size, F.lit(1)))).otherwise(F.lit(0))
    p = free_prefix(mixed, "rep")
    rows = mixed.withColumn(f"{p}n", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
    return rows.drop(f"{p}n", "size", "source_size", "target", "taken")
