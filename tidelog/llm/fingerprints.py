"""Document fingerprints by winnowing.

The pieces of a text are its code points without white space. At every piece
the run of ``GRAM`` pieces is hashed, and of each ``WINDOW`` consecutive hashes
the smallest is selected, the rightmost of equal ones, together with its
position. Texts that share ``GRAM + WINDOW - 1`` = 47 code points in a row,
white space not counted, share a selected hash, wherever the passage begins
and in whatever script. All grams come from one pass of a pattern that looks
``gram`` code points ahead and moves on by one. Native column expressions
throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import SPACES, free_prefix, looked_up, ref, text_of
from tidelog.session import stored

PIECE = r"[^\x20\x09-\x0D]"
GRAM = 16
WINDOW = 32
_LOW = (1 << 31) - 1


def with_fingerprint(df: DataFrame, text: str, result: str, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Add the selected hashes and positions of a text as an array of longs.

    The high bits are 32 bits of the hash, the low 31 bits the position,
    counted down so that the smallest long of a window is its rightmost
    minimum. Minima of windows are taken of two overlapping shorter ones, each
    step a column of its own. A text of at most ``gram`` pieces is one gram; one
    without pieces has an empty fingerprint.
    """
    p = free_prefix(df, "fp")
    bare, hashed, lowest = f"{p}bare", f"{p}hashed", f"{p}lowest"
    df = df.withColumn(bare, F.translate(text, SPACES, ""))
    ahead = F.lit(rf"(?s)(?=(.{{{gram}}})).")
    grams = F.when(F.char_length(bare) > gram, F.regexp_extract_all(bare, ahead, F.lit(1))).when(
        F.col(bare) != "", F.array(bare)
    )

    def place(piece: Column, i: Column) -> Column:
        return F.shiftleft(F.shiftrightunsigned(F.xxhash64(piece), 32), 31).bitwiseOR(F.lit(_LOW) - i.cast("long"))

    df = df.withColumn(hashed, F.coalesce(F.transform(grams, place), F.array().cast("array<bigint>")))
    df = df.withColumn(lowest, F.col(hashed))
    width = 1
    while width < window:
        step = min(width, window - width)
        after = F.slice(lowest, step + 1, F.greatest(F.size(lowest), F.lit(1)))
        df = df.withColumn(lowest, F.zip_with(lowest, after, lambda a, b: F.least(a, b)))
        width += step
    minima = F.slice(lowest, 1, F.greatest(F.size(hashed) - window + 1, F.lit(1)))
    df = df.withColumn(lowest, F.array_distinct(minima))
    return df.withColumn(result, F.col(lowest)).drop(bare, hashed, lowest)


def with_edited_fingerprint(
    df: DataFrame, own: str, head: Column, tail: Column, result: str, gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """Add what ``with_fingerprint`` gives for ``head`` and ``tail`` together,
    where ``own`` is the fingerprint of a text that starts with ``head``.

    What all its windows inside ``head`` select is the same in both texts;
    only the end of ``head`` and ``tail`` are hashed.
    """
    p = free_prefix(df, "ed")
    bare, first, keep, rest, late = (f"{p}{x}" for x in ("bare", "first", "keep", "rest", "late"))
    df = df.withColumn(bare, F.translate(head, SPACES, ""))
    grams = F.char_length(bare) - gram + 1
    df = df.withColumn(first, F.greatest(grams - 2 * window + 1, F.lit(0)).cast("long"))
    df = df.withColumn(keep, F.when(F.col(first) > 0, grams - window).otherwise(F.lit(-1)).cast("long"))
    df = df.withColumn(rest, F.concat(F.substr(F.col(bare), F.col(first).cast("int") + 1), tail))
    df = with_fingerprint(df, rest, late, gram, window)

    def place(x: Column) -> Column:
        return F.lit(_LOW) - x.bitwiseAND(F.lit(_LOW).cast("long"))

    before = F.filter(own, lambda x: place(x) <= F.col(keep))
    after = F.filter(F.transform(late, lambda x: x - F.col(first)), lambda x: place(x) > F.col(keep))
    return df.withColumn(result, F.concat(before, after)).drop(bare, first, keep, rest, late)


def hashes_of(selected: Column) -> Column:
    return F.array_distinct(F.transform(selected, lambda x: F.shiftright(x, 31)))


def shown(selected: Column) -> Column:
    """A fingerprint as text: hash and position of each selected gram in hex."""
    return F.array_join(F.transform(selected, lambda x: F.hex(x.bitwiseXOR(F.lit(_LOW)))), ",")


def read_shown(fingerprint: str) -> list[tuple[int, int]]:
    """(hash, position) pairs of a fingerprint that ``shown`` wrote."""
    pairs = [int(x, 16) for x in fingerprint.split(",") if x]
    return [(x >> 31, x & _LOW) for x in pairs]


def likeness(a: Column, b: Column) -> Column:
    """Common hashes over all hashes; two empty sets are alike."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - common
    return F.when(every == 0, F.lit(1.0)).otherwise(common / F.greatest(every, F.lit(1)))


def _next_in_order(texts: DataFrame, key: str, digest: str, id_col: str, need: str, p: str) -> DataFrame:
    """``key, digest, need`` of each text with ``next_key, next_digest``, by
    falling id; after the last comes the first.

    Range partitions are fixed by writing them; inside each the next row is
    read off, and only the first row of each partition crosses to another.
    """
    order = [F.col(id_col).desc_nulls_last(), F.col(digest)]
    ranged = stored(
        texts.select(id_col, key, digest, need)
        .distinct()
        .repartitionByRange(*order)
        .withColumn(f"{p}part", F.spark_partition_id()),
        "order",
    )
    inside = Window.partitionBy(f"{p}part").orderBy(*order)
    this = F.struct(F.col(key).alias("k"), F.col(digest).alias("d"))
    ranged = ranged.withColumn(f"{p}next", F.lead(this).over(inside))
    ranged = ranged.withColumn(f"{p}first", F.row_number().over(inside) == 1)
    heads = ranged.where(f"{p}first").select(f"{p}part", this.alias(f"{p}head"))
    # one row per range partition
    by_part = Window.orderBy(f"{p}part")
    heads = heads.withColumn(
        f"{p}over",
        F.coalesce(
            F.lead(f"{p}head").over(by_part),
            F.first(f"{p}head").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ),
    ).select(f"{p}part", f"{p}over")
    after = F.coalesce(f"{p}next", f"{p}over")
    linked = looked_up(ranged, heads, [f"{p}part"]).withColumn(f"{p}after", after)
    return linked.select(
        key, digest, need, F.col(f"{p}after.k").alias(f"{p}next_key"), F.col(f"{p}after.d").alias(f"{p}next_digest")
    )


def fingerprint(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """``docs`` with ``n_chars``, ``fingerprint`` and their likenesses to an
    edited text and to the next document.

    The edited text has its last third taken from the start of the next
    document. Null texts are empty. Documents follow by falling id, null last;
    different texts with one id by their MD5, and a repeated row counts once
    in that order but keeps its place in the result. A single document is its
    own next. Columns with the name of a result give way to it.
    """
    p = free_prefix(docs, "win")
    results = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    kept = [c for c in docs.columns if c not in results]
    key, digest, text, chars = f"{p}key", f"{p}digest", f"{p}text", f"{p}chars"
    keyed = [
        F.coalesce(ref(id_col).cast("string"), F.lit("")).alias(key),
        F.unhex(F.md5(text_of(text_col))).alias(digest),
    ]
    need = F.floor(F.char_length(text_of(text_col)) / 3).cast("int").alias(f"{p}need")
    given_order = docs.select(ref(id_col).alias(f"{p}id"), *keyed, need)
    order = _next_in_order(given_order, key, digest, f"{p}id", f"{p}need", p)
    # an integer id follows from its key; without it the rows are those that gave the starts, shuffled once
    whole = docs.schema[id_col].dataType
    derived = isinstance(whole, T.IntegralType)
    carried = [c for c in kept if not (derived and c == id_col)]
    texts = docs.select(*[ref(c) for c in carried], *keyed, text_of(text_col).alias(text))
    asked = order.select(
        F.col(key).alias(f"{p}for_key"),
        F.col(digest).alias(f"{p}for_digest"),
        F.col(f"{p}need"),
        F.col(f"{p}next_key").alias(key),
        F.col(f"{p}next_digest").alias(digest),
    )
    edited, own, new = f"{p}edited", f"{p}own", f"{p}new"
    # hashed before the shuffle, once for the rows and for those they follow
    texts = with_fingerprint(texts, text, own, gram, window)
    given = texts.select(key, digest, text, own).join(asked, [key, digest])
    given = given.select(
        F.col(f"{p}for_key").alias(key),
        F.col(f"{p}for_digest").alias(digest),
        F.col(f"{p}need"),
        F.substring(F.col(text), F.lit(1), F.col(f"{p}need")).alias(f"{p}start"),
        F.transform(hashes_of(F.col(own)), lambda x: (x - F.lit(1 << 31)).cast("int")).alias(f"{p}hashes"),
    )
    # a next document that is repeated gives the same answer several times
    given = given.groupBy(key, digest).agg(
        *[F.first(c).alias(c) for c in (f"{p}need", f"{p}start", f"{p}hashes")]
    )
    rows = texts.join(given, [key, digest])
    rows = rows.withColumn(chars, F.char_length(text))
    head = F.substring(F.col(text), F.lit(1), F.col(chars) - F.col(f"{p}need"))
    rows = rows.withColumn(edited, F.concat(head, F.col(f"{p}start")))
    rows = with_edited_fingerprint(rows, own, head, F.col(f"{p}start"), new, gram, window)
    rows = rows.withColumn(f"{p}own_hashes", hashes_of(F.col(own)))
    following = F.transform(f"{p}hashes", lambda x: x.cast("long") + F.lit(1 << 31))
    same = F.when(F.col(key) != "", F.col(key)).cast(whole).alias(id_col)
    return rows.select(
        *[ref(c) if c in carried else same for c in kept],
        F.col(chars).cast("long").alias("n_chars"),
        F.sha2(edited, 256).alias("edited_sha256"),
        shown(F.col(own)).alias("fingerprint"),
        shown(F.col(new)).alias("edited_fingerprint"),
        likeness(F.col(f"{p}own_hashes"), hashes_of(F.col(new))).alias("near_edited"),
        likeness(F.col(f"{p}own_hashes"), following).alias("near_next"),
    )
