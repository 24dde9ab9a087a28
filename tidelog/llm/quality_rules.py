"""Quality rules by cross-document line frequency.

Normalised lines are hashed, and for every host the distinct documents that
hold a line are counted (equal texts count once). Lines in more than
``line_share`` of the documents of their host, and in more than ``line_docs``
of them, are boilerplate: they are removed, and a document of whose words too
few are left is rejected. Before that come base rules of the text alone. All
of it is native; what is shuffled is hashes and counts, never text.

A share grows with its host: in a large one a line may stand in thousands of
documents and stay. ``line_most`` is the limit for that, joined by OR: a line
in more documents of its host goes whatever its share. No bound on the lines
of a host follows from it, so these lines are looked up by document in
salted joins, and the text is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import SPACE, SPACES, free_prefix, looked_up, ref, text_of, words_of
from tidelog.session import stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 0.5
#: A line is removed above this share of its host's documents ...
LINE_SHARE = 0.05
#: ... and above this number of them.
LINE_DOCS = 10
#: Where it is asked for: above this number of them a line is removed whatever its share.
LINE_MOST = 100
#: A document is depleted if a smaller share of its words than this is left.
MIN_LEFT = 0.3

#: A position and so many bits of a hash are one long.
_POSITION_BITS = 31
_HASH_BITS = 33
#: Parts of a line's documents, and of the copies of a text, where lines are looked up.
_PARTS = 16


def _covered(positions: Column, width: int) -> Column:
    """Words under windows of ``width`` that start at the sorted positions."""
    following = F.concat(
        F.slice(positions, 2, F.greatest(F.size(positions), F.lit(1))),
        F.array(F.lit(1 << 40).cast("long")),
    )
    gaps = F.zip_with(positions, following, lambda a, b: F.least(b - a, F.lit(width).cast("long")))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)
    return F.when(F.size(positions) > 0, total).otherwise(F.lit(0).cast("long"))


def with_repeated_words(df: DataFrame, words: str, result: str) -> DataFrame:
    """Add the number of words inside 3-word windows that occur twice or more.

    Some bits of a window's hash and its position are one long, so that sorting
    is a primitive sort. Windows whose bits meet, few in most texts, are then
    sorted by their words. Each step is a column of its own, as lambdas read
    the sorted array many times.
    """
    p = free_prefix(df, "rep")
    n, w = F.size(words), F.col(words)
    hashed, likely, grams, at = (f"{p}{x}" for x in ("hashed", "likely", "grams", "at"))

    def packed(i: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), 64 - _HASH_BITS)
        return F.shiftleft(bits, _POSITION_BITS).bitwiseOR(i.cast("long"))

    def repeats(ordered: Column, of) -> Column:
        def same(x: Column, y: Column) -> Column:
            return F.coalesce(of(x) == of(y), F.lit(False))

        return F.filter(
            ordered,
            lambda x, i: ((i > 0) & same(x, F.get(ordered, i - 1))) | same(x, F.get(ordered, i + 1)),
        )

    def gram(x: Column) -> Column:
        i = x.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).cast("int")
        return F.struct(F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.cast("long").alias("p"))

    df = df.withColumn(hashed, F.when(n > 3, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), packed))))
    df = df.withColumn(likely, repeats(F.col(hashed), lambda x: F.shiftright(x, _POSITION_BITS)))
    df = df.withColumn(grams, F.sort_array(F.transform(F.col(likely), gram)))
    df = df.withColumn(at, F.sort_array(F.transform(repeats(F.col(grams), lambda x: x["g"]), lambda x: x["p"])))
    df = df.withColumn(result, F.coalesce(_covered(F.col(at), 3), F.lit(0).cast("long")))
    return df.drop(hashed, likely, grams, at)


def _normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def _without(text: Column, gone: Column) -> Column:
    """The text without the lines whose hashes are in ``gone``."""
    kept = F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(gone, F.xxhash64(_normalised(x))))
    return F.array_join(kept, "\n")


def _line_hashes(text: Column) -> Column:
    """Hash and words of each line with a word; case and spacing do not count."""
    plain = F.transform(F.split(text, "\n"), _normalised)
    return F.transform(
        F.filter(plain, lambda x: x != ""),
        lambda x: F.struct(F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1).alias("n")),
    )


def _of_document(host_col: str, text_col: str) -> list[Column]:
    """Host and digests that stand for a document: ``host``, ``none``, ``a``, ``b``."""
    return [
        F.coalesce(ref(host_col).cast("string"), F.lit("")).alias("host"),
        ref(host_col).isNull().alias("none"),
        F.xxhash64(text_of(text_col)).alias("a"),
        F.crc32(text_of(text_col)).alias("b"),
    ]


def _distinct_lines(text_col: str) -> Column:
    return F.array_distinct(F.transform(_line_hashes(text_of(text_col)), lambda x: x["h"]))


def _boilerplate(
    docs: DataFrame, host_col: str, text_col: str, line_share: float, line_docs: int, line_most: int | None
) -> DataFrame:
    """The lines that go: ``host``, ``none``, ``line``."""
    once = (
        docs.select(*_of_document(host_col, text_col), _distinct_lines(text_col).alias("lines"))
        .groupBy("host", "none", "a", "b")
        .agg(F.first("lines").alias("lines"))
    )
    # the documents of a host are counted beside its lines, as a line of their own
    counted = (
        once.select("host", "none", F.explode(F.concat(F.array(F.lit(None).cast("long")), "lines")).alias("line"))
        .groupBy("host", "none", "line")
        .agg(F.count(F.lit(1)).alias("docs"))
    )
    least = line_docs if line_most is None else min(line_docs, line_most)
    often = counted.where((F.col("docs") > least) | F.col("line").isNull())
    hosts = often.where("line IS NULL").select("host", "none", F.col("docs").alias("all_docs"))
    gone = (F.col("docs") > line_docs) & (F.col("docs") > F.lit(float(line_share)) * F.col("all_docs"))
    if line_most is not None:
        gone = gone | (F.col("docs") > line_most)
    return often.where("line IS NOT NULL").join(hosts, ["host", "none"]).where(gone).select("host", "none", "line")


def removed_lines(
    docs: DataFrame, host_col: str, text_col: str, line_share=LINE_SHARE, line_docs=LINE_DOCS
) -> DataFrame:
    """The hashes of boilerplate lines of each host: ``host``, ``none``, ``removed``.

    At most (mean lines of a document) / ``line_share`` lines of a host can
    pass, so the arrays are short whatever the corpus.
    """
    gone = _boilerplate(docs, host_col, text_col, line_share, line_docs, None)
    return gone.groupBy("host", "none").agg(F.sort_array(F.collect_set("line")).alias("removed"))


def _part(docs: DataFrame) -> Column:
    """A part for each row from all its plain columns, so that copies of a text are spread."""
    plain = [n for n, t in docs.dtypes if not t.startswith(("array", "map", "struct", "variant"))]
    return F.pmod(F.xxhash64(*[ref(n) for n in plain]), F.lit(_PARTS)).cast("int")


def removed_by_document(
    docs: DataFrame, host_col: str, text_col: str, line_share: float, line_docs: int, line_most: int
) -> DataFrame:
    """The hashes of boilerplate lines of each document that has some, once
    for each part its rows are in: ``host``, ``none``, ``a``, ``b``, ``part``,
    ``removed``, and ``removed_words``, with repetitions. An array is no longer
    than its document."""
    gone = stored(_boilerplate(docs, host_col, text_col, line_share, line_docs, line_most), "lines")
    parts = F.array(*[F.lit(i) for i in range(_PARTS)])
    document = ["host", "none", "a", "b", "part"]
    held = (
        docs.select(
            *_of_document(host_col, text_col), _part(docs).alias("part"), _line_hashes(text_of(text_col)).alias("lines")
        )
        .groupBy(*document)
        .agg(F.first("lines").alias("lines"))
        .select(*document, F.inline("lines").alias("line", "n"))
        .withColumn("slice", F.pmod("a", F.lit(_PARTS)).cast("int"))
    )
    return (
        held.join(gone.withColumn("slice", F.explode(parts)), ["host", "none", "line", "slice"])
        .groupBy(*document)
        .agg(F.sort_array(F.collect_set("line")).alias("removed"), F.sum("n").alias("removed_words"))
    )


def judge(
    docs: DataFrame,
    host_col: str = "source",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    max_repeated: float = MAX_REPEATED,
    line_share: float = LINE_SHARE,
    line_docs: int = LINE_DOCS,
    min_left: float = MIN_LEFT,
    line_most: int | None = None,
) -> DataFrame:
    """``docs`` with base measures, ``base_failed``, ``left_words``, ``kept`` and
    ``clean_text``, the text without boilerplate lines.

    Null and empty texts have no words and fail the base rules. Null hosts are
    one host. Equal texts count as one document and get one verdict; repeated
    rows stay rows. Columns with the name of a result give way to it. With
    ``line_most`` lines in more documents of their host go too.
    """
    p = free_prefix(docs, "rule")
    results = (
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"),
        *("left_words", "kept", "clean_text"),
    )
    kept = [c for c in docs.columns if c not in results]
    words = f"{p}words"
    text = text_of(text_col)
    if line_most is None:
        removed = stored(removed_lines(docs, host_col, text_col, line_share, line_docs), "lines")
        by = _of_document(host_col, text_col)[:2]
    else:
        removed = removed_by_document(docs, host_col, text_col, line_share, line_docs, line_most)
        by = [*_of_document(host_col, text_col), _part(docs).alias("part")]
    on = [c for c in removed.columns if not c.startswith("removed")]
    removed = removed.select(*[F.col(c).alias(f"{p}{c}") for c in removed.columns])
    rows = docs.select(*[ref(c) for c in kept], *[c.alias(f"{p}{n}") for n, c in zip(on, by, strict=True)])
    rows = with_repeated_words(rows.withColumn(words, words_of(text)), words, f"{p}repeated")
    spoken = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    gone = F.col(f"{p}removed")
    measures = [
        F.size(words).cast("long").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(spoken) - F.size(F.array_distinct(spoken))).cast("long").alias("n_dup_lines"),
        F.col(f"{p}repeated").alias("n_repeat_words"),
    ]
    if line_most is None:
        rows = looked_up(rows, removed, [f"{p}{c}" for c in on])
        left = F.aggregate(
            _line_hashes(text),
            F.lit(0).cast("long"),
            lambda s, x: s + F.when(F.array_contains(gone, x["h"]), F.lit(0)).otherwise(x["n"]).cast("long"),
        )
        left = F.when(gone.isNull(), F.size(words).cast("long")).otherwise(left)
    else:
        # measured before the join: only who wants the clean text sends the text
        rows = rows.select(*[ref(c) for c in kept], *[F.col(f"{p}{c}") for c in on], *measures)
        rows = rows.join(removed, [f"{p}{c}" for c in on], "left")
        measures = [F.col(n) for n in results[:5]]
        left = F.col("n_words") - F.coalesce(F.col(f"{p}removed_words"), F.lit(0).cast("long"))
    rows = rows.select(
        *[ref(c) for c in kept],
        *measures,
        left.alias("left_words"),
        F.when(gone.isNull(), ref(text_col)).otherwise(_without(text, gone)).alias("clean_text"),
    )
    failed = (F.col("n_words") < min_words) | (
        F.col("n_repeat_words") > F.lit(float(max_repeated)) * F.col("n_words")
    )
    enough = F.col("left_words") >= F.lit(float(min_left)) * F.col("n_words")
    rows = rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)
    # a filter on the verdict must not be moved below the measures, where it
    # would evaluate their sorted arrays inside lambdas; row numbers are a fence
    fence = F.monotonically_increasing_id() >= 0
    return rows.withColumn("kept", F.col("kept") & fence)
