"""What dashboards do with the decoded tables: projection, time range,
grouping, reductions and a moving mean."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.columns import message_order, ref
from tidelog.session import stored

# rows whose totals one task of the moving mean adds up
PIECE_ROWS = 4096
#: Ranges of series that are sent to every executor.
RANGES_SENT = 100_000
_ROW_BITS = (1 << 33) - 1


def select_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[ref(n) for n in names])


def time_range(df: DataFrame, start: Column, end: Column, time: str = "time") -> DataFrame:
    """Rows with ``start <= time <= end``."""
    return df.filter(ref(time).between(start, end))


def group_fields(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct combinations of the named columns."""
    return select_fields(df, names).distinct()


def reduce_last(
    df: DataFrame, value: str, by: Sequence[str] = (), order: Sequence[str] = ("time", "partition", "offset")
) -> DataFrame:
    """Latest non-null value by ``order``."""
    kinds = tuple(df.schema[c].dataType.simpleString() for c in order)
    columns = [ref(c) for c in order]
    keys = [ref(c).alias(f"_k{i}") for i, c in enumerate(by)]
    known = ref(value).isNotNull()
    if kinds == ("timestamp", "int", "bigint"):
        # within a partition first, by a number; then among the partitions
        time, partition, offset = columns
        at = F.when(known, message_order(time, offset))
        latest = df.groupBy(*keys, partition.alias("_p")).agg(
            F.max_by(ref(value), at).alias("_v"), F.max(F.when(known, time)).alias("_t"), F.max(at).alias("_at")
        )
        place = F.when(F.col("_at").isNotNull(), F.struct("_t", "_p", "_at"))
        last = latest.groupBy(*[f"_k{i}" for i in range(len(by))]).agg(F.max_by("_v", place).alias("last"))
    else:
        last = df.groupBy(*keys).agg(F.max_by(ref(value), F.when(known, F.struct(*columns))).alias("last"))
    return last.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(by)], "last")


def reduce_mean(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[ref(c) for c in by]).agg(F.avg(ref(value)).alias("mean"))


def footer_sum(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*[ref(c) for c in by]).agg(F.sum(ref(value)).alias("sum"))


def _same(columns: Sequence[str], mark: str) -> Column:
    """Null-safe equality of columns with those of a side renamed by ``mark``."""
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).eqNullSafe(F.col(f"{c}{mark}"))
    return test


def moving_mean(
    df: DataFrame,
    value: str,
    series: Sequence[str],
    order: Sequence[str] = ("time", "partition", "offset"),
    fraction: float = 0.1,
) -> DataFrame:
    """Trailing mean over ``fraction`` of each series' rows (at least one row),
    added as ``moving_mean``; ``order`` must be unique within a series.

    A series is cut into blocks as long as its window. A window is then the
    end of one block and the beginning of the next: two totals that are added,
    so no value is taken off again and none can spoil what follows it. Rows
    are dealt by sampled ranges of series and order and numbered from the
    counts of these, and totals are taken in pieces of ``PIECE_ROWS``, so no
    series is one task. What is shuffled after that are places and totals;
    the rows themselves are joined to their means at the end.
    """
    keys = [f"_k{i}" for i in range(len(series))]
    by_order = [f"_o{i}" for i in range(len(order))]
    base = df.select(
        F.struct(*[ref(c) for c in df.columns]).alias("_own"),
        *[ref(c).alias(k) for c, k in zip(series, keys, strict=True)],
        *[ref(c).alias(o) for c, o in zip(order, by_order, strict=True)],
    )
    ranged = base.repartitionByRange(*keys, *by_order).sortWithinPartitions(*keys, *by_order)
    ranged = ranged.select(
        "_own",
        *keys,
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("_idx"),
    )
    ranged = stored(ranged, "series")
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per series and range that meet
    ranges = ranged.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_idx").alias("_first"))
    ranges = ranges.select(
        *[F.col(c).alias(f"{c}_r") for c in (*keys, "_part")],
        F.sum("_rows").over(whole).alias("_n"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    ranges = stored(ranges, "ranges")
    if ranges.count() <= RANGES_SENT:
        ranges = F.broadcast(ranges)
    own = F.col("_own").getField(value)
    rows = ranged.select(
        *keys, "_part", "_idx",
        F.coalesce(own.cast("double"), F.lit(0.0)).alias("_v"),
        F.when(own.isNotNull(), 1).otherwise(0).cast("bigint").alias("_c"),
    )
    rows = rows.join(ranges, _same([*keys, "_part"], "_r"))
    rows = rows.withColumn("_at", F.col("_idx") + F.col("_shift"))
    rows = rows.withColumn("_w", F.greatest(F.lit(1), F.round(F.col("_n") * fraction).cast("bigint")))
    rows = rows.select(
        *keys, "_part", "_idx", "_at", "_w", "_n", "_v", "_c",
        F.expr("_at div _w").alias("_block"), (F.col("_at") % F.col("_w")).alias("_place"),
    ).withColumn("_piece", F.floor(F.col("_place") / PIECE_ROWS))
    pieces = rows.groupBy(*keys, "_block", "_piece").agg(F.sum("_v").alias("_pv"), F.sum("_c").alias("_pc"))
    block = Window.partitionBy(*keys, "_block").orderBy("_piece")
    ahead, behind = block.rowsBetween(Window.unboundedPreceding, -1), block.rowsBetween(1, Window.unboundedFollowing)
    pieces = pieces.select(
        *[F.col(c).alias(f"{c}_r") for c in (*keys, "_block", "_piece")],
        *[
            F.coalesce(F.sum(c).over(side), F.lit(0)).alias(f"{c}{name}")
            for c in ("_pv", "_pc")
            for side, name in ((ahead, "_a"), (behind, "_b"))
        ],
    )
    # both ways from the beginning of the frame: a frame to its end adds up anew for every row
    piece = Window.partitionBy(*keys, "_block", "_piece")
    for c in ("_v", "_c"):
        for name, way in (("p", F.col("_at").asc()), ("s", F.col("_at").desc())):
            frame = piece.orderBy(way).rowsBetween(Window.unboundedPreceding, 0)
            rows = rows.withColumn(f"{c}{name}", F.sum(c).over(frame))
    rows = rows.join(pieces, _same([*keys, "_block", "_piece"], "_r"))
    told = rows.select(
        *keys, "_part", "_idx", "_at", "_w", "_n", "_place",
        (F.col("_pv_a") + F.col("_vp")).alias("_start_v"), (F.col("_pc_a") + F.col("_cp")).alias("_start_c"),
        (F.col("_vs") + F.col("_pv_b")).alias("_end_v"), (F.col("_cs") + F.col("_pc_b")).alias("_end_c"),
    )
    # a row's end of its block is wanted by the row that closes the window it opens
    wanted = (F.col("_place") > 0) & (F.col("_at") + F.col("_w") <= F.col("_n"))
    mine = told.select(*keys, "_at", "_part", "_idx", *[F.col(f"_start{x}").alias(x) for x in ("_v", "_c")])
    sent = told.filter(wanted).select(
        *keys, (F.col("_at") + F.col("_w") - 1).alias("_at"),
        F.lit(None).cast("int").alias("_part"), F.lit(None).cast("bigint").alias("_idx"),
        *[F.col(f"_end{x}").alias(x) for x in ("_v", "_c")],
    )
    means = (
        mine.unionByName(sent)
        .groupBy(*keys, "_at")
        .agg(F.max("_part").alias("_part"), F.max("_idx").alias("_idx"), F.sum("_v").alias("_v"), F.sum("_c").alias("_c"))
        .select("_part", "_idx", F.when(F.col("_c") > 0, F.col("_v") / F.col("_c")).alias("moving_mean"))
    )
    return ranged.join(means, ["_part", "_idx"]).select("_own.*", "moving_mean")
