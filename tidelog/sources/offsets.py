"""Which part of a topic log to read: partitions and start offsets."""

from __future__ import annotations

import json
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.plans.query import DEFAULT_LAST_N, effective_last_n


def select_partitions(
    df: DataFrame, partition: int | str = "all", count: int | None = None
) -> DataFrame:
    """One partition or all of them.

    A number must be a whole number in ``[0..count)``; without ``count`` a
    batch input is asked for its highest partition.
    """
    if isinstance(partition, str):
        if partition != "all":
            raise ValueError(f"invalid partition value: {partition}")
        return df
    if isinstance(partition, bool) or not isinstance(partition, int | float):
        raise TypeError(f"invalid partition type: {type(partition).__name__}")
    if partition != int(partition):
        raise ValueError(f"partition must be an integer, got {partition}")
    if count is None and not df.isStreaming:
        count = (df.agg(F.max("partition").alias("p")).collect()[0]["p"] or 0) + 1
    if partition < 0 or (count is not None and partition >= count):
        raise ValueError(f"partition {partition} out of range [0..{count})")
    return df.filter(F.col("partition") == int(partition))


def offset_bounds(df: DataFrame) -> DataFrame:
    """``earliest`` and ``latest`` (next to be written) offset per partition."""
    return df.groupBy("topic", "partition").agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest")
    )


def last_n(df: DataFrame, n: int = DEFAULT_LAST_N, bounds: DataFrame | None = None) -> DataFrame:
    """Messages with ``offset >= latest - n``, per partition.

    This counts offsets, not rows: gaps in a partition give fewer rows. The
    bounds come from ``df`` unless given (a stream needs them given); they
    reach the driver, a row per partition, and become literals of the scan.
    """
    start = F.greatest(F.col("latest") - effective_last_n(n), F.col("earliest"))
    starts = (bounds if bounds is not None else offset_bounds(df)).select(
        "topic", "partition", start.alias("start")
    )
    return from_offsets(df, {(r["topic"], r["partition"]): r["start"] for r in starts.collect()})


def from_offsets(df: DataFrame, starts: Mapping[tuple[str, int], int]) -> DataFrame:
    """Messages at or after a start offset per (topic, partition); partitions
    without a start are left out. Plain literals, so the scan can skip files."""
    tests = [
        (F.col("topic") == topic) & (F.col("partition") == p) & (F.col("offset") >= start)
        for (topic, p), start in sorted(starts.items())
    ]
    return df.filter(_balanced_or(tests) if tests else F.lit(False))


def _balanced_or(tests):
    if len(tests) <= 2:
        return reduce(lambda a, b: a | b, tests)
    middle = len(tests) // 2
    return _balanced_or(tests[:middle]) | _balanced_or(tests[middle:])


def after_high_water(df: DataFrame, high_water: DataFrame) -> DataFrame:
    """Only messages newer than the bounds of :func:`offset_bounds`; a
    partition unknown then is new as a whole.

    The bounds are fixed here, once: a stream would otherwise look them up
    again for every batch and never see anything new.
    """
    old = [
        (F.col("topic") == r["topic"]) & (F.col("partition") == r["partition"]) & (F.col("offset") < r["latest"])
        for r in high_water.select("topic", "partition", "latest").collect()
    ]
    return df.filter(~_balanced_or(old)) if old else df


def starting_offsets_json(bounds: DataFrame, n: int) -> str:
    """``startingOffsets`` of a Kafka reader for the last ``n`` offsets."""
    start = F.greatest(F.col("latest") - effective_last_n(n), F.col("earliest"))
    rows = bounds.select("topic", "partition", start.alias("start")).collect()
    result: dict[str, dict[str, int]] = {}
    for r in rows:
        result.setdefault(r["topic"], {})[str(r["partition"])] = r["start"]
    return json.dumps(result, sort_keys=True)
