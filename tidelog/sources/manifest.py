"""Topic tables with a manifest.

A table is a folder with ``messages`` (files by append, topic and partition) and
``manifest`` (a numbered file per commit). A commit tells of every file it adds
which topic and partition it holds, how many rows, and between which offsets
and times they lie; a commit without files declares partitions. Only files in
the manifest are part of the table, and a commit is the move of one file to a
number that must be free: readers see an append as a whole or not at all, and
of two writers that started from the same state one has to start again.

Bounds, catalog, partitions and the choice of files come from the manifest, so
that planning a read costs what the manifest costs, whatever the log holds.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.murmur import key_partition
from tidelog.session import stored
from tidelog.sources.files import delete, numbered_files, publish
from tidelog.sources.topic import TOPIC_SCHEMA, TopicNotFound, TopicSource

ZONES = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("first_time", T.TimestampType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField("messages", T.LongType()),
    ]
)
ATTEMPTS = 10
#: Starts of range partitions that are sent to every executor.
STARTS_SENT = 100_000
_LEGAL = re.compile(r"[A-Za-z0-9._-]{1,249}")
_ROW_BITS = (1 << 33) - 1


class CommitConflict(RuntimeError):
    """Other writers were first each time."""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """The commits there are."""
    return numbered_files(spark, f"{path}/manifest")


def _commit(path: str, zones: DataFrame, number: int) -> bool:
    """Publish ``zones`` as commit ``number``; False if that number is taken."""
    typed = zones.select(*[F.col(f.name).cast(f.dataType) for f in ZONES])
    return publish(typed, f"{path}/manifest/{number:020d}.parquet")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: a row per file, and one without a file per declared partition."""
    numbers = _numbers(spark, path)
    if not numbers:
        return spark.createDataFrame([], ZONES)
    return spark.read.schema(ZONES).parquet(*[f"{path}/manifest/{n:020d}.parquet" for n in numbers])


def create_topic(spark: SparkSession, path: str, topic: str, partitions: int) -> None:
    """Declare partitions ``0..partitions-1``; a topic may get more later."""
    if not _LEGAL.fullmatch(topic):
        raise ValueError(f"illegal topic name {topic!r}")
    rows = [(None, topic, p, None, None, None, None, 0) for p in range(partitions)]
    new = spark.createDataFrame(rows, ZONES)
    for _ in range(ATTEMPTS):
        if _commit(path, new, max(_numbers(spark, path), default=-1) + 1):
            return
    raise CommitConflict(f"{ATTEMPTS} attempts on {path}")


def bounds(zone_rows: DataFrame) -> DataFrame:
    """``topic, partition, earliest, latest`` (next to be written) of every
    partition, the empty ones with 0 and 0."""
    return zone_rows.groupBy("topic", "partition").agg(
        F.coalesce(F.min("first_offset"), F.lit(0).cast("bigint")).alias("earliest"),
        F.coalesce(F.max("last_offset") + 1, F.lit(0).cast("bigint")).alias("latest"),
    )


def catalog(zone_rows: DataFrame, prefix: str = "", limit: int = 0) -> DataFrame:
    """Partitions with their bounds, of the topics whose name starts with
    ``prefix``, of the first ``limit`` by name if that is above 0."""
    chosen = zone_rows.filter(F.col("topic").startswith(prefix)) if prefix else zone_rows
    if limit > 0:
        names = chosen.select("topic").distinct().orderBy("topic").limit(limit)
        chosen = chosen.join(names, "topic", "left_semi")
    return chosen.groupBy("topic", "partition").agg(
        F.min("first_offset").alias("first_offset"),
        F.max("last_offset").alias("last_offset"),
        F.sum("messages").alias("messages"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    )


def partitions_of(zone_rows: DataFrame, topic: str) -> list[int]:
    """The partitions of a topic, empty ones too; raises if there is no such topic."""
    found = zone_rows.filter(F.col("topic") == topic).select("partition").distinct().orderBy("partition")
    numbers = [r["partition"] for r in found.collect()]
    if not numbers:
        raise TopicNotFound(f"topic {topic} not found")
    return numbers


def read_files(
    spark: SparkSession,
    path: str,
    topic: str,
    partition: int | str = "all",
    starts: Mapping[int, int] | None = None,
    start_time: datetime | None = None,
    end_time: datetime | None = None,
) -> DataFrame:
    """The messages of a topic from the files that may hold what is asked for.

    ``starts`` are first offsets by partition; a partition without one is left
    out. Whoever asks still has to filter the rows: a file is read as a whole.
    """
    rows = zones(spark, path).filter((F.col("topic") == topic) & F.col("file").isNotNull())
    if partition != "all":
        rows = rows.filter(F.col("partition") == int(partition))
    if start_time is not None:
        rows = rows.filter(F.col("last_time") >= F.lit(start_time))
    if end_time is not None:
        rows = rows.filter(F.col("first_time") <= F.lit(end_time))
    found = rows.select("file", "partition", "last_offset").collect()
    if starts is not None:
        found = [r for r in found if r["partition"] in starts and r["last_offset"] >= starts[r["partition"]]]
    if not found:
        return spark.createDataFrame([], TOPIC_SCHEMA)
    base = f"{path}/messages"
    reader = spark.read.schema(TOPIC_SCHEMA).option("basePath", base)
    columns = [F.col(f.name) for f in TOPIC_SCHEMA]
    return reader.parquet(*[f"{base}/{r['file']}" for r in found]).select(*columns)


def _assigned(df: DataFrame, counts: Mapping[str, int]) -> DataFrame:
    """``df`` with a partition where it has none: by the key, or spread by
    content where there is no key."""
    known = F.create_map(*[F.lit(x) for item in counts.items() for x in item])
    missing = F.raise_error(F.concat(F.lit("topic not found: "), F.coalesce("topic", F.lit("null")))).cast("int")
    count = F.coalesce(F.try_element_at(known, F.col("topic")), missing)
    spread = F.pmod(F.xxhash64("value", "timestamp"), count).cast("int")
    chosen = F.coalesce(key_partition(F.col("key"), count), spread)
    if "partition" in df.columns:
        given = F.col("partition").cast("int")
        wrong = F.raise_error(F.concat(F.lit("no such partition: "), given.cast("string"))).cast("int")
        chosen = F.when(given.isNull(), chosen).when(given.between(0, count - 1), given).otherwise(wrong)
    return df.withColumn("partition", chosen)


def _ranged(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Rows sorted by topic, partition and ``order``, with the range partition
    they are in and their place there. A partition of the topic, however large,
    is as many tasks as its share of the rows."""
    by = [F.col("topic"), F.col("partition"), *order, F.col("_read")]
    read = df.withColumn("_read", F.monotonically_increasing_id())
    ranged = read.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = ranged.withColumn("_part", F.spark_partition_id())
    return placed.withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))).drop("_read")


def _numbered(ranged: DataFrame, high_water: DataFrame) -> DataFrame:
    """Offsets without gaps that go on from ``high_water``: the rows before a
    range partition plus the place inside it."""
    pieces = ranged.groupBy("topic", "partition", "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first")
    )
    # a row per range partition and topic partition that meet
    earlier = F.expr(
        "coalesce(sum(_rows) OVER (PARTITION BY topic, partition ORDER BY _part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    starts = pieces.withColumn("_before", earlier).join(high_water, ["topic", "partition"], "left")
    start = F.coalesce("latest", F.lit(0)) + F.col("_before") - F.col("_first")
    starts = stored(starts.select("topic", "partition", "_part", start.alias("_start")), "starts")
    if starts.count() <= STARTS_SENT:
        starts = F.broadcast(starts)
    rows = ranged.join(starts, ["topic", "partition", "_part"])
    return rows.withColumn("offset", F.col("_start") + F.col("_at"))


def _zones_of(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The zone map of the files of one append."""
    base = f"{path}/messages"
    written = spark.read.schema(TOPIC_SCHEMA).option("basePath", base).parquet(f"{base}/{folder}")
    name = F.substring_index(F.col("_metadata.file_path"), "/messages/", -1)
    return written.groupBy(name.alias("file"), "topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
        F.count(F.lit(1)).alias("messages"),
    )


def append(df: DataFrame, path: str, order: Sequence[str] = ("timestamp",)) -> int:
    """Append ``key, value, topic`` rows to topics of the table; returns the
    number of the commit.

    ``partition`` is taken from the rows or chosen by the key; ``timestamp`` is
    now where there is none. Offsets go on where the partition ends, by
    ``order`` and, among equals, in the order of reading. If another writer
    commits first, offsets are given and files written anew.
    """
    spark = df.sparkSession
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.current_timestamp())
    now = zones(spark, path)
    counts = {r["topic"]: r["n"] for r in now.groupBy("topic").agg((F.max("partition") + 1).alias("n")).collect()}
    if not counts:
        raise TopicNotFound(f"no topics in {path}")
    ranged = stored(_ranged(_assigned(df, counts), [F.col(c) for c in order]), "ranged")
    for _ in range(ATTEMPTS):
        number = max(_numbers(spark, path), default=-1) + 1
        rows = _numbered(ranged, bounds(zones(spark, path)).select("topic", "partition", "latest"))
        folder = f"append={number:020d}-{uuid.uuid4().hex}"
        target = f"{path}/messages/{folder}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in TOPIC_SCHEMA]).write.partitionBy(
            "topic", "partition"
        ).parquet(target)
        if ranged.isEmpty():
            added = spark.createDataFrame([], ZONES)
        else:
            added = _zones_of(spark, path, folder)
        if _commit(path, added, number):
            return number
        delete(spark, target)
    raise CommitConflict(f"{ATTEMPTS} attempts on {path}")


def is_managed(source: object) -> bool:
    return isinstance(source, TopicSource) and source.kind == "managed"
