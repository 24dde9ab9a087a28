"""Topic logs as DataFrames: Kafka, or tables with the Kafka columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


class TopicNotFound(LookupError):
    """The topic has no partitions in this source."""


@dataclass(frozen=True)
class TopicSource:
    """Where topics live.

    ``kafka``: ``options`` are the reader options (``kafka.bootstrap.servers``,
    security settings, …). ``table``: a folder of files with the topic
    columns; writing it ``partitionBy("topic", "partition")`` lets topic and
    partition selection skip whole directories. ``managed``: a folder with a
    manifest, see :mod:`tidelog.sources.manifest`.
    """

    kind: str = "table"
    path: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in ("kafka", "table", "managed"):
            raise ValueError(f"unknown source kind {self.kind!r}")
        if self.kind != "kafka" and not self.path:
            raise ValueError("a table source needs a path")


def as_topic(df: DataFrame) -> DataFrame:
    """Only the topic columns, with their types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TOPIC_SCHEMA])


def read_topic(
    spark: SparkSession,
    source: TopicSource,
    topic: str,
    *,
    stream: bool = False,
    partition: int | str = "all",
    starting_offsets: str = "earliest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """All messages of ``topic``; with ``stream`` the topic is followed.

    ``starting_offsets`` is ``earliest``, ``latest`` or the per-partition JSON
    of :func:`tidelog.sources.offsets.starting_offsets_json`; a table ignores
    it, its start is a filter.
    """
    if source.kind == "managed":
        if stream:
            raise ValueError("a table with a manifest is read in batch; its files alone may hold unfinished appends")
        from tidelog.sources import manifest

        manifest.partitions_of(manifest.zones(spark, source.path), topic)
        return manifest.read_files(spark, source.path, topic, partition)
    extra = {**source.options, **(options or {})}
    reader = spark.readStream if stream else spark.read
    if source.kind == "kafka":
        chosen = (
            {"subscribe": topic}
            if partition == "all"
            else {"assign": f'{{"{topic}":[{int(partition)}]}}'}
        )
        kafka = {
            "kafka.isolation.level": "read_committed",
            "startingOffsets": starting_offsets,
            **extra,
            **chosen,
        }
        return as_topic(reader.format("kafka").options(**kafka).load())
    df = reader.format(source.format).schema(TOPIC_SCHEMA).options(**extra).load(source.path)
    return df.filter(F.col("topic") == topic)


def drop_control_records(df: DataFrame) -> DataFrame:
    """Drop transaction markers: a 4-byte key of version 0 and type 0 or 1
    (abort, commit) with a 6-byte value."""
    marker = F.col("key").isin(bytearray(b"\0\0\0\0"), bytearray(b"\0\0\0\1")) & (
        F.octet_length("value") == 6
    )
    return df.filter(~F.coalesce(marker, F.lit(False)))


def topic_catalog(df: DataFrame, prefix: str = "", limit: int = 0) -> DataFrame:
    """Partitions, offset and time bounds of the topics whose name starts with
    ``prefix``; a ``limit`` above 0 lists only the first so many by name."""
    chosen = df.filter(F.col("topic").startswith(prefix)) if prefix else df
    if limit > 0:
        # at most ``limit`` names reach the driver; as literals they prune the scan
        first = chosen.select("topic").distinct().orderBy("topic").limit(limit).collect()
        chosen = chosen.filter(F.col("topic").isin([r["topic"] for r in first]))
    return chosen.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count(F.lit(1)).alias("messages"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )


def topic_partitions(df: DataFrame, topic: str) -> DataFrame:
    """Partition numbers of one topic; raises when there are none."""
    found = df.filter(F.col("topic") == topic).select("partition").distinct()
    if found.isEmpty():
        raise TopicNotFound(f"topic {topic} not found")
    return found
