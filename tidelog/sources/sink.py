"""Where rows go: a topic (Kafka or a topic table) or a result table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.sources import manifest
from tidelog.sources.topic import TopicSource


def write_topic(df: DataFrame, target: TopicSource, topic: str | None = None) -> None:
    """Append ``key, value`` rows to a topic.

    A managed table chooses partitions and gives offsets and times itself, as
    a broker does. A plain topic table needs ``partition, offset, timestamp``;
    it is laid out by topic and partition, so that selecting them skips
    directories.
    """
    named = df if topic is None else df.withColumn("topic", F.lit(topic))
    if target.kind == "managed":
        manifest.append(named, target.path)
        return
    if target.kind == "kafka":
        columns = [c for c in ("key", "value", "topic", "partition") if c in named.columns]
        named.select(*columns).write.format("kafka").options(**target.options).save()
        return
    (
        named.select("key", "value", "topic", "partition", "offset", "timestamp")
        .write.format(target.format)
        .options(**target.options)
        .mode("append")
        .partitionBy("topic", "partition")
        .save(target.path)
    )
