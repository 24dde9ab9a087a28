"""What a stream has learned about the fields of its topic.

A registry is a small table: the types a path was seen with, first and last
place, and the same for tag keys of line protocol. Each batch adds what it saw,
reduced to a row per path and type, and the table after it is published in one
step under the number of the batch. A batch that is repeated starts from the
table before it, so it adds nothing twice; after a restart the last table goes
on. Two batches give the registry that one batch of both gives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import variants as V
from tidelog.operators.flatten import FlattenOptions, text_leaves
from tidelog.operators.infer import resolved_fields
from tidelog.operators.lineprotocol import LineOptions, filtered_lines
from tidelog.operators.wide import FieldSpec
from tidelog.sources.files import numbered_files, publish

#: Places are ordered by time, partition, offset, line and position in it.
PLACE = "struct<time:timestamp,partition:int,offset:bigint,line:int,position:int>"
REGISTRY = f"kind string, name string, type string, depth int, messages long, first {PLACE}, last {PLACE}"
FIELD, TAG = "field", "tag"


def _place(line, position):
    return F.struct(
        F.col("timestamp").alias("time"), F.col("partition"), F.col("offset"), line.cast("int").alias("line"),
        position.cast("int").alias("position"),
    ).cast(PLACE)


def _seen(rows: DataFrame) -> DataFrame:
    """``kind, name, type, depth, at`` to the rows of a registry."""
    return rows.groupBy("kind", "name", "type", "depth").agg(
        F.count(F.lit(1)).alias("messages"), F.min("at").alias("first"), F.max("at").alias("last")
    )


def fields_seen(messages: DataFrame, value: str = "value", options: FlattenOptions = FlattenOptions()) -> DataFrame:
    """The fields of some messages as registry rows."""
    none = F.lit(0)
    leaves = messages.select("timestamp", "partition", "offset", F.inline_outer(text_leaves(F.col(value), options)).alias("path", "depth", "node"))
    rows = leaves.filter(F.col("path").isNotNull()).select(
        F.lit(FIELD).alias("kind"), F.col("path").alias("name"), V.leaf_type(F.col("node")).alias("type"), "depth",
        _place(none, none).alias("at"),
    )
    return _seen(rows)


def tags_seen(messages: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """The tag keys of some line-protocol messages as registry rows."""
    lines = filtered_lines(messages, options).filter(F.size("tags") > 0)
    keys = lines.select("timestamp", "partition", "offset", "line", F.posexplode(F.map_keys("tags")).alias("position", "key"))
    rows = keys.select(
        F.lit(TAG).alias("kind"), F.col("key").alias("name"), F.lit("string").alias("type"), F.lit(1).alias("depth"),
        _place(F.col("line"), F.col("position")).alias("at"),
    )
    return _seen(rows)


def merged(*registries: DataFrame) -> DataFrame:
    """Registries of parts of a topic as one."""
    rows = registries[0]
    for other in registries[1:]:
        rows = rows.unionByName(other)
    return rows.groupBy("kind", "name", "type", "depth").agg(
        F.sum("messages").alias("messages"), F.min("first").alias("first"), F.max("last").alias("last")
    )


class FieldRegistry:
    """The registry of one stream, kept in ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _file(self, number: int) -> str:
        return f"{self.path}/{number:020d}.parquet"

    def rows(self, before: int | None = None) -> DataFrame:
        """The registry now, or as it was before a batch."""
        known = [n for n in numbered_files(self.spark, self.path) if before is None or n < before]
        if not known:
            return self.spark.createDataFrame([], REGISTRY)
        return self.spark.read.schema(REGISTRY).parquet(self._file(known[-1]))

    def add(self, seen: DataFrame, number: int) -> None:
        """Add what batch ``number`` saw; a batch that is known changes nothing."""
        if number in numbered_files(self.spark, self.path):
            return
        publish(merged(self.rows(before=number), seen), self._file(number))

    def fields(self) -> list[FieldSpec]:
        """The columns of the wide shape, as :func:`infer_fields` gives them."""
        stats = self.rows().filter(F.col("kind") == FIELD).select(
            F.col("name").alias("path"), F.col("type").alias("kind"), "depth", F.col("messages").alias("rows"), "last"
        )
        found = resolved_fields(stats).orderBy("path").collect()
        return [FieldSpec(r["path"], r["type"], r["mixed"], tuple(r["depths"])) for r in found]

    def tag_keys(self, cap: int | None = None) -> list[str]:
        """Tag keys in first-seen order."""
        rows = self.rows().filter(F.col("kind") == TAG).groupBy("name").agg(F.min("first").alias("first")).orderBy("first")
        return [r["name"] for r in (rows.limit(cap) if cap else rows).collect()]


def registering(
    registry: FieldRegistry,
    seen: Callable[[DataFrame], DataFrame],
    then: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` of a stream of messages calls: the batch goes into the
    registry first, so that ``then`` finds all its columns there."""

    def write(batch: DataFrame, number: int) -> None:
        registry.add(seen(batch), number)
        if then is not None:
            then(batch, number)

    return write
