"""Following a topic: the batch operators on a streaming source."""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.decode import split_errors
from tidelog.operators.wide import FieldSpec
from tidelog.plans.query import TopicQuery
from tidelog.plans.run import run
from tidelog.session import configure
from tidelog.sources.offsets import after_high_water, offset_bounds, starting_offsets_json
from tidelog.sources.topic import TopicSource, read_topic
from tidelog.streaming.journal import journal


@dataclass(frozen=True)
class StreamOptions:
    """Bounds of one flush and where the stream keeps its progress.

    ``checkpoint_root`` must be shared storage on a cluster. Each query gets
    its own folder, named by a hash of all its settings and its sink: changing
    any of them starts a new stream.
    """

    checkpoint_root: str
    processing_time: str | None = None
    available_now: bool = False
    max_offsets: int | None = None
    max_files: int | None = None

    def checkpoint(self, query: TopicQuery, sink: str = "") -> str:
        mark = hashlib.sha256(sink.encode()).hexdigest()[:8]
        name = f"{query.topic}-{query.fingerprint()}-{mark}"
        return posixpath.join(self.checkpoint_root, name)


def stream_frame(
    spark: SparkSession,
    query: TopicQuery,
    source: TopicSource,
    *,
    fields: Sequence[FieldSpec] | None = None,
    key_fields: Sequence[FieldSpec] | None = None,
    tag_keys: Sequence[str] | None = None,
    schemas: DataFrame | None = None,
    high_water: DataFrame | None = None,
    options: StreamOptions | None = None,
) -> DataFrame:
    """The streaming DataFrame of ``query``.

    ``high_water`` holds the offset bounds to start from (``latest`` and
    ``last_n``); for a table they are taken now if not given. Columns are
    fixed at the start; other paths are in the long shape.
    """
    configure(spark)
    limits = {}
    if options and options.max_offsets and source.kind == "kafka":
        limits["maxOffsetsPerTrigger"] = str(options.max_offsets)
    if options and options.max_files and source.kind == "table":
        limits["maxFilesPerTrigger"] = str(options.max_files)
    starting = query.offset if query.offset in ("earliest", "latest") else "earliest"
    if source.kind == "kafka" and query.offset == "last_n":
        if high_water is None:
            raise ValueError("last_n on Kafka needs the offset bounds")
        starting = starting_offsets_json(high_water, query.last_n)
    messages = read_topic(
        spark, source, query.topic, stream=True,
        partition=query.partition, starting_offsets=starting, options=limits,
    )
    bounds = high_water if query.offset == "last_n" else None
    if source.kind == "table" and query.offset != "earliest":
        bounds = high_water
        if bounds is None:
            bounds = offset_bounds(read_topic(spark, source, query.topic))
        if query.offset == "latest":
            messages = after_high_water(messages, bounds)
            bounds = None
    return run(
        spark, query, messages, fields=fields, key_fields=key_fields, tag_keys=tag_keys,
        schemas=schemas, bounds=bounds,
    )


def start_stream(
    df: DataFrame,
    query: TopicQuery,
    options: StreamOptions,
    *,
    path: str | None = None,
    table: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    errors: Callable[[DataFrame, int], None] | None = None,
    journal_path: str | None = None,
    format: str = "parquet",
) -> StreamingQuery:
    """Append rows continuously to files, an in-memory table, a journal or a
    function.

    A journal holds good and error rows under one commit, see
    :mod:`tidelog.streaming.journal`; its stream is called by the query's
    fingerprint. ``errors`` gets the failed messages of each batch and the main
    sink the good ones; these two functions are no commit together. Failures of
    the source are retried by Spark or surface through
    ``StreamingQuery.exception``.
    """
    sink = path or table or (f"journal:{journal_path}" if journal_path else "function")
    writer = df.writeStream.outputMode("append").option("checkpointLocation", options.checkpoint(query, sink))
    if options.available_now:
        writer = writer.trigger(availableNow=True)
    elif options.processing_time:
        writer = writer.trigger(processingTime=options.processing_time)
    if journal_path is not None:
        return writer.foreachBatch(journal(journal_path, query.fingerprint())).start()
    if errors is not None:
        if each_batch is None:
            raise ValueError("an error sink needs each_batch for the good rows")

        def both(batch: DataFrame, number: int) -> None:
            good, bad = split_errors(batch)
            each_batch(good, number)
            errors(bad, number)

        return writer.foreachBatch(both).start()
    if each_batch is not None:
        return writer.foreachBatch(each_batch).start()
    if table is not None:
        return writer.format("memory").queryName(table).start()
    if path is None:
        raise ValueError("a stream needs a path, a table name or a function")
    return writer.format(format).option("path", path).start()
