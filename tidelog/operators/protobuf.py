"""Protobuf payloads to a typed struct, by Spark's own Protobuf functions.

They come with the ``spark-protobuf`` package; without it these functions
raise. Names and index paths of messages are read from the descriptor set on
the driver, for which ``google.protobuf`` is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import wire
from tidelog.functions.columns import is_empty

FAILED = "protobuf decoding failed"
BAD_INDEX = "protobuf decoding failed: bad message index"
NO_MESSAGE = "protobuf decoding failed: protobuf message index out of range"


def require_protobuf(spark: SparkSession) -> None:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.protobuf.ProtobufDataToCatalyst")
    except Exception as missing:
        raise RuntimeError("Protobuf needs the spark-protobuf package on the session's class path") from missing


def _file(descriptor_set: bytes):
    from google.protobuf import descriptor_pb2

    return descriptor_pb2.FileDescriptorSet.FromString(descriptor_set).file[-1]


def message_at(descriptor_set: bytes, path: tuple[int, ...] = (0,)) -> str:
    """Full name of the message at an index path; (0,) is the default one."""
    file = _file(descriptor_set)
    messages, names = file.message_type, [file.package] if file.package else []
    for index in path:
        if not 0 <= index < len(messages):
            raise IndexError(f"protobuf message index {index} out of range")
        names.append(messages[index].name)
        messages = messages[index].nested_type
    return ".".join(names)


def message_paths(descriptor_set: bytes) -> list[tuple[int, ...]]:
    """Index paths of all messages of the file, nested ones included."""

    def below(messages, prefix: tuple[int, ...]) -> list[tuple[int, ...]]:
        found = []
        for i, message in enumerate(messages):
            found += [(*prefix, i), *below(message.nested_type, (*prefix, i))]
        return found

    return below(_file(descriptor_set).message_type, ())


def protobuf_body(payload: Column, descriptor_set: bytes, message: str, spark: SparkSession) -> Column:
    """The message of a payload without header; null where it cannot be read."""
    require_protobuf(spark)
    from pyspark.sql.protobuf.functions import from_protobuf

    options = {"mode": "PERMISSIVE", "emit.default.values": "true", "upcast.unsigned.ints": "true"}
    return from_protobuf(payload, message, options=options, binaryDescriptorSet=descriptor_set)


def framed_payload(value: Column, wire_format: str = "auto") -> tuple[Column, Column, Column]:
    """Payload behind header and index, the index path (null without header),
    and whether the index cannot be read."""
    framed = ~is_empty(value) & wire.has_header(value, wire_format)
    after = wire.body(value, wire_format)
    index = F.when(framed, wire.message_index(after))
    bad = framed & index["path"].isNull()
    skipped = F.substring(after, F.coalesce(index["skip"], F.lit(0)) + 1, F.lit((1 << 31) - 1))
    return F.when(~is_empty(value) & ~bad, skipped), index["path"], bad


def decode_protobuf(
    df: DataFrame,
    descriptor_set: bytes,
    message: str | None = None,
    wire_format: str = "auto",
    value: str = "value",
) -> DataFrame:
    """Add the struct ``body`` and ``error``; an empty payload is not decoded.

    ``message`` names the type to read; the default is the first message of
    the file.
    """
    name = message or message_at(descriptor_set)
    payload, _, bad = framed_payload(F.col(value), wire_format)
    ready = df.withColumn("_payload", payload).withColumn("_bad", bad)
    decoded = ready.withColumn("body", protobuf_body(F.col("_payload"), descriptor_set, name, df.sparkSession))
    failed = F.col("_payload").isNotNull() & F.col("body").isNull()
    error = F.when(F.col("_bad"), BAD_INDEX).when(failed, FAILED)
    return decoded.withColumn("error", error).drop("_payload", "_bad")


def encode_protobuf(
    record: Column,
    descriptor_set: bytes,
    message: str,
    spark: SparkSession,
    schema_id: int | None = None,
    index: int = 0,
) -> Column:
    """A struct column to Protobuf bytes, framed when ``schema_id`` is given."""
    require_protobuf(spark)
    from pyspark.sql.protobuf.functions import to_protobuf

    payload = to_protobuf(record, message, binaryDescriptorSet=descriptor_set)
    return payload if schema_id is None else wire.with_header(schema_id, payload, F.lit(index))
