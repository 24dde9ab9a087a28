"""Avro payloads to a typed struct, by Spark's own Avro functions.

They come with the ``spark-avro`` package; without it these functions raise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import wire
from tidelog.functions.columns import is_empty

FAILED = "avro decoding failed: failed to decode Avro message"


def require_avro(spark: SparkSession) -> None:
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.AvroDataToCatalyst")
    except Exception as missing:
        raise RuntimeError("Avro needs the spark-avro package on the session's class path") from missing


def avro_body(payload: Column, schema: str, spark: SparkSession) -> Column:
    """The record of an Avro payload; null where it cannot be read."""
    require_avro(spark)
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, schema, {"mode": "PERMISSIVE"})


def decode_avro(
    df: DataFrame, schema: str, wire_format: str = "auto", value: str = "value"
) -> DataFrame:
    """Add the struct ``body`` and ``error``. An empty payload is not decoded:
    it is a row with a null body and no error."""
    payload = F.when(~is_empty(F.col(value)), wire.body(F.col(value), wire_format))
    framed = df.withColumn("_payload", payload)
    decoded = framed.withColumn("body", avro_body(F.col("_payload"), schema, df.sparkSession))
    failed = F.col("_payload").isNotNull() & F.col("body").isNull()
    return decoded.withColumn("error", F.when(failed, FAILED)).drop("_payload")


def encode_avro(record: Column, schema: str, spark: SparkSession, schema_id: int | None = None) -> Column:
    """A struct column to Avro bytes, framed when ``schema_id`` is given."""
    require_avro(spark)
    from pyspark.sql.avro.functions import to_avro

    payload = to_avro(record, schema)
    return payload if schema_id is None else wire.with_header(schema_id, payload)
