"""Payload and key decoders, error rows and the decode audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import variants as V
from tidelog.operators.flatten import FlattenOptions, text_leaves
from tidelog.operators.wide import json_error


def decode_json(df: DataFrame, value: str = "value", into: str = "body") -> DataFrame:
    """Add ``body VARIANT`` and ``error STRING``.

    Only an object or an array at the top level is a message; anything else,
    malformed text and an empty payload included, is an error row.
    """
    error = json_error(F.col(value))
    parsed = df.withColumn(into, V.parse(F.col(value)))
    ok = V.is_container(F.col(into))
    return parsed.select(
        *[c for c in df.columns],
        F.when(ok, F.col(into)).alias(into),
        F.when(~ok, error).alias("error"),
    )


def decode_plaintext(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``message``: a null payload is null, an empty one is empty text."""
    return df.withColumn("message", F.col(value).cast("string"))


def key_text(key: Column, key_format: str) -> Column:
    """Key as text or base64; a null or empty key is empty text."""
    text = F.base64(key) if key_format == "base64" else key.cast("string")
    return F.coalesce(text, F.lit(""))


def key_leaves(key: Column, key_format: str, options: FlattenOptions) -> Column:
    """Leaves of a JSON key under ``key.``; NULL unless it is an object."""
    if key_format != "json":
        raise ValueError("only a json key has leaves")
    return text_leaves(key, options, prefix="key", wrap_array=False)


def error_rows(df: DataFrame) -> DataFrame:
    """Layout of failed messages: ``time, partition, offset, error``."""
    time = "timestamp" if "timestamp" in df.columns else "time"
    return df.filter(F.col("error").isNotNull()).select(
        F.col(time).alias("time"), "partition", "offset", "error"
    )


def split_errors(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the ``error`` column, and the error rows."""
    good = df.filter(F.col("error").isNull()).drop("error")
    return good, error_rows(df)


def decode_audit(df: DataFrame) -> DataFrame:
    """Messages, decoded and failed, and the first error, per partition."""
    # per error text first: numbers only, so a hash aggregate without a sort
    by_error = df.groupBy("topic", "partition", "error").agg(
        F.count(F.lit(1)).alias("rows"), F.min("offset").alias("first")
    )
    failed = F.col("error").isNotNull()
    return by_error.groupBy("topic", "partition").agg(
        F.sum("rows").alias("messages"),
        F.sum(F.when(failed, 0).otherwise(F.col("rows"))).alias("decoded"),
        F.sum(F.when(failed, F.col("rows")).otherwise(0)).alias("failed"),
        F.min_by("error", F.when(failed, F.col("first"))).alias("first_error"),
        F.min(F.when(failed, F.col("first"))).alias("first_error_offset"),
    )
