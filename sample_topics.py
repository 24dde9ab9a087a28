"""Topics derived from the driver's tables, row by row and without a shuffle.

Partition and offset come from the row's own keys, so a topic of any size is
built by the scan alone; offsets may have gaps, as in a real log.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.sources.topic import as_topic

PARTITIONS = 4
EVENT_FIELDS = ("event.type", "event.user.id", "props.k", "tags", "value")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _topic(df: DataFrame, topic: str, unique: Column, time: Column, key: Column, value: Column):
    return as_topic(
        df.select(
            key.cast("binary").alias("key"),
            value.cast("binary").alias("value"),
            F.lit(topic).alias("topic"),
            F.pmod(unique, F.lit(PARTITIONS)).cast("int").alias("partition"),
            F.call_function("div", unique, F.lit(PARTITIONS)).alias("offset"),
            time.cast("timestamp").alias("timestamp"),
        )
    )


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def event_json() -> Column:
    """Nested JSON of an event; every 7th value is null and of every 97
    payloads one is cut off."""
    value = F.when(F.col("event_id") % 7 == 0, "null").otherwise(F.col("value").cast("string"))
    good = _text(
        '{"event":{"type":"', F.col("event_type"), '","user":{"id":', F.col("user_id"),
        '}},"value":', value, ',"props":', F.col("props"), ',"tags":["a","b"]}',
    )
    return F.when(F.col("event_id") % 97 == 96, F.substring(good, 1, 20)).otherwise(good)


def event_key() -> Column:
    return F.to_json(F.struct("user_id", "event_type"))


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return _topic(df, "events", F.col("event_id"), F.col("ts"), event_key(), event_json())


def events_with(
    spark: SparkSession, sf_dir: str, value: Column, key: Column | None = None
) -> DataFrame:
    """The events topic with another payload or key."""
    df = table(spark, sf_dir, "events")
    key = event_key() if key is None else key
    return _topic(df, "events", F.col("event_id"), F.col("ts"), key, value)


def events_with_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic where every 101st record is a transaction marker and
    every 103rd only looks like one (its value has 7 bytes)."""
    is_marker, similar = F.col("event_id") % 101 == 0, F.col("event_id") % 103 == 0
    mark = F.when(F.col("event_id") % 2 == 0, F.lit(bytearray(b"\0\0\0\0"))).otherwise(
        F.lit(bytearray(b"\0\0\0\1"))
    )
    key = F.when(is_marker | similar, mark).otherwise(event_key().cast("binary"))
    value = (
        F.when(is_marker, F.lit(bytearray(6)))
        .when(similar, F.lit(bytearray(7)))
        .otherwise(event_json().cast("binary"))
    )
    return events_with(spark, sf_dir, value, key)


def orders_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat JSON with literal dotted keys."""
    value = _text(
        '{"order.status":"', F.col("o_orderstatus"), '","order.price":', F.col("o_totalprice"),
        ',"cust":', F.col("o_custkey"), ',"priority":"', F.col("o_orderpriority"), '"}',
    )
    df = table(spark, sf_dir, "orders")
    key = _text("order-", F.col("o_orderkey"))
    return _topic(df, "orders", F.col("o_orderkey"), F.col("o_orderdate"), key, value)


def documents_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain text; of every 13 messages one is a tombstone and one is empty."""
    text = F.when(F.col("doc_id") % 13 == 1, F.lit("")).when(
        F.col("doc_id") % 13 != 0, F.col("text")
    )
    df = table(spark, sf_dir, "documents")
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id"))
    return _topic(df, "documents", F.col("doc_id"), time, F.col("source"), text)


def conversations_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-level array per turn: a head record and a text record."""
    head = F.to_json(F.struct(F.col("conv_id").alias("id"), "turn", "role"))
    body = F.to_json(F.struct(F.struct("text", F.length("text").alias("chars")).alias("message")))
    value = F.concat(F.lit("["), head, F.lit(","), body, F.lit("]"))
    df = table(spark, sf_dir, "conversations")
    unique = F.col("conv_id") * 1000 + F.col("turn")
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("turn"))
    return _topic(df, "conversations", unique, time, F.lit(None), value)


def embeddings_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array as a member: published as text."""
    value = F.to_json(F.struct(F.struct("vec_id", "label").alias("vec"), "embedding"))
    df = table(spark, sf_dir, "embeddings")
    time = F.timestamp_seconds(F.lit(1704067200) + F.col("vec_id"))
    return _topic(df, "embeddings", F.col("vec_id"), time, F.lit(None), value)


def lineitem_lp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two line-protocol lines per row; some lines or whole payloads are bad,
    some messages are tombstones."""
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    first = _text(
        "orders,flag=", F.col("l_returnflag"), ",status=", F.col("l_linestatus"), " qty=",
        F.col("l_quantity"), ",price=", F.col("l_extendedprice"), ",line=", F.col("l_linenumber"),
        "i,late=t ", seconds,
    )
    second = _text(
        "ship\\ data,flag=", F.col("l_returnflag"), ",supp=", F.col("l_suppkey"),
        " tax=", F.col("l_tax"), ',note="', F.col("l_returnflag"), ", ", F.col("l_linestatus"),
        '",part=', F.col("l_partkey"), "i ", seconds,
    )
    mix = F.col("l_orderkey") + F.col("l_linenumber")
    value = (
        F.when(F.col("l_orderkey") % 61 == 60, F.lit(None))
        .when(mix % 59 == 58, "free text only")
        .when(mix % 53 == 52, _text(first, "\n", "ship,broken"))
        .otherwise(_text("# sample\n", first, "\r\n\n", second, "\n"))
    )
    df = table(spark, sf_dir, "lineitem")
    unique = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return _topic(df, "lines", unique, F.col("l_shipdate"), F.lit(None), value)


def orders_lp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per order; the priority tag needs escaping."""
    priority = F.regexp_replace("o_orderpriority", " ", r"\\ ")
    value = _text(
        "order,status=", F.col("o_orderstatus"), ",priority=", priority, ",value=x price=",
        F.col("o_totalprice"), ",cust=", F.col("o_custkey"), "i ",
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")),
    )
    df = table(spark, sf_dir, "orders")
    return _topic(df, "order_lines", F.col("o_orderkey"), F.col("o_orderdate"), F.lit(None), value)
