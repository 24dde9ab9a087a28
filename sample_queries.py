"""The registered queries: one per operator, over the whole driver tables,
with the equivalent SQL over the base columns.

Instants are published as epoch microseconds and bytes as hex, so both engines
compare plain numbers and text.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sample_topics as topics
from tidelog.functions import variants as V
from tidelog.functions import wire
from tidelog.functions.columns import ref
from tidelog.operators import decode, encode, panels
from tidelog.operators.flatten import FlattenOptions, flatten_long
from tidelog.operators.infer import infer_fields, schema_groups
from tidelog.operators.lineprotocol import (
    LineOptions,
    line_columns,
    lp_long,
    lp_pivot,
    lp_tag_keys,
    lp_wide,
    parse_lines,
)
from tidelog.operators.schema_tables import read_schema_table, write_schema_tables
from tidelog.operators.wide import FieldSpec
from tidelog.plans.query import TopicQuery
from tidelog.plans.run import json_wide, run, run_many, run_shared
from tidelog.session import configure, scratch_folder
from tidelog.sources import manifest, offsets, schemas
from tidelog.sources.sink import write_topic
from tidelog.sources.topic import TopicSource, drop_control_records, read_topic, topic_catalog
from tidelog.streaming.journal import read_journal
from tidelog.streaming.stream import StreamOptions, start_stream, stream_frame

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

EVENTS = TopicQuery("events", offset="earliest")
EVENT_COLUMNS = [
    FieldSpec("event.type", V.STRING, depths=(2,)),
    FieldSpec("event.user.id", V.LONG, depths=(3,)),
    FieldSpec("props.k", V.LONG, depths=(2,)),
    FieldSpec("tags", V.JSON, depths=(1,)),
    FieldSpec("value", V.DOUBLE, depths=(1,)),
]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; its instants become microseconds."""

    def register(build: Query) -> Query:
        def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return published(build(spark, sf_dir))

        QUERIES[name] = plain
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def published(df: DataFrame) -> DataFrame:
    def plain(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.TimestampType):
            return F.unix_micros(ref(f.name)).alias(f.name)
        if isinstance(f.dataType, T.BinaryType):
            return F.hex(ref(f.name)).alias(f.name)
        return ref(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def scratch(spark: SparkSession) -> str:
    """A fresh folder on the storage that driver and executors share."""
    return scratch_folder(spark, "sample")


# --- sources, offsets, sinks ----------------------------------------------

EV = """WITH ev AS (
  SELECT event_id, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset",
         epoch_us(ts) AS us, user_id, event_type, value,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k, props,
         event_id % 97 = 96 AS bad, event_id % 7 = 0 AS nulled,
         '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS key_text,
         '{"event":{"type":"' || event_type || '","user":{"id":' || user_id || '}},"value":'
           || CASE WHEN event_id % 7 = 0 THEN 'null' ELSE CAST(value AS VARCHAR) END
           || ',"props":' || props || ',"tags":["a","b"]}' AS json_text
  FROM events), ok AS (SELECT * FROM ev WHERE NOT bad)
"""
MALFORMED = "'json decoding failed: malformed JSON'"
SCAN = (
    EV
    + """SELECT 'events' AS topic, "partition", "offset", us AS "timestamp", key_text AS "key",
  CASE WHEN bad THEN substr(json_text, 1, 20) ELSE json_text END AS value FROM ev"""
)


def _texts(df: DataFrame) -> DataFrame:
    text = [F.col(c).cast("string").alias(c) for c in ("key", "value")]
    return df.select("topic", "partition", "offset", "timestamp", *text)


@query("topic_scan", SCAN)
def topic_scan(spark, sf_dir):
    return _texts(topics.events_log(spark, sf_dir))


@query("topic_sink", SCAN)
def topic_sink(spark, sf_dir):
    """Written to a topic table and read back through the source."""
    target = TopicSource(path=scratch(spark))
    write_topic(topics.events_log(spark, sf_dir), target)
    return _texts(read_topic(spark, target, "events"))


@query(
    "partition_select",
    EV + """SELECT "partition", "offset", us AS "timestamp" FROM ev WHERE "partition" = 2""",
)
def partition_select(spark, sf_dir):
    log = topics.events_log(spark, sf_dir)
    return offsets.select_partitions(log, 2).select("partition", "offset", "timestamp")


@query("offset_earliest", EV + """SELECT "partition", "offset" FROM ev""")
def offset_earliest(spark, sf_dir):
    from tidelog.plans.run import messages

    log = topics.events_log(spark, sf_dir)
    return messages(spark, EVENTS, log).select("partition", "offset")


NEW_YEAR_NOON = "2024-01-05 12:00:00"


@query(
    "offset_latest",
    EV
    + f""", seen AS (SELECT "partition" AS p, max("offset") AS top FROM ev
    WHERE us < epoch_us(TIMESTAMP '{NEW_YEAR_NOON}') GROUP BY 1)
  SELECT "partition", "offset", us AS "timestamp" FROM ev LEFT JOIN seen ON p = "partition"
  WHERE top IS NULL OR "offset" > top""",
)
def offset_latest(spark, sf_dir):
    from tidelog.plans.run import messages

    log = topics.events_log(spark, sf_dir)
    then = offsets.offset_bounds(log.filter(F.col("timestamp") < F.lit(NEW_YEAR_NOON).cast("timestamp")))
    return messages(spark, TopicQuery("events"), log, then).select("partition", "offset", "timestamp")


@query(
    "last_n",
    EV
    + """, b AS (SELECT "partition" AS p, max("offset") + 1 - 100 AS start FROM ev GROUP BY 1)
  SELECT "partition", "offset", us AS "timestamp" FROM ev JOIN b ON p = "partition"
  WHERE "offset" >= start""",
)
def last_n(spark, sf_dir):
    log = topics.events_log(spark, sf_dir)
    return offsets.last_n(log, 100).select("partition", "offset", "timestamp")


@query(
    "last_n_large",
    EV
    + """, b AS (SELECT "partition" AS p, max("offset") + 1 - 3000000 AS start FROM ev GROUP BY 1)
  SELECT "partition", "offset", us AS "timestamp" FROM ev JOIN b ON p = "partition"
  WHERE "offset" >= start""",
)
def last_n_large(spark, sf_dir):
    """More than a million offsets back."""
    log = topics.events_log(spark, sf_dir)
    return offsets.last_n(log, 3_000_000).select("partition", "offset", "timestamp")


@query(
    "drop_control",
    EV
    + """SELECT "partition", "offset", us AS "timestamp",
  event_id % 103 = 0 AS lookalike FROM ev WHERE event_id % 101 <> 0""",
)
def drop_control(spark, sf_dir):
    kept = drop_control_records(topics.events_with_markers(spark, sf_dir))
    return kept.select(
        "partition",
        "offset",
        "timestamp",
        (F.octet_length("value") == 7).alias("lookalike"),
    )


@query(
    "topic_catalog",
    """WITH logs AS (
  SELECT 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS o,
    epoch_us(ts) AS us FROM events
  UNION ALL SELECT 'documents', CAST(doc_id % 4 AS INTEGER), doc_id // 4,
    (1704067200 + doc_id) * 1000000 FROM documents)
  SELECT topic, "partition", min(o) AS first_offset, max(o) AS last_offset, count(*) AS messages,
    min(us) AS first_time, max(us) AS last_time FROM logs GROUP BY 1, 2""",
)
def catalog(spark, sf_dir):
    """Three topics, of which the first two by name are listed."""
    logs = topics.events_log(spark, sf_dir)
    for other in (topics.orders_log, topics.documents_log):
        logs = logs.unionByName(other(spark, sf_dir))
    return topic_catalog(logs, limit=2)


@query(
    "multi_query",
    EV
    + f"""SELECT 'A' AS ref_id, "partition", "offset", us AS time, event_type AS "event.type",
    CASE WHEN NOT nulled THEN value END AS value, NULL AS "order.price", NULL AS error FROM ok
  UNION ALL SELECT 'A', "partition", "offset", us, NULL, NULL, NULL, {MALFORMED} FROM ev WHERE bad
  UNION ALL SELECT 'B', CAST(o_orderkey % 4 AS INTEGER), o_orderkey // 4, epoch_us(o_orderdate),
    NULL, NULL, o_totalprice, NULL FROM orders""",
)
def multi_query(spark, sf_dir):
    log = topics.events_log(spark, sf_dir).unionByName(topics.orders_log(spark, sf_dir))
    both = [
        TopicQuery("events", offset="earliest", ref_id="A"),
        TopicQuery("orders", offset="earliest", ref_id="B"),
        TopicQuery("", ref_id="C"),
    ]
    merged = run_many(spark, both, log)
    names = ["ref_id", "partition", "offset", "time", "event.type", "value", "order.price", "error"]
    return panels.select_fields(merged, names)


@query(
    "multi_query_shared",
    EV
    + f""", b AS (SELECT "partition" AS p, max("offset") + 1 - 50 AS start FROM ev GROUP BY 1), q AS (
  SELECT 'A' AS ref_id, ev.*, "partition" AS shown FROM ev
  UNION ALL SELECT 'B', ev.*, NULL FROM ev WHERE "partition" = 2
  UNION ALL SELECT 'C', ev.*, "partition" FROM ev JOIN b ON p = "partition" WHERE "offset" >= start
  UNION ALL SELECT 'D', ev.*, "partition" FROM ev
    WHERE us BETWEEN epoch_us(TIMESTAMP '2024-01-03') AND epoch_us(TIMESTAMP '2024-01-09 12:00:00'))
  SELECT ref_id, shown AS "partition", "offset", us AS time, CASE WHEN NOT bad THEN event_type END AS "event.type",
    CASE WHEN NOT bad AND NOT nulled THEN value END AS value, CASE WHEN bad THEN {MALFORMED} END AS error FROM q""",
)
def multi_query_shared(spark, sf_dir):
    """Four queries, one scan and one parse."""
    wanted = [
        TopicQuery("events", offset="earliest", ref_id="A"),
        TopicQuery("events", offset="earliest", partition=2, ref_id="B"),
        TopicQuery("events", offset="last_n", last_n=50, ref_id="C"),
        TopicQuery("events", offset="earliest", start_time=WINDOW[0], end_time=WINDOW[1], ref_id="D"),
    ]
    merged = run_shared(spark, wanted, topics.events_log(spark, sf_dir), fields=EVENT_COLUMNS)
    return panels.select_fields(merged, ["ref_id", "partition", "offset", "time", "event.type", "value", "error"])


# --- topic tables with a manifest -------------------------------------------

SPLIT = 400


def managed_events(spark: SparkSession, sf_dir: str) -> TopicSource:
    """The events in two appends, and a fifth partition that stays empty."""
    target = TopicSource("managed", scratch(spark))
    manifest.create_topic(spark, target.path, "events", 5)
    log = topics.events_log(spark, sf_dir)
    # the old offset orders the rows of a partition; the table gives its own
    for part in (F.col("offset") < SPLIT, F.col("offset") >= SPLIT):
        manifest.append(log.filter(part), target.path, order=["offset"])
    return target


@query(
    "manifest_bounds",
    EV
    + """, p AS (SELECT "partition", count(*) AS n, min(us) AS a, max(us) AS b FROM ev GROUP BY 1
    UNION ALL SELECT 4, 0, NULL, NULL)
  SELECT 'events' AS topic, "partition", CAST(0 AS BIGINT) AS earliest, n AS latest, n AS messages,
    a AS first_time, b AS last_time FROM p""",
)
def manifest_bounds(spark, sf_dir):
    """Bounds and catalog without a look at the messages."""
    zones = manifest.zones(spark, managed_events(spark, sf_dir).path)
    listed = manifest.catalog(zones).select("topic", "partition", "messages", "first_time", "last_time")
    return manifest.bounds(zones).join(listed, ["topic", "partition"])


_MURMUR = """
WITH k AS (SELECT event_id, epoch_us(ts) AS us, 'user-' || user_id AS key FROM events),
b AS (SELECT *, len(key) AS n, list_transform(range(1, len(key) + 1), lambda i: ascii(substr(key, i, 1))::UBIGINT) AS x
  FROM k),
w AS (SELECT *, list_transform(range(0, n // 4), lambda i:
    x[4 * i + 1] + x[4 * i + 2] * 256 + x[4 * i + 3] * 65536 + x[4 * i + 4] * 16777216) AS words FROM b),
m AS (SELECT *, list_transform(list_transform(words, lambda v: (v * 1540483477) % 4294967296),
    lambda v: (xor(v, v >> 24) * 1540483477) % 4294967296) AS mixed FROM w),
h AS (SELECT *, list_reduce(list_prepend(xor(2538058380::UBIGINT, n::UBIGINT), mixed),
    lambda a, v: xor((a * 1540483477) % 4294967296, v)) AS body FROM m),
t AS (SELECT *, CASE n % 4 WHEN 0 THEN body ELSE (xor(body,
    x[n - n % 4 + 1] + coalesce(x[n - n % 4 + 2], 0) * 256 + coalesce(x[n - n % 4 + 3], 0) * 65536)
    * 1540483477) % 4294967296 END AS tail FROM h),
f AS (SELECT *, (xor(tail, tail >> 13) * 1540483477) % 4294967296 AS late FROM t),
p AS (SELECT event_id, us, key, CAST((xor(late, late >> 15) & 2147483647) % 6 AS INTEGER) AS "partition" FROM f)
SELECT key, us AS "timestamp", "partition",
  row_number() OVER (PARTITION BY "partition" ORDER BY event_id % 3 = 0, us, event_id) - 1 AS "offset" FROM p"""


@query("sink_offsets", _MURMUR)
def sink_offsets(spark, sf_dir):
    """Two appends of keyed rows: the table chooses partitions and offsets."""
    target = TopicSource("managed", scratch(spark))
    manifest.create_topic(spark, target.path, "users", 6)
    events = topics.table(spark, sf_dir, "events").select(
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).cast("binary").alias("key"),
        F.to_json(F.struct("event_type", "value")).cast("binary").alias("value"),
        F.lit("users").alias("topic"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        "event_id",
    )
    for part in (F.col("event_id") % 3 != 0, F.col("event_id") % 3 == 0):
        manifest.append(events.filter(part), target.path, order=["timestamp", "event_id"])
    read = read_topic(spark, target, "users")
    return read.select(F.col("key").cast("string").alias("key"), "timestamp", "partition", "offset")


WINDOW = (datetime(2024, 1, 3, tzinfo=UTC), datetime(2024, 1, 9, 12, tzinfo=UTC))


@query(
    "time_window",
    EV
    + f"""SELECT us AS time, "partition", "offset", CASE WHEN NOT bad THEN event_type END AS "event.type",
  CASE WHEN bad THEN {MALFORMED} END AS error FROM ev
  WHERE us BETWEEN epoch_us(TIMESTAMP '2024-01-03') AND epoch_us(TIMESTAMP '2024-01-09 12:00:00')""",
)
def time_window(spark, sf_dir):
    """Only files whose times meet the window are read."""
    wanted = TopicQuery("events", offset="earliest", start_time=WINDOW[0], end_time=WINDOW[1])
    wide = run(spark, wanted, managed_events(spark, sf_dir), fields=EVENT_COLUMNS)
    return panels.select_fields(wide, ["time", "partition", "offset", "event.type", "error"])


# --- JSON: decode, flatten, type, shape -----------------------------------


@query(
    "decode_json",
    EV
    + f"""SELECT "partition", "offset", CASE WHEN NOT bad THEN event_type END AS type,
  CASE WHEN NOT bad AND NOT nulled THEN value END AS value,
  CASE WHEN bad THEN {MALFORMED} END AS error FROM ev""",
)
def decode_json(spark, sf_dir):
    decoded = decode.decode_json(topics.events_log(spark, sf_dir))
    return decoded.select(
        "partition",
        "offset",
        F.try_variant_get("body", "$.event.type", "string").alias("type"),
        F.try_variant_get("body", "$.value", "double").alias("value"),
        "error",
    )


LONG = (
    EV
    + """, leaf AS (
  SELECT "partition", "offset", 'event.type' AS path, 'string' AS type, NULL::BIGINT AS v_long,
    NULL::DOUBLE AS v_double, NULL::BOOLEAN AS v_bool, event_type AS v_str FROM ok
  UNION ALL SELECT "partition", "offset", 'event.user.id', 'long', user_id, user_id, NULL, NULL FROM ok
  UNION ALL SELECT "partition", "offset", 'props.k', 'long', k, k, NULL, NULL FROM ok
  UNION ALL SELECT "partition", "offset", 'tags', 'json', NULL, NULL, NULL, '["a","b"]' FROM ok
  UNION ALL SELECT "partition", "offset", 'value', CASE WHEN nulled THEN 'null' ELSE 'double' END,
    NULL, CASE WHEN NOT nulled THEN value END, NULL, NULL FROM ok)
"""
)
FLAT_LONG = LONG + "SELECT * FROM leaf"


@query("flatten_long", FLAT_LONG)
def flatten_to_long(spark, sf_dir):
    log = topics.events_log(spark, sf_dir)
    return flatten_long(log.select("partition", "offset", "value"))


@query(
    "flatten_bounds",
    LONG + "SELECT * FROM leaf WHERE path IN ('event.type', 'props.k')",
)
def flatten_bounds(spark, sf_dir):
    """Depth 3 keeps paths of two segments, the cap the first two of them."""
    log = topics.events_log(spark, sf_dir)
    return flatten_long(log.select("partition", "offset", "value"), options=FlattenOptions(3, 2))


@query(
    "flatten_array",
    """WITH c AS (SELECT CAST((conv_id * 1000 + turn) % 4 AS INTEGER) AS "partition",
    (conv_id * 1000 + turn) // 4 AS "offset", * FROM conversations)
  SELECT "partition", "offset", 'item_0.id' AS path, 'long' AS type, conv_id AS v_long,
    NULL AS v_str FROM c
  UNION ALL SELECT "partition", "offset", 'item_0.turn', 'long', turn, NULL FROM c
  UNION ALL SELECT "partition", "offset", 'item_0.role', 'string', NULL, role FROM c
  UNION ALL SELECT "partition", "offset", 'item_1.message.text', 'string', NULL, text FROM c
  UNION ALL SELECT "partition", "offset", 'item_1.message.chars', 'long', length(text), NULL FROM c""",
)
def flatten_array(spark, sf_dir):
    log = topics.conversations_log(spark, sf_dir)
    long = flatten_long(log.select("partition", "offset", "value"))
    return long.drop("v_double", "v_bool")


WIDE = (
    EV
    + f"""SELECT us AS time, "partition", "offset",
  CASE WHEN NOT bad THEN event_type END AS "key.event_type",
  CASE WHEN NOT bad THEN user_id END AS "key.user_id",
  CASE WHEN NOT bad THEN event_type END AS "event.type",
  CASE WHEN NOT bad THEN user_id END AS "event.user.id",
  CASE WHEN NOT bad THEN k END AS "props.k",
  CASE WHEN NOT bad THEN '["a","b"]' END AS tags,
  CASE WHEN NOT bad AND NOT nulled THEN value END AS value,
  CASE WHEN bad THEN {MALFORMED} END AS error FROM ev"""
)


@query("flatten_wide", WIDE)
def flatten_wide(spark, sf_dir):
    """Fields and types are found in the topic first."""
    wanted = TopicQuery("events", offset="earliest", key_format="json")
    return run(spark, wanted, topics.events_log(spark, sf_dir))


@query(
    "wide_extra",
    EV
    + f"""SELECT "partition", "offset", CASE WHEN NOT bad THEN event_type END AS "event.type",
  CASE WHEN NOT bad THEN 4 END AS others, CASE WHEN NOT bad THEN CAST(user_id AS VARCHAR) END AS user,
  CASE WHEN NOT bad THEN CAST(k AS VARCHAR) END AS k, CASE WHEN NOT bad THEN '["a","b"]' END AS tags,
  NOT bad AND nulled AS null_value, CASE WHEN bad THEN {MALFORMED} END AS error FROM ev""",
)
def wide_extra(spark, sf_dir):
    """One column is asked for; all other paths are in the map."""
    wanted = TopicQuery("events", offset="earliest", extra=True)
    wide = run(spark, wanted, topics.events_log(spark, sf_dir), fields=EVENT_COLUMNS[:1])
    more = lambda path: F.try_element_at("extra", F.lit(path))
    return wide.select(
        *("partition", "offset", ref("event.type")),
        F.when(F.col("extra").isNotNull(), F.size("extra")).alias("others"),
        *(more("event.user.id").alias("user"), more("props.k").alias("k"), more("tags").alias("tags")),
        (F.col("extra").isNotNull() & more("value").isNull()).alias("null_value"),
        "error",
    )


@query(
    "flatten_deep",
    EV + """SELECT "offset", "partition", repeat('a.', 39) || 'id' AS path, event_id AS v_long FROM ev""",
)
def flatten_deep(spark, sf_dir):
    """Objects in objects, forty deep."""
    value = F.concat(F.lit('{"a":' * 39 + '{"id":'), F.col("event_id").cast("string"), F.lit("}" * 40))
    log = topics.events_with(spark, sf_dir, value)
    long = flatten_long(log.select("partition", "offset", "value"), options=FlattenOptions(60))
    return long.select("offset", "partition", "path", "v_long")


@query(
    "array_text",
    """SELECT vec_id // 4 AS "offset", vec_id AS "vec.vec_id", label AS "vec.label",
  len(embedding) AS n, CAST(round(embedding[1]::DOUBLE * 10000) AS BIGINT) AS first_value FROM embeddings""",
)
def array_text(spark, sf_dir):
    """An array member is one text column; here it is read back. A text is the
    shortest of its float: as a double it would be another number."""
    wide = run(spark, TopicQuery("embeddings", offset="earliest"), topics.embeddings_log(spark, sf_dir))
    numbers = F.from_json("embedding", "array<float>")
    return wide.select(
        "offset",
        ref("vec.vec_id"),
        ref("vec.label").cast("int").alias("vec.label"),
        F.size(numbers).cast("bigint").alias("n"),
        F.round(F.get(numbers, 0).cast("double") * 10000).cast("bigint").alias("first_value"),
    )


@query(
    "infer_fields",
    EV
    + """, n AS (SELECT count(*) AS n, CAST(count_if(nulled) AS BIGINT) AS nulls FROM ok)
  SELECT path, type, false AS mixed, type AS last_type, n AS messages,
    CASE WHEN path = 'value' THEN nulls ELSE 0 END AS nulls
  FROM n, (VALUES ('event.type', 'string'), ('event.user.id', 'long'), ('props.k', 'long'),
    ('tags', 'json'), ('value', 'double')) t(path, type)""",
)
def infer(spark, sf_dir):
    return infer_fields(topics.events_log(spark, sf_dir)).drop("depths")


@query(
    "infer_mixed",
    """SELECT path, type, mixed, last_type FROM (VALUES
    ('a', 'double', false, 'long'), ('b', 'string', true, 'bool'),
    ('c', 'double', false, 'double'), ('d', 'long', false, 'long')) t(path, type, mixed, last_type)
  WHERE (SELECT count(*) FROM events) > 10""",
)
def infer_mixed(spark, sf_dir):
    """long with double is double, text with boolean is string, only null is
    double, long with null stays long. The newest event decides last_type."""
    last = F.col("event_id") % 2 == 1
    value = F.concat(
        F.lit('{"a":'), F.when(last, "1").otherwise("1.5"),
        F.lit(',"b":'), F.when(last, "true").otherwise('"x"'),
        F.lit(',"c":null,"d":'), F.when(last, "7").otherwise("null"), F.lit("}"),
    )
    return infer_fields(topics.events_with(spark, sf_dir, value)).select(
        "path", "type", "mixed", "last_type"
    )


@query(
    "coerce_number",
    """SELECT o_orderkey // 4 AS "offset", o_custkey AS i, o_totalprice AS f,
    CAST(o_custkey AS DOUBLE) AS w, o_custkey * 100.0::DOUBLE AS e,
    CAST(10000000000000000000::HUGEINT + o_custkey AS DOUBLE) AS big FROM orders""",
)
def coerce_number(spark, sf_dir):
    """Whole literals that fit are long; 2.0, 2e2 and too large ones double."""
    df = topics.table(spark, sf_dir, "orders")
    c = F.col("o_custkey").cast("string")
    value = F.concat(
        F.lit('{"i":'), c, F.lit(',"f":'), F.col("o_totalprice").cast("string"), F.lit(',"w":'), c,
        F.lit('.0,"e":'), c, F.lit('e2,"big":1'), F.lpad(c, 19, "0"), F.lit("}"),
    )
    log = topics._topic(
        df, "numbers", F.col("o_orderkey"), F.col("o_orderdate"), F.lit(None), value
    )
    wide = run(spark, TopicQuery("numbers", offset="earliest"), log)
    return wide.select("offset", "i", "f", "w", "e", "big")


@query(
    "schema_tables",
    EV
    + """SELECT 'events' AS topic, "offset", "partition", event_type AS "event.type", user_id AS "event.user.id", k AS "props.k",
    '["a","b"]' AS tags, CASE WHEN NOT nulled THEN value END AS value, NULL AS "order.price", NULL AS cust FROM ok
  UNION ALL SELECT 'events', "offset", "partition", NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM ev WHERE bad
  UNION ALL SELECT 'orders', o_orderkey // 4, CAST(o_orderkey % 4 AS INTEGER), NULL, NULL, NULL, NULL, NULL,
    o_totalprice, o_custkey FROM orders""",
)
def schema_tables(spark, sf_dir):
    """Two topics written as a table per set of typed fields, and read again."""
    log = topics.events_log(spark, sf_dir).unionByName(topics.orders_log(spark, sf_dir))
    path = scratch(spark)
    groups = write_schema_tables(log, path).select("signature").distinct().collect()
    tables = [read_schema_table(spark, path, g["signature"]) for g in groups]
    whole = tables[0]
    for other in tables[1:]:
        whole = whole.unionByName(other, allowMissingColumns=True)
    names = ["topic", "offset", "partition", "event.type", "event.user.id", "props.k", "tags", "value", "order.price", "cust"]
    return panels.select_fields(whole, names)


@query(
    "schema_groups",
    EV
    + """SELECT 'events' AS topic, CASE WHEN bad THEN 'error:string' ELSE
    'event.type:string|event.user.id:long|props.k:long|tags:json|value:double' END AS fields,
    count(*) AS messages, min("offset") AS first_offset, max("offset") AS last_offset,
    min(us) AS first_time, max(us) AS last_time FROM ev GROUP BY 1, 2
  UNION ALL SELECT 'orders', 'cust:long|order.price:double|order.status:string|priority:string',
    count(*), min(o_orderkey // 4), max(o_orderkey // 4), min(epoch_us(o_orderdate)),
    max(epoch_us(o_orderdate)) FROM orders""",
)
def groups(spark, sf_dir):
    log = topics.events_log(spark, sf_dir).unionByName(topics.orders_log(spark, sf_dir))
    return schema_groups(log).drop("signature")


# --- keys, errors, time, naming -------------------------------------------


def _events_wide(spark, sf_dir, **settings) -> DataFrame:
    wanted = TopicQuery("events", offset="earliest", **settings)
    return json_wide(topics.events_log(spark, sf_dir), wanted, EVENT_COLUMNS)


@query(
    "key_string",
    EV + """SELECT "partition", "offset", CASE WHEN event_id % 5 = 0 THEN '' ELSE key_text END AS "key" FROM ev""",
)
def key_string(spark, sf_dir):
    key = F.when(F.col("event_id") % 5 != 0, topics.event_key())
    log = topics.events_with(spark, sf_dir, topics.event_json(), key)
    return log.select("partition", "offset", decode.key_text(F.col("key"), "string").alias("key"))


@query(
    "key_base64",
    EV + """SELECT "partition", "offset", CASE WHEN bad THEN NULL ELSE to_base64(encode(key_text)) END AS "key" FROM ev""",
)
def key_base64(spark, sf_dir):
    return _events_wide(spark, sf_dir, key_format="base64").select("partition", "offset", "key")


@query(
    "key_json",
    EV
    + """SELECT "partition", "offset", CASE WHEN NOT bad AND event_id % 5 > 1 THEN event_type END
    AS "key.event_type", CASE WHEN NOT bad AND event_id % 5 > 1 THEN user_id END AS "key.user_id" FROM ev""",
)
def key_json(spark, sf_dir):
    """A key that is no JSON object adds nothing; the message stays."""
    key = (
        F.when(F.col("event_id") % 5 == 0, F.lit("plain"))
        .when(F.col("event_id") % 5 == 1, F.lit("[1]"))
        .otherwise(topics.event_key())
    )
    log = topics.events_with(spark, sf_dir, topics.event_json(), key)
    wide = run(spark, TopicQuery("events", offset="earliest", key_format="json"), log)
    return panels.select_fields(wide, ["partition", "offset", "key.event_type", "key.user_id"])


@query(
    "key_collision",
    EV + """SELECT "partition", "offset", event_type AS "key.event_type", 'v' || event_id AS "key.user_id" FROM ev""",
)
def key_collision(spark, sf_dir):
    value = F.concat(F.lit('{"key.user_id":"v'), F.col("event_id").cast("string"), F.lit('"}'))
    log = topics.events_with(spark, sf_dir, value)
    wide = run(spark, TopicQuery("events", offset="earliest", key_format="json"), log)
    return panels.select_fields(wide, ["partition", "offset", "key.event_type", "key.user_id"])


ERROR_TEXTS = {
    "5": "'decoded JSON is not a valid object or array: json.Number'",
    '"text"': "'decoded JSON is not a valid object or array: string'",
    "true": "'decoded JSON is not a valid object or array: bool'",
    "null": "'decoded JSON is not a valid object or array: <nil>'",
    "{": MALFORMED,
    "": "'message value is nil - possible decoding failure'",
}


@query(
    "error_rows",
    EV
    + "SELECT us AS time, \"partition\", \"offset\", CASE event_id % 8 "
    + " ".join(f"WHEN {i} THEN {text}" for i, text in enumerate(ERROR_TEXTS.values()))
    + " END AS error FROM ev WHERE event_id % 8 < 6",
)
def error_rows(spark, sf_dir):
    value = topics.event_json()
    value = F.when(F.col("event_id") % 97 == 96, '{"cut":1}').otherwise(value)
    for i, text in enumerate(ERROR_TEXTS):
        value = F.when(F.col("event_id") % 8 == i, text).otherwise(value)
    return decode.error_rows(decode.decode_json(topics.events_with(spark, sf_dir, value)))


@query(
    "decode_audit",
    EV
    + f"""SELECT 'events' AS topic, "partition", count(*) AS messages, CAST(count_if(NOT bad) AS BIGINT) AS decoded,
    CAST(count_if(bad) AS BIGINT) AS failed, {MALFORMED} AS first_error,
    min("offset") FILTER (bad) AS first_error_offset FROM ev GROUP BY "partition" """,
)
def decode_audit(spark, sf_dir):
    return decode.decode_audit(decode.decode_json(topics.events_log(spark, sf_dir)))


@query(
    "time_mode",
    EV + """SELECT "partition", "offset", NOT bad AS is_now, CASE WHEN bad THEN us END AS message_time FROM ev""",
)
def time_mode(spark, sf_dir):
    """Receive time for decoded messages, message time for error rows."""
    wide = _events_wide(spark, sf_dir, time_mode="now")
    recent = F.col("time") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return wide.select(
        "partition",
        "offset",
        recent.alias("is_now"),
        F.when(~recent, F.col("time")).alias("message_time"),
    )


@query(
    "alias",
    LONG + """SELECT "offset", path, 'events/' || "partition" || '/A/' || path AS series FROM leaf""",
)
def alias(spark, sf_dir):
    named = TopicQuery(
        "events", offset="earliest", shape="long", ref_id="A",
        alias="{{topic}}/{{partition}}/{{refid}}/{{field}}",
    )
    long = run(spark, named, topics.events_log(spark, sf_dir))
    return long.filter("error IS NULL").select("offset", "path", "series")


@query(
    "decode_plaintext",
    """SELECT CAST(doc_id % 4 AS INTEGER) AS "partition", doc_id // 4 AS "offset",
    (1704067200 + doc_id) * 1000000 AS time, source AS "key",
    CASE doc_id % 13 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE text END AS message, NULL::VARCHAR AS error
  FROM documents""",
)
def decode_plaintext(spark, sf_dir):
    wanted = TopicQuery("documents", offset="earliest", format="plaintext", key_format="string")
    return run(spark, wanted, topics.documents_log(spark, sf_dir))


# --- line protocol ---------------------------------------------------------

LP = """WITH li AS (
  SELECT CAST((l_orderkey * 8 + l_linenumber) % 4 AS INTEGER) AS "partition",
    (l_orderkey * 8 + l_linenumber) // 4 AS "offset", epoch_us(l_shipdate) AS us,
    (l_orderkey + l_linenumber) % 59 = 58 AS bad, (l_orderkey + l_linenumber) % 53 = 52 AS half, *
  FROM lineitem WHERE l_orderkey % 61 <> 60),
good AS (SELECT * FROM li WHERE NOT bad), whole AS (SELECT * FROM good WHERE NOT half),
long AS (
  SELECT us, 'orders' AS m, 'qty' AS f, l_quantity AS v, NULL AS s, l_returnflag AS flag,
    l_linestatus AS status, NULL AS supp, "partition", "offset", NULL AS error FROM good
  UNION ALL SELECT us, 'orders', 'price', l_extendedprice, NULL, l_returnflag, l_linestatus, NULL,
    "partition", "offset", NULL FROM good
  UNION ALL SELECT us, 'orders', 'line', l_linenumber, NULL, l_returnflag, l_linestatus, NULL,
    "partition", "offset", NULL FROM good
  UNION ALL SELECT us, 'orders', 'late', 1, NULL, l_returnflag, l_linestatus, NULL,
    "partition", "offset", NULL FROM good
  UNION ALL SELECT us, 'ship data', 'tax', l_tax, NULL, l_returnflag, NULL,
    CAST(l_suppkey AS VARCHAR), "partition", "offset", NULL FROM whole
  UNION ALL SELECT us, 'ship data', 'note', NULL, l_returnflag || ', ' || l_linestatus,
    l_returnflag, NULL, CAST(l_suppkey AS VARCHAR), "partition", "offset", NULL FROM whole
  UNION ALL SELECT us, 'ship data', 'part', l_partkey, NULL, l_returnflag, NULL,
    CAST(l_suppkey AS VARCHAR), "partition", "offset", NULL FROM whole
  UNION ALL SELECT us, '', '', NULL, NULL, NULL, NULL, NULL, "partition", "offset",
    'line 1: field "text only" missing ''=''' FROM li WHERE bad)
"""
LP_ROWS = """SELECT us AS "Time", m AS _measurement, f AS _field, v AS value, s AS value_str,
  flag, status, supp, "partition", "offset", error FROM long"""


def _lines(spark, sf_dir, **options) -> DataFrame:
    return lp_long(topics.lineitem_lp(spark, sf_dir), LineOptions(**options))


def _long_with_tags(long: DataFrame) -> DataFrame:
    tags = [F.try_element_at("tags", F.lit(k)).alias(k) for k in ("flag", "status", "supp")]
    return long.select(
        "Time", "_measurement", "_field", "value", "value_str", *tags, "partition", "offset", "error"
    )


@query("lp_long", LP + LP_ROWS)
def lp_long_rows(spark, sf_dir):
    return _long_with_tags(_lines(spark, sf_dir))


@query(
    "lp_lines",
    LP
    + """SELECT "partition", "offset", CASE WHEN half THEN 0 ELSE 1 END AS line, false AS failed FROM good
  UNION ALL SELECT "partition", "offset", 3, false FROM whole
  UNION ALL SELECT "partition", "offset", 0, true FROM li WHERE bad""",
)
def lp_lines(spark, sf_dir):
    lines = parse_lines(topics.lineitem_lp(spark, sf_dir))
    return lines.select("partition", "offset", "line", F.col("_parts").startswith("\nE").alias("failed"))


@query(
    "lp_parse",
    LP
    + """SELECT "offset", 'orders' AS _measurement, 2 AS n_tags, 4 AS n_fields, us // 1000000 AS ts
    FROM good UNION ALL SELECT "offset", 'ship data', 2, 3, us // 1000000 FROM whole""",
)
def lp_parse(spark, sf_dir):
    lines = line_columns(parse_lines(topics.lineitem_lp(spark, sf_dir)))
    return lines.filter("error IS NULL").select(
        "offset",
        "_measurement",
        F.size("tags").alias("n_tags"),
        F.size("_fields").alias("n_fields"),
        F.col("_ts").alias("ts"),
    )


@query(
    "lp_types",
    LP
    + """SELECT m AS _measurement, f AS _field, count(*) AS n, count(v) AS numbers, count(s) AS texts,
    round(sum(v), 2) AS total FROM long WHERE error IS NULL GROUP BY 1, 2""",
)
def lp_types(spark, sf_dir):
    long = _lines(spark, sf_dir).filter("error IS NULL")
    return long.groupBy("_measurement", "_field").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("value").alias("numbers"),
        F.count("value_str").alias("texts"),
        F.round(F.sum("value"), 2).alias("total"),
    )


@query(
    "lp_errors",
    LP + LP_ROWS.split("FROM")[0].replace("flag, status, supp, ", "") + "FROM long WHERE error IS NOT NULL",
)
def lp_errors(spark, sf_dir):
    failed = _long_with_tags(_lines(spark, sf_dir)).filter("error IS NOT NULL")
    return failed.drop("flag", "status", "supp")


def _filter_query(name: str, where: str, **options) -> None:
    sql = LP + LP_ROWS + f" WHERE error IS NOT NULL OR ({where})"
    query(name, sql)(lambda spark, sf_dir: _long_with_tags(_lines(spark, sf_dir, **options)))


_filter_query("lp_filter_measurement", "m = 'ship data'", measurements="ship.*, nothing")
_filter_query("lp_filter_field", "f IN ('qty', 'note')", fields="qty,no.e")
_filter_query(
    "lp_filter_tag",
    "status = 'O' AND flag IN ('A', 'N')",
    tags="status=O,flag=A,flag=[N-P],ignored,=x,flag=",
)
_filter_query(
    "lp_filter_all",
    "m = 'orders' AND f IN ('price', 'part') AND flag = 'R'",
    measurements="orders", fields="p.*", tags="flag=R",
)
_filter_query("lp_filter_literal", "f = 'qty'", fields="+qty,(?=line)line,qty")


@query(
    "lp_bigint",
    """WITH o AS (SELECT o_orderkey // 4 AS "offset", o_custkey AS c FROM orders)
  SELECT "offset", 'small' AS _field, CAST(c AS DOUBLE) AS value, NULL AS value_str FROM o
  UNION ALL SELECT "offset", 'edge', -9007199254740991, NULL FROM o
  UNION ALL SELECT "offset", 'big', NULL, CAST(9007199254740992 + c AS VARCHAR) FROM o
  UNION ALL SELECT "offset", 'unsigned', NULL, '18446744073709551615' FROM o
  UNION ALL SELECT "offset", 'count', CAST(c AS DOUBLE), NULL FROM o""",
)
def lp_bigint(spark, sf_dir):
    c = F.col("o_custkey")
    value = F.concat(
        F.lit("m small="), c.cast("string"), F.lit("i,edge=-9007199254740991i,big="),
        (c + 9007199254740992).cast("string"), F.lit("i,unsigned=18446744073709551615u,count="),
        c.cast("string"), F.lit("u"),
    )
    df = topics.table(spark, sf_dir, "orders")
    log = topics._topic(df, "ints", F.col("o_orderkey"), F.col("o_orderdate"), F.lit(None), value)
    return lp_long(log).select("offset", "_field", "value", "value_str")


@query(
    "lp_time",
    EV
    + """SELECT "offset", "partition", unit AS _measurement,
    CASE unit WHEN 's' THEN us // 1000000 * 1000000 WHEN 'ms' THEN us // 1000 * 1000 ELSE us END AS "Time",
    CASE unit WHEN 's' THEN us // 1000000 * 1000000000 WHEN 'ms' THEN us // 1000 * 1000000
      WHEN 'us' THEN us * 1000 WHEN 'ns' THEN us * 1000 + 7 END AS time_ns
  FROM ev, (VALUES ('s'), ('ms'), ('us'), ('ns'), ('none')) t(unit)""",
)
def lp_time(spark, sf_dir):
    """The same instant in every unit, told apart by magnitude."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    stamps = {
        "s": F.call_function("div", us, F.lit(1_000_000)),
        "ms": F.call_function("div", us, F.lit(1000)),
        "us": us,
        "ns": us * 1000 + 7,
    }
    lines = [F.concat(F.lit(f"{u} f=1 "), t.cast("string")) for u, t in stamps.items()]
    log = topics.events_with(spark, sf_dir, F.concat_ws("\n", *lines, F.lit("none f=1")))
    return lp_long(log).select("offset", "partition", "_measurement", "Time", "time_ns")


def _precision_query(unit: str, per_second: int) -> None:
    sql = (
        EV
        + f"""SELECT "offset", "partition", (event_id * 1000000) // {per_second} AS "Time",
    event_id * (1000000000 // {per_second}) AS time_ns FROM ev"""
    )

    def build(spark, sf_dir):
        value = F.concat(F.lit("m f=1 "), F.col("event_id").cast("string"))
        log = topics.events_with(spark, sf_dir, value)
        long = lp_long(log, LineOptions(precision=unit))
        return long.select("offset", "partition", "Time", "time_ns")

    query(f"lp_time_{unit}", sql)(build)


for _unit, _per_second in (("s", 1), ("ms", 1000), ("us", 1_000_000), ("ns", 1_000_000_000)):
    _precision_query(_unit, _per_second)


@query(
    "lp_tags",
    """SELECT epoch_us(o_orderdate) AS "Time", 'order' AS _measurement, f AS _field,
    CASE f WHEN 'price' THEN o_totalprice ELSE o_custkey END AS value, NULL::VARCHAR AS value_str,
    o_orderstatus AS status, o_orderpriority AS priority, 'x' AS tag_value,
    CAST(o_orderkey % 4 AS INTEGER) AS "partition", o_orderkey // 4 AS "offset", NULL::VARCHAR AS error
  FROM orders, (VALUES ('price'), ('cust')) t(f)""",
)
def lp_tags(spark, sf_dir):
    """Tag columns in first-seen order; ``value`` is taken, so ``tag_value``."""
    log = topics.orders_lp(spark, sf_dir)
    return lp_wide(lp_long(log), lp_tag_keys(log))


@query(
    "lp_pivot",
    """WITH o AS (SELECT *, (o_orderkey % 4) * 1000000000000 + o_orderkey // 4 AS pos FROM orders)
  SELECT epoch_us(o_orderdate) AS "Time", 'order' AS _measurement, o_orderstatus AS status,
    arg_max(o_totalprice, pos) AS price, CAST(arg_max(o_custkey, pos) AS DOUBLE) AS cust
  FROM o GROUP BY 1, 2, 3""",
)
def lp_pivoted(spark, sf_dir):
    return lp_pivot(lp_long(topics.orders_lp(spark, sf_dir)), ["price", "cust"], by=["status"])


# --- panels ----------------------------------------------------------------

GOOD = EV + ", g AS (SELECT *, CASE WHEN NOT nulled THEN value END AS v FROM ok) "


def _good_events(spark, sf_dir) -> DataFrame:
    return _events_wide(spark, sf_dir).filter("error IS NULL")


@query("panel_select", GOOD + 'SELECT us AS time, event_type AS "event.type", v AS value FROM g')
def panel_select(spark, sf_dir):
    return panels.select_fields(_good_events(spark, sf_dir), ["time", "event.type", "value"])


@query(
    "time_range",
    GOOD
    + """SELECT us AS time, "offset", v AS value FROM g
  WHERE us BETWEEN epoch_us(TIMESTAMP '2024-01-03 00:00:00') AND epoch_us(TIMESTAMP '2024-01-10 06:00:00')""",
)
def time_range(spark, sf_dir):
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-03", "2024-01-10 06:00:00"))
    return panels.time_range(_good_events(spark, sf_dir), start, end).select("time", "offset", "value")


@query("panel_group", GOOD + 'SELECT DISTINCT event_type AS "event.type", user_id AS "event.user.id" FROM g')
def panel_group(spark, sf_dir):
    return panels.group_fields(_good_events(spark, sf_dir), ["event.type", "event.user.id"])


@query(
    "panel_last",
    GOOD
    + """SELECT user_id AS "event.user.id", arg_max(v, us * 4 + event_id % 4) AS "last"
  FROM g WHERE v IS NOT NULL GROUP BY 1""",
)
def panel_last(spark, sf_dir):
    return panels.reduce_last(_good_events(spark, sf_dir), "value", ["event.user.id"])


@query("panel_mean", GOOD + 'SELECT event_type AS "event.type", round(avg(v), 6) AS mean FROM g GROUP BY 1')
def panel_mean(spark, sf_dir):
    mean = panels.reduce_mean(_good_events(spark, sf_dir), "value", ["event.type"])
    return mean.withColumn("mean", F.round("mean", 6))


@query("panel_sum", GOOD + 'SELECT event_type AS "event.type", round(sum(v), 4) AS "sum" FROM g GROUP BY 1')
def panel_sum(spark, sf_dir):
    total = panels.footer_sum(_good_events(spark, sf_dir), "value", ["event.type"])
    return total.withColumn("sum", F.round("sum", 4))


MOVING = (
    GOOD
    + """, n AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY us, "partition", "offset") AS r,
      greatest(1, CAST(round(count(*) OVER (PARTITION BY event_type) * 0.1) AS BIGINT)) AS w,
      CASE WHEN row_number() OVER (PARTITION BY event_type ORDER BY us, "partition", "offset") = 5
        THEN 1e17 ELSE v END AS x
    FROM g)
  SELECT a.event_type AS "event.type", any_value(a.us) AS time, a."partition", a."offset",
    round(CASE WHEN count(b.x) FILTER (b.x = 1e17) > 0 THEN 0 ELSE avg(b.x) END, 9) AS moving_mean
  FROM n a JOIN n b ON a.event_type = b.event_type AND b.r BETWEEN a.r - a.w + 1 AND a.r
  GROUP BY a.event_type, a."partition", a."offset\""""
)


def _moving(spark, sf_dir) -> DataFrame:
    """The fifth value of each series is huge; means over it are not compared."""
    narrow = _good_events(spark, sf_dir).select(
        ref("event.type"), "time", "partition", "offset", "value"
    )
    fifth = F.row_number().over(Window.partitionBy(ref("event.type")).orderBy("time", "partition", "offset")) == 5
    narrow = narrow.withColumn("value", F.when(fifth, 1e17).otherwise(F.col("value")))
    mean = panels.moving_mean(narrow, "value", ["event.type"])
    shown = F.when(F.col("moving_mean") > 1e9, 0.0).otherwise(F.round("moving_mean", 9))
    return mean.drop("value").withColumn("moving_mean", shown)


@query("panel_moving_mean", MOVING)
def panel_moving_mean(spark, sf_dir):
    return _moving(spark, sf_dir)



# --- encoders ---------------------------------------------------------------

PRICE = "CAST(o_totalprice AS VARCHAR)"


def _orders(spark, sf_dir) -> DataFrame:
    return topics.table(spark, sf_dir, "orders")


@query(
    "encode_json",
    f"""SELECT o_orderkey, '{{"host.name":"' || o_orderstatus || '","metrics.cpu":' || {PRICE}
    || ',"value1":' || CASE WHEN o_custkey % 7 = 0 THEN 'null' ELSE CAST(o_custkey AS VARCHAR) END || '}}' AS flat,
  '{{"host":{{"name":"' || o_orderstatus || '"}},"metrics":{{"cpu":' || {PRICE} || '}},"value1":'
    || CASE WHEN o_custkey % 7 = 0 THEN 'null' ELSE CAST(o_custkey AS VARCHAR) END || '}}' AS nested,
  '[{{"host":{{"name":"' || o_orderstatus || '"}},"id":' || o_orderkey || '}},{{"message":"'
    || o_orderpriority || '"}}]' AS list FROM orders""",
)
def encode_json(spark, sf_dir):
    fields = {
        "host.name": F.col("o_orderstatus"),
        "metrics.cpu": F.col("o_totalprice"),
        "value1": F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")),
    }
    first = {"id": F.col("o_orderkey"), "host.name": F.col("o_orderstatus")}
    second = {"message": F.col("o_orderpriority")}
    return _orders(spark, sf_dir).select(
        "o_orderkey",
        encode.encode_json_flat(fields).cast("string").alias("flat"),
        encode.encode_json_nested(fields).cast("string").alias("nested"),
        encode.encode_json_list([first, second]).cast("string").alias("list"),
    )


@query(
    "encode_lp",
    f"""SELECT o_orderkey, 'order\\ data,priority=' || replace(o_orderpriority, ' ', '\\ ') || ',status='
    || o_orderstatus || ' price=' || {PRICE} || ',cust=' || o_custkey || 'i,note="' || o_orderpriority
    || '" ' || epoch_us(o_orderdate) // 1000000 || chr(10) || 'second cust=' || o_custkey || 'i' || chr(10)
    AS message FROM orders""",
)
def encode_lp(spark, sf_dir):
    df = _orders(spark, sf_dir)
    fields = {"price": "o_totalprice", "cust": "o_custkey", "note": "o_orderpriority"}
    tags = {"priority": "o_orderpriority", "status": "o_orderstatus"}
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    specs = [
        encode.LineSpec("order data", fields, tags, seconds),
        encode.LineSpec("second", {"cust": "o_custkey"}, {}),
    ]
    text = encode.encode_lines(specs, dict(df.dtypes))
    return df.select("o_orderkey", text.cast("string").alias("message"))


@query(
    "encode_text",
    "SELECT o_orderkey, printf('seq=%d value=%.4f status=%s', o_orderkey, o_totalprice, o_orderstatus) AS message FROM orders",
)
def encode_text(spark, sf_dir):
    columns = [F.col(c) for c in ("o_orderkey", "o_totalprice", "o_orderstatus")]
    text = encode.encode_text("seq=%d value=%.4f status=%s", *columns)
    return _orders(spark, sf_dir).select("o_orderkey", text.cast("string").alias("message"))


@query(
    "encode_key",
    """SELECT o_orderkey, 'key-' || o_orderkey AS text, '{"id":' || o_orderkey || ',"status":"'
    || o_orderstatus || '"}' AS json, printf('%016X', o_orderkey) AS bin, NULL::VARCHAR AS nothing FROM orders""",
)
def encode_key(spark, sf_dir):
    text = F.concat(F.lit("key-"), F.col("o_orderkey").cast("string"))
    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    return _orders(spark, sf_dir).select(
        "o_orderkey",
        encode.encode_key(text, "string").cast("string").alias("text"),
        encode.encode_key(record, "json").cast("string").alias("json"),
        encode.encode_key(F.col("o_orderkey"), "binary").alias("bin"),
        encode.encode_key(text, "none").cast("string").alias("nothing"),
    )


# --- Avro, Protobuf, schema registry ---------------------------------------

def _schema_table(spark: SparkSession, topic: str, rows) -> DataFrame:
    kind = "binary" if isinstance(rows[0][2], bytes) else "string"
    subject = schemas.subject_name(topic)
    return spark.createDataFrame(
        [(subject, v, i, s) for v, i, s in rows], f"subject string, version int, id bigint, schema {kind}"
    )


@query(
    "schema_by_id",
    EV
    + """SELECT "partition", "offset", event_id % 4 AS schema_id,
    CASE WHEN event_id % 4 = 0 THEN event_id END AS id,
    CASE WHEN event_id % 4 = 1 THEN event_type END AS kind,
    CASE WHEN event_id % 4 = 2 THEN CAST(k AS DOUBLE) WHEN event_id % 4 = 1 THEN k + 0.5 END AS k,
    CASE WHEN event_id % 4 = 3 THEN 'schema not found: id 3' END AS error FROM ev""",
)
def schema_by_id(spark, sf_dir):
    """Framed JSON; the registry holds a DDL for each of three ids, a fourth
    is unknown. One projection, one scan."""
    number = F.col("event_id") % 4
    k = F.get_json_object("props", "$.k").cast("bigint")
    texts = [
        F.to_json(F.struct(F.col("event_id").alias("id"))),
        F.to_json(F.struct(F.col("event_type").alias("kind"), (k + F.lit(0.5).cast("double")).alias("k"))),
        F.to_json(F.struct(k.alias("k"))),
        F.lit("{}"),
    ]
    value = F.lit(None).cast("binary")
    for i, text in enumerate(texts):
        value = F.when(number == i, wire.with_header(i, text.cast("binary"))).otherwise(value)
    log = topics.events_with(spark, sf_dir, value)
    registry = _schema_table(
        spark, "events", [(1, 0, "id bigint"), (2, 1, "kind string, k double"), (3, 2, "k bigint")]
    )
    columns = wire.header_columns(F.col("value"))
    marked = log.select("partition", "offset", columns["schema_id"].alias("schema_id"), columns["payload"].alias("payload"))
    known = schemas.topic_schemas(registry, "events")
    text = F.col("payload").cast("string")
    read = schemas.decode_by_schema(marked, known, F.from_json, text)
    return read.drop("payload")


@query(
    "wire_header",
    EV
    + """SELECT "partition", "offset", CASE WHEN event_id % 3 <> 0 THEN 4000000000 + event_id % 3 END
    AS schema_id, key_text AS payload FROM ev""",
)
def wire_header(spark, sf_dir):
    """Ids above 2^31 are read unsigned; an unframed payload is kept whole."""
    text = topics.event_key().cast("binary")
    head = [wire.with_header(4000000000 + i, text) for i in (1, 2)]
    value = (
        F.when(F.col("event_id") % 3 == 1, head[0])
        .when(F.col("event_id") % 3 == 2, head[1])
        .otherwise(text)
    )
    log = topics.events_with(spark, sf_dir, value)
    columns = wire.header_columns(F.col("value"))
    return log.select(
        "partition",
        "offset",
        columns["schema_id"].alias("schema_id"),
        columns["payload"].cast("string").alias("payload"),
    )


# fixed values: index forms as hex, the path they name and their length
INDEX_FORMS = (
    ("00", "0", 1),
    ("0105", "5", 2),
    ("020103", "1.3", 3),
    ("01AC02", "300", 3),
    ("0B0200", "11.2", 3),
    ("05", "5", 1),
    ("01FFFFFFFFFFFFFFFFFF01", None, None),
    ("05FFFFFFFFFFFFFFFFFF01", None, None),
)


@query(
    "wire_index",
    EV
    + f'SELECT "partition", "offset", CASE event_id % {len(INDEX_FORMS)} '
    + " ".join(f"WHEN {i} THEN '{p}'" for i, (_, p, _) in enumerate(INDEX_FORMS) if p)
    + f" END AS path, CASE event_id % {len(INDEX_FORMS)} "
    + " ".join(f"WHEN {i} THEN {n}" for i, (_, _, n) in enumerate(INDEX_FORMS) if n)
    + " END AS skip FROM ev",
)
def wire_index(spark, sf_dir):
    """Every form of the message index; two overflow and have no path."""
    value = F.lit(None).cast("binary")
    for i, (text, _, _) in enumerate(INDEX_FORMS):
        tail = bytes.fromhex(text) + (b"" if text == "05" else b"\xff\x01\x00")
        value = F.when(F.col("event_id") % len(INDEX_FORMS) == i, F.lit(bytearray(tail))).otherwise(value)
    log = topics.events_with(spark, sf_dir, value)
    index = wire.message_index(F.col("value"))
    return log.select(
        "partition",
        "offset",
        F.array_join(index["path"].cast("array<string>"), ".").alias("path"),
        index["skip"].alias("skip"),
    )


@query(
    "schema_latest",
    """SELECT c_mktsegment || '-value' AS subject, CAST(max(c_custkey) AS INTEGER) AS version,
    max(c_custkey) AS id, arg_max(c_name, c_custkey) AS "schema" FROM customer GROUP BY 1""",
)
def schema_latest(spark, sf_dir):
    """A registry with many versions: customers as schemas of their segment."""
    registry = topics.table(spark, sf_dir, "customer").select(
        F.concat("c_mktsegment", F.lit("-value")).alias("subject"),
        F.col("c_custkey").cast("int").alias("version"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("schema"),
    )
    return schemas.latest_schemas(registry)


# --- streams ----------------------------------------------------------------


def _stored_events(spark: SparkSession, sf_dir: str) -> TopicSource:
    source = TopicSource(path=scratch(spark))
    write_topic(topics.events_log(spark, sf_dir), source)
    return source


@query(
    "stream_long",
    LONG
    + f"""SELECT "partition", "offset", path, type, v_long, v_double, v_str, NULL AS error FROM leaf
  UNION ALL SELECT "partition", "offset", NULL, NULL, NULL, NULL, NULL, {MALFORMED} FROM ev WHERE bad""",
)
def stream_long(spark, sf_dir):
    """The long shape as a file stream, read back from its sink."""
    wanted = TopicQuery("events", offset="earliest", shape="long")
    options = StreamOptions(scratch(spark), available_now=True)
    out = scratch(spark)
    frame = stream_frame(spark, wanted, _stored_events(spark, sf_dir), options=options)
    start_stream(frame, wanted, options, path=out).awaitTermination()
    return spark.read.parquet(out).drop("time", "v_bool")


@query(
    "frame_sink",
    EV
    + f"""SELECT us AS time, "offset", "partition", event_type AS "event.type", user_id AS "event.user.id",
    k AS "props.k", '["a","b"]' AS tags, CASE WHEN NOT nulled THEN value END AS value, NULL AS error FROM ok
  UNION ALL SELECT us, "offset", "partition", NULL, NULL, NULL, NULL, NULL, {MALFORMED} FROM ev WHERE bad""",
)
def frame_sink(spark, sf_dir):
    """The wide shape as a stream: good and error rows under one commit."""
    options = StreamOptions(scratch(spark), available_now=True)
    path = scratch(spark)
    frame = stream_frame(
        spark, EVENTS, _stored_events(spark, sf_dir), fields=EVENT_COLUMNS, options=options
    )
    start_stream(frame, EVENTS, options, journal_path=path).awaitTermination()
    parts = [read_journal(spark, path, EVENTS.fingerprint(), frame.schema, table) for table in ("rows", "errors")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)
