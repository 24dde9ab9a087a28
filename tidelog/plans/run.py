"""From a :class:`TopicQuery` to a DataFrame, batch or stream."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import wire
from tidelog.functions.columns import is_empty, ref
from tidelog.operators import decode, naming, protobuf
from tidelog.operators.avro import FAILED as AVRO_FAILED
from tidelog.operators.avro import avro_body
from tidelog.operators.flatten import (
    explode_leaves,
    left_over,
    merge_key_leaves,
    text_leaves,
)
from tidelog.operators.infer import find_fields
from tidelog.operators.lineprotocol import LineOptions, lp_long, lp_tag_keys, lp_wide
from tidelog.operators.wide import (
    RESERVED,
    FieldSpec,
    column_names,
    in_column_order,
    json_error,
    wide_reader,
)
from tidelog.plans.query import TopicQuery
from tidelog.session import configure
from tidelog.sources import manifest
from tidelog.sources.manifest import is_managed
from tidelog.sources.offsets import after_high_water, last_n, offset_bounds, select_partitions
from tidelog.sources.schemas import decode_by_schema, latest_schema, topic_schemas
from tidelog.sources.topic import TopicNotFound, TopicSource, drop_control_records, read_topic


#: The queries a row goes to, where several share a scan.
ROUTES = "_routes"


def run(
    spark: SparkSession,
    query: TopicQuery,
    source: TopicSource | DataFrame,
    *,
    fields: Sequence[FieldSpec] | None = None,
    key_fields: Sequence[FieldSpec] | None = None,
    tag_keys: Sequence[str] | None = None,
    schemas: DataFrame | None = None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Run ``query`` over a topic source or a topic DataFrame.

    The wide shapes need their columns: ``fields`` (``key_fields`` for a JSON
    key) or ``tag_keys``. In batch they are looked up from the topic when not
    given; a stream must be given them.
    """
    configure(spark)
    df = messages(spark, query, source, bounds)
    return shaped(df, query, fields=fields, key_fields=key_fields, tag_keys=tag_keys, schemas=schemas)


def shaped(
    df: DataFrame,
    query: TopicQuery,
    *,
    fields: Sequence[FieldSpec] | None = None,
    key_fields: Sequence[FieldSpec] | None = None,
    tag_keys: Sequence[str] | None = None,
    schemas: DataFrame | None = None,
) -> DataFrame:
    """The messages of ``df`` decoded, shaped and named as ``query`` says."""
    if query.format == "lineprotocol":
        return _name(_line_protocol(df, query, tag_keys), query, "Time")
    if query.format == "plaintext":
        plain = decode.decode_plaintext(df)
        rows = _fixed(plain, query, {"message": F.col("message")}, F.lit(None).cast("string"), key_fields)
    elif query.format == "json":
        if query.shape == "long":
            return _name(json_long(df, query), query, "time")
        if query.shape == "variant":
            body = decode.decode_json(df)
            rows = _fixed(body, query, {"body": F.col("body")}, F.col("error"), key_fields)
        else:
            rows = json_wide(df, query, fields, key_fields)
    else:
        rows = _binary(df, query, schemas, key_fields)
    return _name(rows, query, "time")


def messages(
    spark: SparkSession,
    query: TopicQuery,
    source: TopicSource | DataFrame,
    bounds: DataFrame | None = None,
    stream: bool = False,
) -> DataFrame:
    """The messages a query reads: topic, partitions, start, times, no markers.

    A topic that a table does not have is an error. A table with a manifest
    answers for bounds and partitions, and only files that may hold wanted
    messages are read.
    """
    count = None
    if is_managed(source):
        if stream:
            raise ValueError("a table with a manifest is read in batch")
        df, bounds, count = _managed(spark, query, source, bounds)
    elif isinstance(source, TopicSource):
        options = _kafka_times(query) if source.kind == "kafka" and not stream else {}
        df = read_topic(spark, source, query.topic, stream=stream, partition=query.partition, options=options)
        if source.kind == "table" and not stream and df.isEmpty():
            raise TopicNotFound(f"topic {query.topic} not found")
    else:
        df = source.filter(F.col("topic") == query.topic)
    df = select_partitions(df, query.partition, count)
    if query.offset == "last_n":
        df = last_n(df, query.last_n, bounds)
    elif query.offset == "latest" and not df.isStreaming:
        if bounds is None:
            raise ValueError("latest reads what is newer than given offset bounds; give them or use earliest")
        df = after_high_water(df, bounds)
    if query.start_time is not None:
        df = df.filter(F.col("timestamp") >= F.lit(query.start_time))
    if query.end_time is not None:
        df = df.filter(F.col("timestamp") <= F.lit(query.end_time))
    return drop_control_records(df) if query.drop_control else df


def _kafka_times(query: TopicQuery) -> dict[str, str]:
    """Reader options that let the broker find the offsets of a time window."""
    bounds = {"startingTimestamp": query.start_time, "endingTimestamp": query.end_time}
    return {name: str(int(time.timestamp() * 1000) + (name[0] == "e")) for name, time in bounds.items() if time is not None}


def _managed(
    spark: SparkSession, query: TopicQuery, source: TopicSource, given: DataFrame | None
) -> tuple[DataFrame, DataFrame | None, int]:
    """Messages of the files a query may need, the bounds of its topic and the
    number of its partitions."""
    rows = manifest.zones(spark, source.path).filter(F.col("topic") == query.topic)
    numbers = manifest.partitions_of(rows, query.topic)
    bounds, starts = given, None
    if query.offset == "last_n":
        bounds = manifest.bounds(rows) if given is None else given
        mine = bounds.filter(F.col("topic") == query.topic).collect()
        back = query.last_n
        starts = {r["partition"]: max(r["latest"] - back, r["earliest"]) for r in mine}
        bounds = spark.createDataFrame(mine, bounds.schema)
    elif query.offset == "latest" and given is not None:
        mine = given.filter(F.col("topic") == query.topic).collect()
        starts = dict.fromkeys(numbers, 0) | {r["partition"]: r["latest"] for r in mine}
        bounds = spark.createDataFrame(mine, given.schema)
    partition = query.partition if query.partition in numbers else "all"
    df = manifest.read_files(spark, source.path, query.topic, partition, starts, query.start_time, query.end_time)
    return df, bounds, numbers[-1] + 1


def _time(query: TopicQuery, error: Column) -> Column:
    """Error rows keep the message time in either mode."""
    if query.time_mode == "now":
        return F.when(error.isNull(), F.current_timestamp()).otherwise(F.col("timestamp"))
    return F.col("timestamp")


def _partition(query: TopicQuery) -> list[str]:
    return ["partition"] if query.partition == "all" else []


def _key_specs(df: DataFrame, query: TopicQuery, given: Sequence[FieldSpec] | None):
    if query.key_format != "json":
        return []
    if given is None:
        options = query.flatten
        given = find_fields(df, "key", options, prefix="key")
    return in_column_order(given)


class _Key:
    """Columns of the message key; a JSON key is read in two steps."""

    def __init__(self, df: DataFrame, query: TopicQuery, given: Sequence[FieldSpec] | None):
        self.format = query.key_format
        self.specs = _key_specs(df, query, given)
        inner = [
            FieldSpec(s.path.removeprefix("key."), s.type, s.mixed, s.depths, s.segments) for s in self.specs
        ]
        self.reader = wide_reader(inner) if inner else None

    def parsed(self) -> list[Column]:
        return [self.reader.parsed(F.col("key")).alias("_key")] if self.reader else []

    def columns(self) -> dict[str, Column]:
        if self.format in ("string", "base64"):
            return {"key": decode.key_text(F.col("key"), self.format)}
        if self.reader is None:
            return {}
        found = self.reader.columns("_key", F.col("key"))
        return {f"key.{path}": column for path, column in found.items()}


def _assemble(
    df: DataFrame,
    query: TopicQuery,
    key: _Key,
    values: dict[str, Column],
    error: Column,
    extra: Column | None = None,
) -> DataFrame:
    """``time, [partition], offset, key fields, value fields, [extra], error``;
    of a key and a value field with one name the value stays. Routes go along."""
    keys = {n: c for n, c in key.columns().items() if n not in values}
    good = error.isNull()
    shown = {n: F.when(good, c) for n, c in sorted(keys.items(), key=lambda i: i[0].encode())}
    taken = RESERVED if extra is None else (*RESERVED, "extra")
    names = column_names([*shown, *values], taken)
    return df.select(
        _time(query, error).alias("time"),
        *_partition(query),
        "offset",
        *[c.alias(names[n]) for n, c in shown.items()],
        *[c.alias(names[n]) for n, c in values.items()],
        *([] if extra is None else [F.when(good, extra).alias("extra")]),
        error.alias("error"),
        *_carried(df),
    )


def _carried(df: DataFrame) -> list[str]:
    return [ROUTES] if ROUTES in df.columns else []


def _fixed(
    df: DataFrame,
    query: TopicQuery,
    values: dict[str, Column],
    error: Column,
    key_fields: Sequence[FieldSpec] | None,
) -> DataFrame:
    key = _Key(df, query, key_fields)
    return _assemble(df.select("*", *key.parsed()), query, key, values, error)


def json_wide(
    df: DataFrame,
    query: TopicQuery,
    fields: Sequence[FieldSpec] | None = None,
    key_fields: Sequence[FieldSpec] | None = None,
) -> DataFrame:
    """Wide shape of a JSON topic. One tokenizer pass reads all columns; a
    payload is judged a second time only if that pass met something odd."""
    if fields is None:
        options = query.flatten
        fields = find_fields(df, "value", options)
    reader = wide_reader(fields)
    key = _Key(df, query, key_fields)
    parsed = df.select("*", reader.parsed(F.col("value")).alias("_record"), *key.parsed())
    error = F.when(reader.suspect("_record"), json_error(F.col("value")))
    judged = parsed.withColumn("_error", error)
    found = reader.columns("_record", F.col("value"))
    values = {s.path: found[s.path] for s in in_column_order(fields)}
    extra = left_over(text_leaves(F.col("value"), query.flatten), list(values)) if query.extra else None
    return _assemble(judged, query, key, values, F.col("_error"), extra)


def json_long(df: DataFrame, query: TopicQuery) -> DataFrame:
    """Long shape of a JSON topic: one row per leaf, one per failed message.

    A good message without leaves has no row."""
    items = text_leaves(F.col("value"), query.flatten)
    if query.key_format == "json":
        keys = decode.key_leaves(F.col("key"), "json", query.flatten)
        items = merge_key_leaves(items, keys)
    topic = ["topic", "partition", "offset", "timestamp"]
    kept = df.select(*topic, "key", "value", *_carried(df), items.alias("_items"))
    error = F.when(F.col("_items").isNull(), json_error(F.col("value")))
    judged = kept.select(*topic, "key", error.alias("error"), *_carried(df), "_items")
    leaves = explode_leaves(judged, "_items", keep_empty=True).filter(
        F.col("path").isNotNull() | F.col("error").isNotNull()
    )
    key = (
        [decode.key_text(F.col("key"), query.key_format).alias("key")]
        if query.key_format in ("string", "base64")
        else []
    )
    return leaves.select(
        _time(query, F.col("error")).alias("time"),
        "partition",
        "offset",
        *key,
        "path",
        "type",
        "v_long",
        "v_double",
        "v_bool",
        "v_str",
        "error",
        *_carried(df),
    )


def _line_protocol(df: DataFrame, query: TopicQuery, tag_keys: Sequence[str] | None) -> DataFrame:
    options = LineOptions(
        query.lp_precision,
        query.time_mode,
        query.lp_measurements,
        query.lp_fields,
        query.lp_tags,
    )
    long = lp_long(df, options)
    if query.shape != "wide":
        return long
    if tag_keys is None:
        tag_keys = lp_tag_keys(df, options, query.flatten.field_cap)
    return lp_wide(long, tag_keys, query.partition == "all")


# keeps decoded columns apart from the topic's own until the layout is made
_BODY = "\u0001body."


def _message(payload: Column, descriptor_set: bytes, name: str | None, spark: SparkSession) -> Column:
    """The named message, or a union of all messages of the file by their
    index path, of which a payload fills the one its header names."""
    if name is not None:
        return protobuf.protobuf_body(payload, descriptor_set, name, spark)
    first = F.when(F.col("_path").isNull(), payload)
    members = [protobuf.protobuf_body(first, descriptor_set, protobuf.message_at(descriptor_set), spark)]
    for path in protobuf.message_paths(descriptor_set):
        here = F.col("_path") == F.array(*[F.lit(i).cast("bigint") for i in path])
        named = protobuf.message_at(descriptor_set, path)
        members.append(protobuf.protobuf_body(F.when(here, payload), descriptor_set, named, spark))
    some = F.lit(False)
    for m in members:
        some = some | m.isNotNull()
    return F.when(some, F.struct(*[m.alias(f"member{i}") for i, m in enumerate(members)]))


def _binary(
    df: DataFrame,
    query: TopicQuery,
    schemas: DataFrame | None,
    key_fields: Sequence[FieldSpec] | None,
) -> DataFrame:
    """Avro and Protobuf: an inline schema, the one each header names, or for
    unframed payloads the latest of the topic's subject."""
    spark = df.sparkSession
    avro = query.format == "avro"
    if query.schema_source == "inline" and not query.schema:
        raise ValueError("an inline schema was selected but none was given")
    if query.schema_source != "inline" and schemas is None:
        raise ValueError("a registry schema needs the schemas table")
    framed = wire.has_header(F.col("value"), query.wire_format)
    if query.schema_source == "inline":
        known, unframed, number = {}, query.schema, F.lit(None)
    else:
        known, number = topic_schemas(schemas, query.topic), F.when(framed, wire.schema_id(F.col("value")))
        unframed = latest_schema(schemas, query.topic)
    if avro:
        marked = df.withColumn("_payload", F.when(~is_empty(F.col("value")), wire.body(F.col("value"), query.wire_format)))
    else:
        payload, path, bad = protobuf.framed_payload(F.col("value"), query.wire_format)
        marked = df.withColumn("_payload", payload).withColumn("_path", path).withColumn("_bad", bad)

    def read(payload: Column, schema: str | bytes) -> Column:
        if avro:
            return avro_body(payload, schema, spark)
        return _message(payload, bytes(schema), query.message_name, spark)

    marked = marked.withColumn("schema_id", number.cast("bigint"))
    failed = AVRO_FAILED if avro else protobuf.FAILED
    flat = decode_by_schema(marked, known, read, F.col("_payload"), unframed, failed, query.flatten, _BODY)
    if not avro:
        flat = flat.withColumn("error", F.when(F.col("_bad"), protobuf.BAD_INDEX).otherwise(F.col("error")))
    flat = flat.drop("schema_id", "_payload", "_path", "_bad")
    paths = [c.removeprefix(_BODY) for c in flat.columns if c.startswith(_BODY)]
    values = {p: ref(_BODY + p) for p in sorted(paths, key=str.encode)}
    return _fixed(flat, query, values, F.col("error"), key_fields)


def _name(df: DataFrame, query: TopicQuery, time: str) -> DataFrame:
    """Alias and ref id. A long table has one series per path or field."""
    if query.alias:
        field = next((c for c in ("path", "_field") if c in df.columns), None)
        if field is not None:
            partition = F.col("partition") if "partition" in df.columns else F.lit(0)
            name = naming.series_name(
                query.alias, F.lit(query.topic), partition, query.ref_id, F.col(field)
            )
            df = df.withColumn("series", name)
        else:
            df = naming.with_display_names(df, query.alias, query.topic, query.ref_id, time)
    return naming.with_ref_id(df, query.ref_id) if query.ref_id else df


def run_many(
    spark: SparkSession, queries: Sequence[TopicQuery], source: TopicSource | DataFrame, **options
) -> DataFrame:
    """Union of several queries, told apart by ``ref_id``; invalid ones are
    skipped. Columns with one name and different types widen: numbers to
    double, anything else to text."""
    valid = [q for q in queries if q.is_valid]
    if not valid:
        raise ValueError("no valid query")
    return _union([naming.with_ref_id(run(spark, q, source, **options), q.ref_id) for q in valid])


def _union(parts: list[DataFrame]) -> DataFrame:
    types: dict[str, set[str]] = {}
    for part in parts:
        for f in part.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    aligned = [
        part.select(
            *[
                ref(f.name).cast(_common(types[f.name])).alias(f.name)
                if len(types[f.name]) > 1
                else ref(f.name)
                for f in part.schema.fields
            ]
        )
        for part in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


def _common(kinds: set[str]) -> T.DataType:
    return T.DoubleType() if kinds <= {"bigint", "int", "double"} else T.StringType()


def run_shared(
    spark: SparkSession, queries: Sequence[TopicQuery], source: TopicSource | DataFrame, **options
) -> DataFrame:
    """The rows of :func:`run_many`, with one scan and one parse for all queries
    that decode a topic in the same way.

    Each message is marked with the queries that want it (by partition, start,
    times), parsed once if there is any, and its rows go to each of them; the
    line filters of a query are asked when its rows are there. Queries that
    differ in anything else, another topic included, have a scan of their own,
    and so have those in binary formats and of line protocol in the wide shape,
    whose columns follow from their filters. Names of wide columns are not
    kept; long rows have their series.
    """
    configure(spark)
    valid = [q for q in queries if q.is_valid]
    if not valid:
        raise ValueError("no valid query")
    groups: dict[object, list[TopicQuery]] = {}
    for number, q in enumerate(valid):
        apart = q.format in ("avro", "protobuf") or (q.format, q.shape) == ("lineprotocol", "wide")
        groups.setdefault(number if apart else _decoding(q), []).append(q)
    parts = []
    for members in groups.values():
        if len(members) > 1:
            parts.append(_routed(spark, _decoding(members[0]), members, source, options))
        else:
            parts.append(naming.with_ref_id(run(spark, members[0], source, **options), members[0].ref_id))
    return _union(parts)


def _decoding(query: TopicQuery) -> TopicQuery:
    """What queries that share a parse have in common."""
    return replace(
        query, partition="all", offset="earliest", last_n=0, start_time=None, end_time=None,
        lp_measurements="", lp_fields="", lp_tags="", ref_id="", alias="",
    )


def _wants(query: TopicQuery, bounds: DataFrame | None) -> Column:
    """Whether a query wants a message; the same tests as in :func:`messages`."""
    tests = [] if query.partition == "all" else [F.col("partition") == int(query.partition)]
    if query.offset != "earliest":
        starts = []
        for r in bounds.filter(F.col("topic") == query.topic).collect():
            first = r["latest"] if query.offset == "latest" else max(r["latest"] - query.last_n, r["earliest"])
            starts += [F.lit(r["partition"]), F.lit(first)]
        start = F.try_element_at(F.create_map(*starts).cast("map<int,bigint>"), F.col("partition"))
        # a partition without bounds is new as a whole, and has no last messages
        tests.append(F.coalesce(F.col("offset") >= start, F.lit(query.offset == "latest")))
    if query.start_time is not None:
        tests.append(F.col("timestamp") >= F.lit(query.start_time))
    if query.end_time is not None:
        tests.append(F.col("timestamp") <= F.lit(query.end_time))
    return reduce(and_, tests, F.lit(True))


def _marked(routes: list[Column | None]) -> Column:
    """The numbers of the routes that hold."""
    numbers = [F.when(test, F.lit(i)) for i, test in enumerate(routes)]
    return F.filter(F.array(*numbers), lambda i: i.isNotNull())


def _routed(
    spark: SparkSession, base: TopicQuery, members: list[TopicQuery], source: TopicSource | DataFrame, options: dict
) -> DataFrame:
    options = dict(options)
    bounds = options.pop("bounds", None)
    wide = dict.fromkeys(("start_time", "end_time"))
    if all(q.start_time for q in members):
        wide["start_time"] = min(q.start_time for q in members)
    if all(q.end_time for q in members):
        wide["end_time"] = max(q.end_time for q in members)
    if any(q.offset == "latest" for q in members) and bounds is None:
        raise ValueError("latest reads what is newer than given offset bounds; give them or use earliest")
    df = messages(spark, replace(base, **wide), source)
    count = None
    if is_managed(source):
        count = manifest.partitions_of(manifest.zones(spark, source.path), base.topic)[-1] + 1
    numbers = [q.partition for q in members if q.partition != "all"]
    if numbers:
        # one look at the highest; the others are only checked against it
        select_partitions(df, max(numbers), count)
        for p in numbers:
            select_partitions(df, p, int(max(numbers)) + 1)
    if any(q.offset == "last_n" for q in members) and bounds is None:
        bounds = manifest.bounds(manifest.zones(spark, source.path)) if is_managed(source) else offset_bounds(df)
        bounds = spark.createDataFrame(bounds.filter(F.col("topic") == base.topic).collect(), bounds.schema)
    df = df.withColumn(ROUTES, _marked([_wants(q, bounds) for q in members])).filter(F.size(ROUTES) > 0)
    rows = shaped(df, base, **options)
    if base.format == "lineprotocol":
        rows = rows.withColumn(ROUTES, _marked([_lets_through(spark, q, i) for i, q in enumerate(members)]))
    at = "_route"
    rows = rows.withColumn(at, F.explode(ROUTES)).drop(ROUTES)
    always = base.format == "lineprotocol" or (base.format, base.shape) == ("json", "long")
    if not always and "partition" in rows.columns:
        # a query of one partition does not show it
        every = F.array(*[F.lit(q.partition == "all") for q in members])
        rows = rows.withColumn("partition", F.when(F.get(every, F.col(at)), F.col("partition")))
    field = next((c for c in ("path", "_field") if c in rows.columns), None)
    if field is not None and any(q.alias for q in members):
        partition = F.col("partition") if "partition" in rows.columns else F.lit(0)
        named = [
            naming.series_name(q.alias, F.lit(q.topic), partition, q.ref_id, F.col(field)) if q.alias else F.lit(None)
            for q in members
        ]
        rows = rows.withColumn("series", F.get(F.array(*named), F.col(at)))
    refs = F.array(*[F.lit(q.ref_id) for q in members])
    return rows.withColumn("ref_id", F.get(refs, F.col(at))).drop(at)


def _lets_through(spark: SparkSession, query: TopicQuery, number: int) -> Column:
    """Whether a row of a long table goes to a route that its message goes to."""
    lines = LineOptions(measurements=query.lp_measurements, fields=query.lp_fields, tags=query.lp_tags).filter
    tests = [lines.on_line(spark, F.col("_measurement"), F.col("tags")), lines.on_field(spark, F.col("_field"))]
    passed = reduce(and_, [t for t in tests if t is not None], F.lit(True))
    bad = F.col("error").isNotNull() & (F.col("_measurement") == "")
    return F.array_contains(ROUTES, number) & (bad | passed)
