"""Line protocol to a long table, one row per field.

The lines of a message stay in the row until every line has been judged, so
"one bad value spoils its line" and "no good line makes an error row" need no
shuffle. Two explodes follow: lines, then fields. Each is also a barrier that
keeps the regular expressions from being evaluated twice.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import lp_patterns as P
from tidelog.functions.columns import let, line_order, message_order, rarely, ref
from tidelog.functions.lp_errors import line_error
from tidelog.functions.lp_values import field_value, is_bad
from tidelog.operators.flatten import DEFAULT_CAP
from tidelog.operators.lp_filter import LineFilter

RESERVED = ("Time", "_measurement", "_field", "value", "value_str", "partition", "offset", "error")
NO_LINES = "lineprotocol payload produced no parseable lines"
OUT_OF_RANGE = "timestamp out of range"

_TO_END = (1 << 31) - 1
_EMPTY_MAP = "map<string,string>"
# The two encodings of a line between the explodes, told apart by the start:
#   MARK, then measurement, tags, fields and timestamp separated by MARK (all
#   four empty for a line to skip)
#   NEW_LINE and a letter, then the sections (or the error) separated by NEW_LINE
_NEW_LINE = "\n"
_GENERAL, _ERROR = "\nG", "\nE"
_SKIPPED = P.MARK * 4
_MARKED = P.MARK + P.MARK.join(f"${i}" for i in range(1, 5))
_SECTIONS = "$1\n$2\n$3\n$4\n"


@dataclass(frozen=True)
class LineOptions:
    precision: str = "auto"
    time_mode: str = "message"
    measurements: str = ""
    fields: str = ""
    tags: str = ""

    @property
    def filter(self) -> LineFilter:
        return LineFilter(self.measurements, self.fields, self.tags)


def _judge(raw: Column) -> Column:
    """Sections of one line by the full grammar: five entries for a good line,
    one for a bad line, NULL for a blank line or a comment."""

    def keep_valid(parts: Column) -> Column:
        pairs = F.regexp_extract_all(parts[2], F.lit(P.EACH_FIELD), F.lit(1))
        bad_value = F.exists(pairs, lambda kv: let(F.regexp_extract(kv, P.SPLIT_FIELD, 2), is_bad))
        bad_time = (parts[3] != "") & parts[3].try_cast("bigint").isNull()
        return F.when(F.size(parts) > 1, F.when(~bad_value & ~bad_time, parts))

    def by_grammar(line: Column) -> Column:
        parts = F.split(F.regexp_replace(line, P.ANY_LINE, _SECTIONS), "\n")
        judged = F.coalesce(let(parts, keep_valid), F.array(line))
        return F.when((line != "") & ~line.startswith("#"), judged)

    return let(F.trim(raw, F.lit(P.SPACES)), by_grammar)


def _general_lines(text: Column) -> Column:
    """The lines of a message that has any uncommon line, encoded; one error
    entry when none is good."""

    def encode(lines: Column) -> Column:
        good = F.exists(lines, lambda p: F.size(p) > 1)
        # skipped lines are NULL entries, so a position is still a line number
        number = F.array_position(
            F.transform(lines, lambda p: F.when(p.isNull(), 0).otherwise(F.size(p))), 1
        )
        bad = F.when(number > 0, F.get(F.get(lines, (number - 1).cast("int")), 0)).otherwise("")
        sections = F.transform(
            lines,
            lambda p: F.when(F.size(p) > 1, F.concat(F.lit(_GENERAL), F.array_join(p, _NEW_LINE))),
        )
        error = F.concat(F.lit(_ERROR), bad, F.lit(_NEW_LINE), number.cast("string"))
        return F.when(good, sections).otherwise(F.array(error))

    return let(F.transform(F.split(text, _NEW_LINE), _judge), encode)


def parse_lines(df: DataFrame, value: str = "value", unwanted: str | None = None) -> DataFrame:
    """One row per good line, or one per message without any.

    Adds ``line`` (0-based) and ``_parts`` and drops ``value``. Null and empty
    payloads give no rows; bad lines beside good ones are left out.

    One regular expression marks the common lines of the whole message. Only a
    message with another kind of line is judged line by line. Lines that match
    ``unwanted`` are made blank before that; a message without others counts
    as good if its first line is one, and is judged whole if not.
    """
    keep = [c for c in df.columns if c != value]
    text = F.col(value).cast("string")
    slim = text if unwanted is None else F.regexp_replace(text, unwanted, "")
    marked = df.select(
        *keep,
        value,
        F.regexp_replace(F.rtrim(slim, F.lit(_NEW_LINE)), P.PLAIN_LINE, _MARKED).alias("_marked"),
    )
    # Nothing but marked lines: taking their starts away leaves no line end.
    # One of them must be a line with a measurement.
    started = F.concat(F.lit(_NEW_LINE), F.col("_marked"))
    rest = F.replace(started, F.lit(_NEW_LINE + P.MARK), F.lit(""))
    any_line = F.col("_marked").rlike(f"{P.MARK}[^{P.MARK}\n]")
    all_common = ~rest.contains(_NEW_LINE) & ~text.contains(P.MARK) & any_line
    encoded = F.when(all_common, F.split("_marked", _NEW_LINE))
    if unwanted is not None:
        nothing_left = (F.col("_marked") == "") | (~any_line & ~rest.contains(_NEW_LINE))
        encoded = encoded.when(nothing_left & text.rlike(P.GOOD_START), F.array(F.lit(_SKIPPED)))
    # no filter before: it would build a payload made by expressions twice
    filled = F.octet_length(value) > 0
    encoded = F.when(filled, encoded.otherwise(rarely(text, _general_lines)))
    lines = marked.select(*keep, F.posexplode_outer(encoded).alias("line", "_parts"))
    return lines.filter(F.col("_parts") != _SKIPPED)


def _ident(raw: Column) -> Column:
    return F.when(raw.contains("\\"), F.regexp_replace(raw, r"\\([ ,=])", "$1")).otherwise(raw)


def _empty_tags() -> Column:
    return F.create_map().cast(_EMPTY_MAP)


def _tag_map(tags: Column, general: Column) -> Column:
    def by_grammar(text: Column) -> Column:
        names = F.regexp_extract_all(text, F.lit(P.EACH_TAG), F.lit(1))
        texts = F.regexp_extract_all(text, F.lit(P.EACH_TAG), F.lit(2))
        return F.map_from_arrays(F.transform(names, _ident), F.transform(texts, _ident))

    plain = F.str_to_map(F.substring(tags, 2, _TO_END), F.lit(","), F.lit("="))
    return F.when(tags == "", _empty_tags()).when(general, rarely(tags, by_grammar)).otherwise(plain)


def _field_list(fields: Column, general: Column) -> Column:
    def by_grammar(text: Column) -> Column:
        return F.regexp_extract_all(text, F.lit(P.EACH_FIELD), F.lit(1))

    by_quote = F.regexp_extract_all(fields, F.lit(P.EACH_PLAIN_FIELD), F.lit(1))
    return (
        F.when(general, rarely(fields, by_grammar))
        .when(fields.contains('"'), by_quote)
        .otherwise(F.split(fields, ","))
    )


def line_columns(lines: DataFrame) -> DataFrame:
    """Decode ``_parts`` of :func:`parse_lines` into ``_measurement, tags,
    _fields, _ts, error``."""
    keep = [c for c in lines.columns if c != "_parts"]
    code = F.col("_parts")
    common = code.startswith(P.MARK)
    split = lines.select(
        *keep,
        F.when(common, F.lit("")).otherwise(F.substring(code, 1, 2)).alias("_kind"),
        F.when(common, F.split(F.substring(code, 2, _TO_END), P.MARK))
        .otherwise(F.split(F.substring(code, 3, _TO_END), _NEW_LINE))
        .alias("_parts"),
    )
    parts = F.col("_parts")
    good = F.col("_kind") != _ERROR
    unusual = F.col("_kind") == _GENERAL
    # get, not []: a filter on these columns may be evaluated on error rows too
    name, tags, fields, ts = (F.get(parts, i) for i in range(4))
    return split.select(
        *keep,
        F.when(good, _ident(name)).otherwise("").alias("_measurement"),
        F.when(good, _tag_map(tags, unusual | tags.contains("\\")))
        .otherwise(_empty_tags())
        .alias("tags"),
        F.when(good, _field_list(fields, unusual | fields.contains("\\"))).alias("_fields"),
        F.when(good & (ts != ""), ts.cast("bigint")).alias("_ts"),
        F.when(
            ~good,
            rarely(parts, lambda p: line_error(F.get(p, 0), F.get(p, 1).cast("bigint"), NO_LINES)),
        ).alias("error"),
    )


def filtered_lines(df: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """Decoded lines that pass the measurement and tag filters; error rows stay.

    Lines that cannot pass any of the filters are left out unparsed, those of
    the field filter too: a line without a wanted field has no row."""
    lines = line_columns(parse_lines(df, unwanted=options.filter.other_lines(df.sparkSession)))
    test = options.filter.on_line(df.sparkSession, F.col("_measurement"), F.col("tags"))
    if test is None:
        return lines
    # one inline per line keeps the filter above the columns it tests; pushed
    # below them it would build every tag map twice
    row = F.struct(*[F.col(c) for c in lines.columns])
    held = lines.select(F.inline(F.array(row)))
    return held.filter(F.col("error").isNotNull() | test)


_SCALE_TO_MICROS = {"us": 1, "ms": 1_000, "s": 1_000_000}


def _scaled(ts: Column, scale: int) -> Column:
    bound = ((1 << 63) - 1) // scale
    return F.when(ts.between(-bound, bound), ts * F.lit(scale).cast("bigint"))


def _micros(ts: Column, unit: str) -> Column:
    if unit == "ns":
        below = F.when(ts % 1000 < 0, 1).otherwise(0)
        return F.call_function("div", ts, F.lit(1000)) - below
    return _scaled(ts, _SCALE_TO_MICROS[unit])


def _nanos(ts: Column, unit: str) -> Column:
    return ts if unit == "ns" else _scaled(ts, _SCALE_TO_MICROS[unit] * 1000)


def _by_unit(ts: Column, precision: str, convert) -> Column:
    if precision != "auto":
        return convert(ts, precision)

    def at_least(n: int) -> Column:
        return (ts >= n) | (ts <= -n)

    return (
        F.when(at_least(10**18), convert(ts, "ns"))
        .when(at_least(10**15), convert(ts, "us"))
        .when(at_least(10**12), convert(ts, "ms"))
        .otherwise(convert(ts, "s"))
    )


def line_time(ts: Column, message_time: Column, options: LineOptions) -> tuple[Column, Column]:
    """``Time`` and ``time_ns`` of a line; an instant out of range is NULL.

    A line without a timestamp takes the message time. ``time_ns`` keeps what
    a microsecond TIMESTAMP cannot.
    """
    if options.time_mode == "now":
        return F.current_timestamp(), F.lit(None).cast("bigint")
    instant = F.timestamp_micros(_by_unit(ts, options.precision, _micros))
    nanos = F.when(ts.isNotNull(), _by_unit(ts, options.precision, _nanos))
    return F.when(ts.isNull(), message_time).otherwise(instant), nanos


def _is_simple(pair: Column) -> Column:
    """By bytes; only a quoted value or an escaped name can hold another "="."""
    return ~pair.endswith('"') & ~pair.contains("\\")


def _field_name(pair: Column) -> Column:
    # most pairs with another "=" are quoted values; an escape is looked for in the pair
    name = F.regexp_extract(pair, P.SPLIT_FIELD, 1)
    return (
        F.when(_is_simple(pair), F.substring_index(pair, "=", 1))
        .when(pair.contains("\\"), F.regexp_replace(name, r"\\([ ,=])", "$1"))
        .otherwise(name)
    )


def lp_long(df: DataFrame, options: LineOptions = LineOptions()) -> DataFrame:
    """Long table of a line-protocol topic.

    ``Time, _measurement, _field, value, value_str, tags`` and the topic
    columns; ``error`` is set on the one row of a message without a good line.
    """
    lines = filtered_lines(df, options)
    when, nanos = line_time(F.col("_ts"), F.col("timestamp"), options)
    carried = [c for c in lines.columns if c == "_routes"]
    inner = ["topic", "partition", "offset", "line", "_measurement", "tags", "error", *carried]
    timed = lines.select(*inner, when.alias("Time"), nanos.alias("time_ns"), "_ts", "_fields")
    pairs = timed.select(
        *inner, "Time", "time_ns", "_ts", F.explode_outer("_fields").alias("_pair")
    )
    pair = F.col("_pair")
    simple = _is_simple(pair)
    name = _field_name(pair)
    raw = F.when(simple, F.substring_index(pair, "=", -1)).otherwise(
        F.regexp_extract(pair, P.SPLIT_FIELD, 2)
    )
    split = pairs.select(
        *inner,
        "Time",
        "time_ns",
        "_ts",
        F.coalesce(name, F.lit("")).alias("_field"),
        raw.alias("_raw"),
    )
    test = options.filter.on_field(df.sparkSession, F.col("_field"))
    if test is not None:
        split = split.filter(F.col("error").isNotNull() | test)
    number, string = field_value(F.col("_raw"))
    late = F.when(F.col("Time").isNull() & F.col("_ts").isNotNull(), OUT_OF_RANGE)
    return split.select(
        "Time",
        "_measurement",
        "_field",
        number.alias("value"),
        string.alias("value_str"),
        "tags",
        "topic",
        "partition",
        "offset",
        F.coalesce("error", late).alias("error"),
        "time_ns",
        "line",
        *carried,
    )


def lp_tag_keys(
    df: DataFrame, options: LineOptions = LineOptions(), cap: int = DEFAULT_CAP
) -> list[str]:
    """Tag keys in first-seen order, at most ``cap`` of them; a warning tells
    if there are more.

    First seen is by (timestamp, partition, offset, line, position). Lines are
    first reduced to their distinct key lists, which are few, so what is
    exploded and shuffled does not grow with the topic.
    """
    lines = filtered_lines(df, options).filter(F.size("tags") > 0)
    if options.filter.on_field(df.sparkSession, F.lit("")) is not None:
        # a line without a wanted field is not part of the result
        lines = lines.filter(
            F.exists("_fields", lambda pair: options.filter.on_field(df.sparkSession, _field_name(pair)))
        )
    at = message_order(F.col("timestamp"), F.col("offset"))
    lists = lines.groupBy(F.map_keys("tags").alias("keys"), "line", "partition").agg(
        F.min("timestamp").alias("time"), F.min(at).alias("at")
    )
    place = ["time", "partition", "at", "line", "position"]
    keys = lists.select(*place[:-1], F.posexplode("keys").alias("position", "key"))
    first = keys.groupBy("key").agg(F.min(F.struct(*place)).alias("first"))
    rows = first.orderBy("first").limit(cap + 1).collect()
    if len(rows) > cap:
        warnings.warn(f"more than {cap} tag keys; the others are left out", stacklevel=2)
    return [r["key"] for r in rows[:cap]]


def tag_column_names(keys: Sequence[str]) -> dict[str, str]:
    """A column per tag key; ``tag_`` is put before a name until it is free."""
    used = set(RESERVED)
    names: dict[str, str] = {}
    for key in keys:
        name = key
        while name in used:
            name = f"tag_{name}"
        used.add(name)
        names[key] = name
    return names


def lp_wide(long: DataFrame, keys: Sequence[str], partition_column: bool = True) -> DataFrame:
    """Replace the ``tags`` map of :func:`lp_long` by one column per key."""
    names = tag_column_names(keys)
    tags = [F.try_element_at("tags", F.lit(k)).alias(n) for k, n in names.items()]
    return long.select(
        "Time",
        "_measurement",
        "_field",
        "value",
        "value_str",
        *tags,
        *(["partition"] if partition_column else []),
        "offset",
        "error",
    )


def lp_pivot(long: DataFrame, fields: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per measurement, time and the tag keys ``by``; a column per
    wanted field holding its latest value.

    Conditional aggregates instead of ``pivot``: the fields are given, so no
    extra pass looks for them, and map-side combine works.
    """
    order = line_order(F.col("partition"), F.col("offset"), F.col("line"))
    keyed = long.filter(F.col("error").isNull()).select(
        "Time",
        "_measurement",
        *[F.try_element_at("tags", F.lit(k)).alias(n) for k, n in tag_column_names(by).items()],
        "_field",
        "value",
        order.alias("_order"),
    )
    group = [c for c in keyed.columns if c not in ("_field", "value", "_order")]
    latest = [
        F.max_by("value", F.when((F.col("_field") == f) & F.col("value").isNotNull(), F.col("_order"))).alias(f)
        for f in fields
    ]
    return keyed.groupBy(*[ref(c) for c in group]).agg(*latest)
