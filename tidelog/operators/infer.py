"""Fields of a topic: type per path, and which messages share a field set."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import variants as V
from tidelog.functions.columns import message_order
from tidelog.operators.flatten import FlattenOptions, text_leaves
from tidelog.operators.wide import FieldSpec

# one bit per type; null has none, so it never decides
_BITS = {V.LONG: 1, V.DOUBLE: 2, V.BOOL: 4, V.STRING: 8, V.JSON: 16}


def _bit(kind: Column) -> Column:
    bit = F.lit(0)
    for name, value in _BITS.items():
        bit = F.when(kind == name, value).otherwise(bit)
    return bit


def _resolved(mask: Column) -> Column:
    """long and double widen to double, other mixtures to string; a path that
    is only ever null is double."""
    return (
        F.when(mask == _BITS[V.LONG], V.LONG)
        .when(mask.isin(0, 2, 3), V.DOUBLE)
        .when(mask == _BITS[V.BOOL], V.BOOL)
        .when(mask == _BITS[V.JSON], V.JSON)
        .otherwise(V.STRING)
    )


def infer_fields(
    df: DataFrame,
    value: str = "value",
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
) -> DataFrame:
    """One row per path: ``path, type, mixed, last_type, messages, nulls,
    depths`` over the whole topic.

    ``last_type`` is the type of the newest non-null value. Only partial
    aggregates per path are shuffled. Who only wants the columns asks
    :func:`find_fields`, which spreads no message where it need not.
    """
    return resolved_fields(kinds_of_paths(df, value, options, prefix))


def kinds_of_paths(
    df: DataFrame,
    value: str = "value",
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
) -> DataFrame:
    """``path, kind, depth, rows, last`` (a place that sorts) for each partition."""
    order = message_order(F.col("timestamp"), F.col("offset"))
    items = text_leaves(F.col(value), options, prefix, wrap_array=not prefix)
    place = [F.col("timestamp").alias("_time"), F.col("partition").alias("_partition"), order.alias("_at")]
    leaves = df.select(*place, F.inline_outer(items).alias("path", "depth", "node"))
    typed = leaves.filter(F.col("path").isNotNull()).select(
        "_time", "_partition", "_at", "path", "depth", V.leaf_type(F.col("node")).alias("kind")
    )
    # per path, type and partition first: numbers only, so a hash aggregate without a sort
    by_type = typed.groupBy("path", "kind", "depth", "_partition").agg(
        F.count(F.lit(1)).alias("rows"), F.max("_time").alias("_time"), F.max("_at").alias("_at")
    )
    last = F.struct("_time", "_partition", "_at").alias("last")
    return by_type.select("path", "kind", "depth", "rows", last)


def resolved_fields(by_type: DataFrame) -> DataFrame:
    """``path, kind, depth, rows, last`` (a place that sorts) to a row per path."""
    known = F.col("kind") != V.NULL
    stats = by_type.groupBy("path").agg(
        F.bit_or(_bit(F.col("kind"))).alias("mask"),
        F.sum("rows").alias("messages"),
        F.sum(F.when(known, 0).otherwise(F.col("rows"))).alias("nulls"),
        F.max_by("kind", F.when(known, F.col("last"))).alias("last_type"),
        F.sort_array(F.collect_set("depth")).alias("depths"),
    )
    return stats.select(
        "path",
        _resolved(F.col("mask")).alias("type"),
        (~F.col("mask").isin(0, 1, 2, 3, 4, 8, 16)).alias("mixed"),
        F.coalesce("last_type", F.lit(V.DOUBLE)).alias("last_type"),
        "messages",
        "nulls",
        "depths",
    )


def field_list(inferred: DataFrame) -> list[FieldSpec]:
    """All fields of the topic in byte order of the path; the field cap is one
    of each message, so a topic may have more."""
    rows = inferred.orderBy("path").collect()
    return [FieldSpec(r["path"], r["type"], r["mixed"], tuple(r["depths"])) for r in rows]


def find_fields(
    df: DataFrame,
    value: str = "value",
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
) -> list[FieldSpec]:
    """The fields of a topic for the wide shape: by the schema that Spark merges
    over all messages where that tells all, by :func:`infer_fields` where not."""
    merged = merged_fields(df, value, options, prefix)
    if merged is not None:
        return merged
    specs = field_list(infer_fields(df, value, options, prefix))
    dots = {s.path: s.path.removeprefix(f"{prefix}.").count(".") for s in specs}
    # a path of some depth between may have been cut in several ways
    unclear = [s.path for s in specs if any(1 < d <= dots[s.path] for d in s.depths)]
    if not unclear:
        return specs
    seen = key_segments(df, unclear, value, options, prefix)
    return [replace(s, segments=seen.get(s.path, ())) for s in specs]


def merged_fields(
    df: DataFrame,
    value: str = "value",
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
) -> list[FieldSpec] | None:
    """Fields from one mergeable aggregate, without spreading any message; None
    where it does not tell them: top-level arrays, values of different kinds
    under one path, two ways to one path, or more fields than the cap."""
    # a whole topic of another kind is no object
    start = F.substring(F.ltrim(F.col(value).cast("string"), F.lit(" \t\r\n")), 1, 1)
    told = df.agg(
        F.schema_of_variant_agg(F.when(start == "{", V.parse(F.col(value)))).alias("schema"),
        F.bool_or(start == "[").alias("arrays"),
    ).first()
    if told["arrays"] and not prefix:
        return None
    schema = T.DataType.fromDDL(_OBJECT.sub(lambda m: "STRUCT<" if m[0] == "OBJECT<" else m[0], told["schema"]))
    if isinstance(schema, T.NullType):
        return []
    found: dict[str, FieldSpec] = {}
    objects: list[tuple[str, ...]] = []

    def named(segments: tuple[str, ...]) -> str:
        return ".".join((prefix, *segments) if prefix else segments)

    def walk(node: T.StructType, above: tuple[str, ...]) -> bool:
        for f in node.fields:
            segments = (*above, f.name)
            if len(segments) >= options.max_depth:
                continue
            if isinstance(f.dataType, T.StructType):
                objects.append(segments)
                if not walk(f.dataType, segments):
                    return False
                continue
            kind = next((k for t, k in _MERGED.items() if isinstance(f.dataType, t)), None)
            path = named(segments)
            if kind is None or path in found:
                return False
            found[path] = FieldSpec(path, kind, depths=(len(segments),), segments=(segments,))
        return True

    if not isinstance(schema, T.StructType) or not walk(schema, ()):
        return None
    # an object that is null in some messages is a field of them, and the merged schema does not tell
    root = df.select(V.parse(F.col(value)).alias("root"))
    nulls = [F.schema_of_variant(F.try_variant_get("root", V.member_path(o), "variant")) == "VOID" for o in objects]
    missing = root.agg(*[F.bool_or(n).alias(f"n{i}") for i, n in enumerate(nulls)]).first() if nulls else []
    for segments, is_null in zip(objects, missing, strict=True):
        if is_null and named(segments) in found:
            return None
        if is_null:
            found[named(segments)] = FieldSpec(named(segments), V.DOUBLE, depths=(len(segments),), segments=(segments,))
    if len(found) > options.field_cap:
        return None
    return [found[p] for p in sorted(found, key=str.encode)]


_OBJECT = re.compile(r"`(?:[^`]|``)*`|OBJECT<")
_MERGED = {
    T.LongType: V.LONG,
    T.DoubleType: V.DOUBLE,
    T.DecimalType: V.DOUBLE,
    T.BooleanType: V.BOOL,
    T.StringType: V.STRING,
    T.ArrayType: V.JSON,
    # only ever null
    T.NullType: V.DOUBLE,
}


def key_segments(
    df: DataFrame,
    paths: Sequence[str],
    value: str = "value",
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
) -> dict[str, tuple[tuple[str, ...], ...]]:
    """The key segments each of the paths was seen with in the topic."""
    every = FlattenOptions(options.max_depth, 1 << 30)
    items = text_leaves(F.col(value), every, prefix, wrap_array=not prefix, separator=_APART)
    cut = F.transform(items, lambda leaf: leaf["path"])
    cut = F.array_distinct(F.filter(cut, lambda p: F.replace(p, F.lit(_APART), F.lit(".")).isin(list(paths))))
    rows = df.select(F.explode(cut).alias("path")).distinct().collect()
    seen: dict[str, list[tuple[str, ...]]] = {}
    for r in rows:
        segments = tuple(r["path"].split(_APART))
        seen.setdefault(".".join(segments), []).append(segments[1:] if prefix else segments)
    return {p: tuple(sorted(s)) for p, s in seen.items()}


_APART = "\u0001"


def typed_paths(leaves: Column, types: Mapping[str, str] | None = None) -> Column:
    """The sorted ``path:type`` of a message, the same for all messages of a
    group; a null takes the type known for its path, else double."""
    known = F.create_map(*[F.lit(x) for item in (types or {}).items() for x in item])
    lookup = known.cast("map<string,string>")

    def entry(leaf: Column) -> Column:
        kind = V.leaf_type(leaf["node"])
        remembered = F.coalesce(F.try_element_at(lookup, leaf["path"]), F.lit(V.DOUBLE))
        shown = F.when(kind == V.NULL, remembered).otherwise(kind)
        return F.concat(leaf["path"], F.lit(":"), shown)

    return F.sort_array(F.transform(leaves, entry))


def schema_groups(
    df: DataFrame,
    value: str = "value",
    options: FlattenOptions = FlattenOptions(),
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Which messages share one set of typed columns: a drift report.

    The signature is built inside the row. A null takes the type known for
    its path in ``types``, else double.
    """
    fields = typed_paths(text_leaves(F.col(value), options), types)
    names = F.coalesce(F.array_join(fields, "|"), F.lit("error:string"))
    signed = df.select("topic", "offset", "timestamp", names.alias("fields"))
    grouped = signed.groupBy("topic", "fields").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
    )
    return grouped.withColumn("signature", F.xxhash64("fields"))
