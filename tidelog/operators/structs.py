"""Flatten a typed struct (decoded Avro or Protobuf) by its schema."""

from __future__ import annotations

import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.variants import escape_markup
from tidelog.operators.flatten import FlattenOptions
from tidelog.operators.wide import column_name

_MEMBER = re.compile(r"member\d+")


def leaf_fields(
    schema: T.StructType, root: Column, options: FlattenOptions = FlattenOptions()
) -> dict[str, Column]:
    """Dotted path to Column for each leaf, in byte order of the path.

    The columns follow from the schema alone, so nothing is parsed or
    exploded. Arrays and maps are JSON text, bytes are base64; the depth bound
    and the cap apply to the schema. A struct of ``member0``, ``member1``, …
    is a union: its members share the path of the union.
    """
    found: dict[str, Column] = {}
    kinds: dict[str, T.DataType] = {}

    def put(path: str, kind: T.DataType, leaf: Column) -> None:
        if path not in found:
            found[path], kinds[path] = leaf, kind
        elif kinds[path] == kind:
            found[path] = F.coalesce(found[path], leaf)
        else:
            found[path] = F.coalesce(found[path].cast("string"), leaf.cast("string"))

    def walk(struct: T.StructType, value: Column, prefix: str, depth: int) -> None:
        if depth >= options.max_depth:
            return
        union = bool(struct.names) and all(_MEMBER.fullmatch(n) for n in struct.names)
        for f in struct.fields:
            child = value.getField(f.name)
            path = prefix.removesuffix(".") if union else prefix + f.name
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, child, prefix if union else f"{path}.", depth + (not union))
            elif union or path not in found:
                put(path, f.dataType, _leaf(f.dataType, child))

    walk(schema, root, "", 1)
    ordered = sorted(found, key=str.encode)
    if len(ordered) > options.field_cap:
        left = len(ordered) - options.field_cap
        warnings.warn(f"more than {options.field_cap} fields; {left} of the schema are left out", stacklevel=2)
    return {path: found[path] for path in ordered[: options.field_cap]}


def _leaf(kind: T.DataType, value: Column) -> Column:
    if isinstance(kind, T.ArrayType | T.MapType):
        text = F.to_json(value, {"ignoreNullFields": "false"})
        # empty lists and maps are published as null
        return F.when(F.size(value) > 0, escape_markup(text))
    if isinstance(kind, T.BinaryType):
        return F.base64(value)
    if isinstance(kind, T.ByteType | T.ShortType | T.IntegerType):
        return value.cast("bigint")
    if isinstance(kind, T.FloatType):
        return value.cast("double")
    return value


def flatten_struct(
    df: DataFrame,
    column: str = "body",
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
) -> DataFrame:
    """Replace the struct ``column`` by one column per leaf, named by its path
    after ``prefix``. A name that is taken becomes ``value.<path>``."""
    keep = [c for c in df.columns if c != column]
    fields = leaf_fields(df.schema[column].dataType, F.col(column), options)
    named = {column_name(prefix + path, keep): c for path, c in fields.items()}
    return df.select(*keep, *[c.alias(n) for n, c in named.items()])


def united_leaves(
    df: DataFrame, bodies: Sequence[Column], options: FlattenOptions = FlattenOptions(), prefix: str = ""
) -> tuple[DataFrame, list[str]]:
    """One column per leaf path of several struct columns of which a row has
    at most one, and ``_read``, whether it has one; with the new names.

    A path with one type in all structs keeps it; numbers widen to double,
    other mixtures to text.
    """
    work = df.select("*", *[b.alias(f"_body{i}") for i, b in enumerate(bodies)])
    read = F.lit(False)
    found: dict[str, list[Column]] = {}
    for i in range(len(bodies)):
        body = F.col(f"_body{i}")
        read = read | body.isNotNull()
        for path, leaf in leaf_fields(work.schema[f"_body{i}"].dataType, body, options).items():
            found.setdefault(path, []).append(leaf)
    columns = {}
    for path in sorted(found, key=str.encode):
        kinds = {work.select(c).schema[0].dataType.simpleString() for c in found[path]}
        leaves = found[path]
        if len(kinds) > 1:
            common = "double" if kinds <= {"bigint", "double"} else "string"
            leaves = [c.cast(common) for c in leaves]
        columns[column_name(prefix + path, df.columns)] = F.coalesce(*leaves)
    return work.select(*df.columns, read.alias("_read"), *[c.alias(n) for n, c in columns.items()]), list(columns)
