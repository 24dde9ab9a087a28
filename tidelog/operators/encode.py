"""Rows to message bytes: JSON, line protocol, plain text, keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.columns import ref

_WITH_NULLS = {"ignoreNullFields": "false"}


def encode_json_flat(fields: Mapping[str, Column]) -> Column:
    """One object, dotted names kept as literal keys, keys sorted."""
    return F.to_json(
        F.struct(*[fields[n].alias(n) for n in sorted(fields)]), _WITH_NULLS
    ).cast("binary")


def encode_json_nested(fields: Mapping[str, Column]) -> Column:
    """One object, dotted names become nested objects, keys sorted."""
    tree: dict = {}
    for name in sorted(fields):
        node = tree
        *parents, leaf = name.split(".")
        for parent in parents:
            node = node.setdefault(parent, {})
        node[leaf] = fields[name]
    return F.to_json(_struct(tree), _WITH_NULLS).cast("binary")


def _struct(tree: Mapping) -> Column:
    return F.struct(
        *[
            (_struct(node) if isinstance(node, Mapping) else node).alias(name)
            for name, node in sorted(tree.items())
        ]
    )


def encode_json_list(elements: Sequence[Mapping[str, Column]]) -> Column:
    """A top-level array; each element is encoded as a nested object and may
    have its own fields."""
    texts = [encode_json_nested(e).cast("string") for e in elements]
    return F.concat(F.lit("["), F.concat_ws(",", *texts), F.lit("]")).cast("binary")


@dataclass(frozen=True)
class LineSpec:
    """One line-protocol line per row. Field columns are typed by Spark type:
    whole numbers get ``i``, strings quotes, decimals without scale ``u``."""

    measurement: str
    fields: Mapping[str, str]
    tags: Mapping[str, str]
    time: Column | None = None


def _escaped_name(name: str) -> str:
    return "".join("\\" + c if c in ", =" else c for c in name)


def _escape(text: Column) -> Column:
    return F.regexp_replace(text.cast("string"), "([ ,=])", r"\\$1")


def _field_text(column: str, spark_type: str) -> Column:
    value = ref(column)
    if spark_type in ("tinyint", "smallint", "int", "bigint"):
        return F.concat(value.cast("string"), F.lit("i"))
    if spark_type == "decimal(20,0)":
        return F.concat(value.cast("string"), F.lit("u"))
    if spark_type == "string":
        return F.concat(F.lit('"'), F.regexp_replace(value, r'(["\\])', r"\\$1"), F.lit('"'))
    return value.cast("string")


def encode_line(spec: LineSpec, types: Mapping[str, str]) -> Column:
    """Text of one line; null tags and fields are left out, and a line
    without any field is NULL."""
    tags = [
        F.concat(F.lit(f",{_escaped_name(k)}="), _escape(F.when(ref(c).cast("string") != "", ref(c))))
        for k, c in spec.tags.items()
    ]
    fields = [
        F.concat(F.lit(f"{_escaped_name(k)}="), _field_text(c, types[c]))
        for k, c in spec.fields.items()
    ]
    body = F.concat_ws(",", *fields)
    measurement = spec.measurement.replace(",", "\\,").replace(" ", "\\ ")
    line = F.concat(
        F.lit(measurement), *[F.coalesce(t, F.lit("")) for t in tags], F.lit(" "), body
    )
    if spec.time is not None:
        line = F.concat(line, F.coalesce(F.concat(F.lit(" "), spec.time.cast("string")), F.lit("")))
    return F.when(body != "", line)


def encode_lines(specs: Sequence[LineSpec], types: Mapping[str, str]) -> Column:
    """One message per row with a line per spec, each ended by a newline."""
    text = F.concat_ws("\n", *[encode_line(s, types) for s in specs])
    return F.concat(text, F.lit("\n")).cast("binary")


def encode_text(template: str, *columns: Column) -> Column:
    """Plain text from a printf-style template."""
    return F.format_string(template, *columns).cast("binary")


def encode_key(value: Column, key_format: str) -> Column:
    """``string`` text, ``json`` (a struct), ``binary`` 8 bytes big-endian of a
    whole number, or ``none``."""
    if key_format == "string":
        return value.cast("string").cast("binary")
    if key_format == "json":
        return F.to_json(value, _WITH_NULLS).cast("binary")
    if key_format == "binary":
        return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))
    if key_format == "none":
        return F.lit(None).cast("binary")
    raise ValueError(f"unknown key format {key_format!r}")
