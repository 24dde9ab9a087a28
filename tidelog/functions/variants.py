"""Typing of JSON and VARIANT nodes: numbers, text of arrays, node kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string,variant>"
ARRAY = "array<variant>"

# leaf type names used across the library
LONG, DOUBLE, BOOL, STRING, JSON, NULL = "long", "double", "bool", "string", "json", "null"

SPARK_TYPE = {LONG: "bigint", DOUBLE: "double", BOOL: "boolean", STRING: "string", JSON: "string"}

# strict JSON: what Spark's reader accepts beyond the standard is switched off
STRICT_JSON = {
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
    "allowNumericLeadingZeros": "false",
}


def parse(payload: Column) -> Column:
    """JSON text or bytes to VARIANT; NULL when it is not JSON."""
    return F.try_parse_json(payload.cast("string"))


def object_fields(payload: Column) -> Column:
    """Members of a JSON object text as ``map<string,variant>``, else NULL.

    Much cheaper than parsing the whole text to one VARIANT and casting it,
    but repeated keys stay repeated.
    """
    return F.from_json(payload.cast("string"), OBJECT, STRICT_JSON)


def is_object(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith("OBJECT"), F.lit(False))


def is_container(node: Column) -> Column:
    schema = F.schema_of_variant(node)
    return F.coalesce(schema.startswith("OBJECT") | schema.startswith("ARRAY"), F.lit(False))


def as_object(node: Column) -> Column:
    """Members of an object node as a map; NULL for any other node."""
    return F.try_variant_get(node, "$", OBJECT)


def as_array(node: Column) -> Column:
    """Elements of an array node; NULL for any other node."""
    return F.try_variant_get(node, "$", ARRAY)


def leaf_type(node: Column) -> Column:
    """Type name of a leaf: whole numbers are ``long``, others ``double``."""
    schema = F.schema_of_variant(node)
    return (
        F.when(schema == "STRING", STRING)
        .when(schema == "BIGINT", LONG)
        .when(schema == "BOOLEAN", BOOL)
        .when(schema.isNull() | (schema == "VOID"), NULL)
        .when(schema.startswith("ARRAY"), JSON)
        .otherwise(DOUBLE)
    )


def escape_markup(text: Column) -> Column:
    """``<``, ``>`` and ``&`` of a JSON text as unicode escapes."""
    escaped = F.replace(
        F.replace(F.replace(text, F.lit("&"), F.lit("\\u0026")), F.lit("<"), F.lit("\\u003c")),
        F.lit(">"),
        F.lit("\\u003e"),
    )
    return F.when(text.rlike("[<>&]"), escaped).otherwise(text)


def leaf_columns(text: Column, node: Column, kind: Column) -> dict[str, Column]:
    """The typed value columns of the long shape.

    ``text`` is the JSON text of ``node``: casting it is several times cheaper
    than extracting from the VARIANT, which is left to the unusual cases.
    """
    plain = F.substring(text, F.lit(2), F.length(text) - 2)
    return {
        "v_long": F.when(kind == LONG, text.cast("bigint")),
        "v_double": F.when(
            kind.isin(LONG, DOUBLE),
            F.when(text.startswith('"'), F.try_variant_get(node, "$", "double")).otherwise(
                text.cast("double")
            ),
        ),
        "v_bool": F.when(kind == BOOL, text == "true"),
        "v_str": F.when(
            kind == STRING,
            F.when(text.contains("\\"), F.try_variant_get(node, "$", "string")).otherwise(plain),
        ).when(kind == JSON, escape_markup(text)),
    }


def member_path(segments: tuple[str | int, ...]) -> str:
    """VARIANT path of nested members, e.g. ``$[0]["a"]["b.c"]``."""

    def step(segment: str | int) -> str:
        if isinstance(segment, int):
            return f"[{segment}]"
        return '["' + segment.replace("\\", "\\\\").replace('"', '\\"') + '"]'

    return "$" + "".join(step(s) for s in segments)


def typed_member(root: Column, path: str, kind: str) -> Column:
    """The member at ``path`` as ``kind``; a node of another type gives NULL.

    A ``double`` column takes whole numbers too; a ``string`` column takes the
    text of any scalar or array, because that is how mixed types widen.
    """
    node = F.try_variant_get(root, path, "variant")
    schema = F.schema_of_variant(node)
    if kind == LONG:
        return F.when(schema == "BIGINT", F.try_variant_get(root, path, "bigint"))
    if kind == DOUBLE:
        numeric = (schema == "BIGINT") | (schema == "DOUBLE") | schema.startswith("DECIMAL")
        return F.when(numeric, F.try_variant_get(root, path, "double"))
    if kind == BOOL:
        return F.when(schema == "BOOLEAN", F.try_variant_get(root, path, "boolean"))
    array_text = escape_markup(F.to_json(node))
    if kind == STRING:
        return F.when(schema.startswith("ARRAY"), array_text).when(
            ~schema.startswith("OBJECT") & (schema != "VOID"),
            F.try_variant_get(root, path, "string"),
        )
    return F.when(schema.startswith("ARRAY"), array_text)
