"""Registry schemas as a table: ``subject, version, id, schema``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import ref
from tidelog.operators.flatten import FlattenOptions
from tidelog.operators.structs import united_leaves


def subject_name(topic: str) -> str:
    return f"{topic}-value"


def latest_schemas(schemas: DataFrame) -> DataFrame:
    """Newest version per subject."""
    return schemas.groupBy("subject").agg(
        F.max("version").alias("version"),
        F.max_by("id", "version").alias("id"),
        F.max_by("schema", "version").alias("schema"),
    )


def latest_schema(schemas: DataFrame, topic: str) -> str | bytes:
    """Schema of the topic's value subject; raises when there is none."""
    rows = (
        latest_schemas(schemas.filter(F.col("subject") == subject_name(topic)))
        .select("schema")
        .collect()
    )
    if not rows:
        raise LookupError(f"no schema for subject {subject_name(topic)}")
    return rows[0]["schema"]


def topic_schemas(schemas: DataFrame, topic: str) -> dict[int, str | bytes]:
    """All schemas of the topic's value subject by id: registry rows, a few
    for each change of the topic's schema."""
    rows = schemas.filter(F.col("subject") == subject_name(topic)).select("id", "schema").distinct().collect()
    return {r["id"]: r["schema"] for r in rows}


def decode_by_schema(
    df: DataFrame,
    known: Mapping[int, str | bytes],
    read: Callable[[Column, str | bytes], Column],
    payload: Column,
    unframed: str | bytes | None = None,
    failed: str = "decoding failed",
    options: FlattenOptions = FlattenOptions(),
    prefix: str = "",
) -> DataFrame:
    """Decode each message with the schema its ``schema_id`` names: a column
    per path of any schema, after ``prefix``, and ``error``.

    ``read(payload, schema)`` gives the struct column of a payload, null where
    it cannot be read. Rows without an id are read with ``unframed``, if it is
    given; a message whose schema is not known is an error row. It is one
    projection of ``df``: nothing is read twice or united.
    """
    number = F.col("schema_id")
    tests = [(number == i, schema) for i, schema in sorted(known.items())]
    if unframed is not None:
        tests.append((number.isNull(), unframed))
    bodies = [F.when(test & payload.isNotNull(), read(payload, schema)) for test, schema in tests]
    found = F.lit(False)
    for test, _ in tests:
        found = found | F.coalesce(test, F.lit(False))
    lost = F.concat(F.lit("schema not found: id "), F.coalesce(number.cast("string"), F.lit("none")))
    marked = df.withColumn("_found", found).withColumn("_filled", payload.isNotNull())
    flat, names = united_leaves(marked, bodies, options, prefix)
    error = F.when(~F.col("_found"), lost).when(F.col("_filled") & ~F.col("_read"), F.lit(failed))
    return flat.select(*[ref(c) for c in df.columns], *[ref(c) for c in names], error.alias("error"))
