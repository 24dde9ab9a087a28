"""Messages regrouped by schema: a typed table for each set of typed fields.

All groups are written in one pass. A row has a column for every path and type
that the topic knows, and the files of a group hold it under its signature, so
that the columns of other groups are null there and take no room. Rows are
dealt and sorted by signature first: a task has one file open at a time,
however many groups there are, and a large group is many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import variants as V
from tidelog.functions.columns import let, ref
from tidelog.operators.flatten import FlattenOptions, text_leaves
from tidelog.operators.infer import kinds_of_paths, typed_paths
from tidelog.operators.wide import column_names

PLACE = ("topic", "partition", "offset", "timestamp")
#: Parts of a signature's rows, so that a large group is not one task.
PARTS = 32


def _column(path: str, kind: str) -> str:
    return f"{kind}:{path}"


def _value(members: Column, path: str, kind: str) -> Column:
    """The leaf at ``path`` if it is of ``kind``, typed."""

    def typed(node: Column) -> Column:
        values = V.leaf_columns(F.to_json(node), node, F.lit(kind))
        name = {V.LONG: "v_long", V.DOUBLE: "v_double", V.BOOL: "v_bool"}.get(kind, "v_str")
        return F.when(V.leaf_type(node) == kind, values[name])

    return let(F.try_element_at(members, F.lit(path)), typed)


def write_schema_tables(
    df: DataFrame, path: str, value: str = "value", options: FlattenOptions = FlattenOptions()
) -> DataFrame:
    """Write the messages of ``df`` below ``path`` and return the groups: ``topic,
    fields, signature, messages, first_offset, last_offset``.

    A null takes the type that its path has last had, else double, as in the
    report of :func:`schema_groups`. ``fields`` are ``path:type``, null for the
    group of messages that are no JSON object or array.
    """
    spark = df.sparkSession
    types, pairs = _known(df, value, options)
    # a column of its own: each use of the leaves would parse the message again
    leaves = df.select(*PLACE, text_leaves(F.col(value), options).alias("_leaves"))
    entries = F.transform("_leaves", lambda leaf: F.struct(leaf["path"].alias("key"), leaf["node"].alias("value")))
    parsed = leaves.select(
        *PLACE,
        typed_paths(F.col("_leaves"), types).alias("fields"),
        F.map_from_entries(entries).alias("_members"),
        F.pmod(F.xxhash64("partition", "offset"), F.lit(PARTS)).alias("_deal"),
    )
    rows = parsed.withColumn("signature", F.hex(F.xxhash64(F.col("fields").isNull(), "fields")))
    rows = rows.repartition("signature", "_deal").sortWithinPartitions("signature", "partition", "offset")
    typed = rows.select(*PLACE, "fields", "signature", *[_value(F.col("_members"), p, k).alias(_column(p, k)) for p, k in pairs])
    typed.write.partitionBy("signature").parquet(f"{path}/rows")
    written = spark.read.schema(typed.schema).parquet(f"{path}/rows")
    groups = written.groupBy("topic", "fields", "signature").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )
    groups.write.parquet(f"{path}/groups")
    return spark.read.schema(groups.schema).parquet(f"{path}/groups")


def _known(df: DataFrame, value: str, options: FlattenOptions) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """The type that each path has last had, and the paths with each type they
    are written in, from one pass over the messages."""
    kind = F.when(F.col("kind") != V.NULL, F.col("kind"))
    known = kinds_of_paths(df, value, options).groupBy("path").agg(
        F.collect_set("kind").alias("kinds"),
        F.coalesce(F.max_by(kind, F.when(kind.isNotNull(), F.col("last"))), F.lit(V.DOUBLE)).alias("last_type"),
    )
    rows = known.collect()
    pairs = {(r["path"], r["last_type"] if k == V.NULL else k) for r in rows for k in r["kinds"]}
    return {r["path"]: r["last_type"] for r in rows}, sorted(pairs)


def read_schema_table(spark: SparkSession, path: str, signature: str) -> DataFrame:
    """The table of one group: place and its fields, by name, each with the one
    type it has there."""
    group = spark.read.parquet(f"{path}/groups").filter(F.col("signature") == signature).first()
    if group is None:
        raise LookupError(f"no group {signature}")
    fields = {path: kind for path, _, kind in (f.rpartition(":") for f in group["fields"] or [])}
    names = column_names(list(fields), PLACE)
    rows = spark.read.parquet(f"{path}/rows/signature={signature}")
    return rows.select(*PLACE, *[ref(_column(p, k)).alias(names[p]) for p, k in fields.items()])
