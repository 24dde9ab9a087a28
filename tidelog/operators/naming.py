"""Series names from alias templates, and the tag of a query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.columns import ref


def series_name(
    alias: str, topic: Column, partition: Column, ref_id: str = "", field: Column | None = None
) -> Column:
    """Fill ``{{topic}} {{partition}} {{refid}} {{field}}`` in ``alias``.

    The replacements run one after another, in this order, so a topic name
    that itself contains a placeholder is filled too.
    """
    name = F.lit(alias)
    for mark, value in (
        ("{{topic}}", topic),
        ("{{partition}}", partition.cast("string")),
        ("{{refid}}", F.lit(ref_id)),
        ("{{field}}", F.lit("") if field is None else field),
    ):
        name = F.replace(name, F.lit(mark), F.coalesce(value, F.lit("")))
    return name


def display_name(alias: str, topic: str, ref_id: str, field: str) -> str:
    return (
        alias.replace("{{topic}}", topic).replace("{{refid}}", ref_id).replace("{{field}}", field)
    )


def with_display_names(
    df: DataFrame, alias: str, topic: str, ref_id: str = "", time_column: str = "time"
) -> DataFrame:
    """Attach ``display_name`` column metadata; the time column keeps its own.

    A template with ``{{partition}}`` has no fixed name per column, so it is
    published as a ``series`` column instead.
    """
    if not alias:
        return df
    if "{{partition}}" in alias:
        partition = F.col("partition") if "partition" in df.columns else F.lit(0)
        return df.withColumn("series", series_name(alias, F.lit(topic), partition, ref_id))
    named = [
        ref(c)
        if c == time_column
        else ref(c).alias(c, metadata={"display_name": display_name(alias, topic, ref_id, c)})
        for c in df.columns
    ]
    return df.select(*named)


def with_ref_id(df: DataFrame, ref_id: str) -> DataFrame:
    return df.withColumn("ref_id", F.lit(ref_id))
