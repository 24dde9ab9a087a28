"""A stream's good and error rows under one commit.

Each batch writes its good rows, its error rows and then, in one step, a file
that says so. Only batches with that file are read. A batch that died before
it is written again over what it left, and one that is repeated after it does
nothing: no row is lost and none comes twice, in either table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.decode import split_errors
from tidelog.sources.files import numbered_files, publish

TABLES = ("rows", "errors")
COMMIT = "batch long, rows long, errors long"


def _folder(path: str, table: str, stream: str, number: int) -> str:
    return f"{path}/{table}/{stream}/{number:020d}"


def committed(spark: SparkSession, path: str, stream: str) -> list[int]:
    """The batches of a stream that are there as a whole."""
    return numbered_files(spark, f"{path}/commits/{stream}")


def journal(path: str, stream: str) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls. ``stream`` names the query that the batches
    belong to; another query may keep its batches in the same folder."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if number in committed(spark, path, stream):
            return
        # the batch is read for each table, so it is kept until both are written
        batch = batch.persist()
        try:
            counts = []
            for table, part in zip(TABLES, split_errors(batch), strict=True):
                folder = _folder(path, table, stream, number)
                part.write.mode("overwrite").parquet(folder)
                counts.append(spark.read.schema(part.schema).parquet(folder).count())
        finally:
            batch.unpersist()
        told = spark.createDataFrame([(number, *counts)], COMMIT)
        publish(told, f"{path}/commits/{stream}/{number:020d}.parquet")

    return write


def read_journal(spark: SparkSession, path: str, stream: str, schema: T.StructType, table: str = "rows") -> DataFrame:
    """The ``rows`` or ``errors`` of all committed batches; ``schema`` is that of
    the stream."""
    if table not in TABLES:
        raise ValueError(f"table must be one of {', '.join(TABLES)}")
    whole = spark.createDataFrame([], schema)
    shape = split_errors(whole)[TABLES.index(table)].schema
    folders = [_folder(path, table, stream, n) for n in committed(spark, path, stream)]
    return spark.read.schema(shape).parquet(*folders) if folders else spark.createDataFrame([], shape)


def batches(spark: SparkSession, path: str, stream: str) -> DataFrame:
    """``batch, rows, errors`` of all committed batches."""
    files = [f"{path}/commits/{stream}/{n:020d}.parquet" for n in committed(spark, path, stream)]
    return spark.read.schema(COMMIT).parquet(*files) if files else spark.createDataFrame([], COMMIT)


def total(spark: SparkSession, path: str, stream: str) -> tuple[int, int]:
    """Good and error rows so far, without reading them."""
    told = batches(spark, path, stream).agg(F.sum("rows"), F.sum("errors")).first()
    return told[0] or 0, told[1] or 0
