"""Session settings the operators rely on.

The library never creates the production session; it sets these runtime
settings on whatever session it is given.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONFS = {
    # topic timestamps are instants, compared in UTC
    "spark.sql.session.timeZone": "UTC",
    # duplicate JSON keys: the last one wins
    "spark.sql.variant.allowDuplicateKeys": "true",
    # base64 of a key is one line
    "spark.sql.chunkBase64String.enabled": "false",
    # duplicate line-protocol tags: the last one wins
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark`` and return it."""
    for name, value in RUNTIME_CONFS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``,
    or the warehouse where that is unset (tests, one machine)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return (shared or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def scratch_folder(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder name below the shared folder."""
    return f"{shared_folder(spark)}/tidelog-{name}-{uuid.uuid4().hex}"


_open: list[list[str]] = []


def stored(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again:
    later plans start there, whatever executors are lost meanwhile."""
    path = scratch_folder(df.sparkSession, name)
    if _open:
        _open[-1].append(path)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a batch between an executor and its Python worker. Both hold several
#: copies of one, and keep the memory when the task is over.
BATCH_BYTES = 4 << 20
_BATCH_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside send long texts to Python in batches of about
    ``BATCH_BYTES``, a row at least. The session's own setting comes back."""
    before = spark.conf.get(_BATCH_BYTES_CONF)
    spark.conf.set(_BATCH_BYTES_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES_CONF, before)


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[list[str]]:
    """What :func:`stored` writes inside is deleted at the end, when the caller
    has written or collected what was made of it. One run at a time: tables of
    other threads are not told apart."""
    _open.append([])
    try:
        yield _open[-1]
    finally:
        from tidelog.sources.files import delete

        for path in _open.pop():
            delete(spark, path)
