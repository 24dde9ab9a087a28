"""Files that come into being at once, on the storage all executors share."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def file_context(spark: SparkSession, path: str):
    """Hadoop's file classes and the file context of ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.FileContext.getFileContext(
        hadoop.Path(path).toUri(), spark._jsc.hadoopConfiguration()
    )


def publish(df: DataFrame, target: str) -> bool:
    """``df``, a small table, as the one Parquet file ``target``: written beside it
    and moved there in one step. False if there is such a file already."""
    spark = df.sparkSession
    hadoop, context = file_context(spark, target)
    folder = target.rsplit("/", 1)[0]
    staged = f"{folder}-staged/{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(staged)
    files = [s.getPath() for s in context.util().listStatus(hadoop.Path(staged))]
    part = next(p for p in files if p.getName().endswith(".parquet"))
    context.mkdir(hadoop.Path(folder), None, True)
    # without the option to overwrite
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(part, hadoop.Path(target), options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    finally:
        context.delete(hadoop.Path(staged), True)
    return True


def numbered_files(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the files ``<number>.parquet`` of a folder, in order."""
    hadoop, context = file_context(spark, folder)
    path = hadoop.Path(folder)
    if not context.util().exists(path):
        return []
    names = [s.getPath().getName() for s in context.util().listStatus(path)]
    return sorted(int(n.removesuffix(".parquet")) for n in names if re.fullmatch(r"\d+\.parquet", n))


def delete(spark: SparkSession, path: str) -> None:
    hadoop, context = file_context(spark, path)
    context.delete(hadoop.Path(path), True)
