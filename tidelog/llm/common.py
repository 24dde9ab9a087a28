"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ref(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_prefix(df: DataFrame, stem: str) -> str:
    """A prefix for working columns that no column of ``df`` starts with."""
    prefix = f"_{stem}_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = f"_{prefix}"
    return prefix


def text_of(name: str) -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(ref(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def looked_up(df: DataFrame, small: DataFrame, on: list[str], rows: int = 100_000, size: int = 32 << 20) -> DataFrame:
    """Left join with ``small``, sent to every executor only if it was counted
    and has at most ``rows`` rows of ``size`` bytes together, as text; an
    ordinary shuffled join otherwise."""
    written = F.octet_length(F.to_json(F.struct(*[ref(c) for c in small.columns])))
    known, taken = small.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(written)).first()
    fits = known <= rows and (taken or 0) <= size
    return df.join(F.broadcast(small) if fits else small, on, "left")
