"""From raw documents to packed sequences, one operator a stage.

Each stage takes all that the one before kept and returns the columns of
documents, whatever else they are called; the last returns the pieces of the
packed sequences. Null and empty texts go with the quality classifier, as do
all without words; null ids, sources and other columns stay as they are;
repeated rows are copies of each other; an empty table gives empty stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.classifier import fit
from tidelog.llm.common import table
from tidelog.llm.jaccard import one_of_each
from tidelog.llm.mixing import mix, repeated
from tidelog.llm.packing import pack
from tidelog.llm.quality_rules import LINE_MOST, judge
from tidelog.session import stored

#: Near duplicates share four fifths of their five-word shingles or more.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def _kept_columns(docs: DataFrame, stage: Callable[[DataFrame, dict[str, str]], DataFrame]) -> DataFrame:
    """``stage`` over ``docs`` with numbered columns, so that no name of theirs
    meets one of the operator's; the names come back afterwards. The stage gets
    the column that each name has now."""
    names = {name: f"_{i}_doc" for i, name in enumerate(docs.columns)}
    done = stage(docs.toDF(*names.values()), names)
    return done.select(*names.values()).toDF(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier draws. All documents are weighed
    once; equal rows have one fate."""

    def stage(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", name["doc_id"])
        fitted = fit(rows, labels, name["doc_id"], name["text"], columns=rows.columns)
        return fitted.weights.where("kept")

    return _kept_columns(docs, stage)


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the boilerplate lines of their host,
    frequent ones of a large host included. Null sources are one host."""

    def stage(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        kept = judge(rows, name["source"], name["text"], line_most=LINE_MOST).where("kept")
        kept = kept.withColumn(name["text"], F.col("clean_text"))
        if "n_chars" in name:
            kept = kept.withColumn(name["n_chars"], F.char_length("clean_text").cast("long"))
        return kept

    return _kept_columns(docs, stage)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least id, null
    last; of repeated rows one."""

    def stage(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        return one_of_each(rows, name["doc_id"], name["text"], size=NEAR_SHINGLE, percent=NEAR_PERCENT)

    return _kept_columns(docs, stage)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, whole ones, as often as the mix of sources takes them."""

    def stage(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        return repeated(mix(rows, name["doc_id"], name["source"], name["text"]))

    return _kept_columns(docs, stage)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and place in a sequence; long texts
    are cut into windows, nothing of them is left out."""
    return pack(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("quality rules", keep_by_rules),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: Counts of hashed n-grams, draws and retrieval have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
