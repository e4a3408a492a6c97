"""The corpus pipeline: documents to packed sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept.  All but the last return the columns of ``documents``; the last returns
the pieces with their places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegraph.llm.common import stage, table
from sitegraph.llm.decontaminate import decontaminate
from sitegraph.llm.line_dedup import line_dedup
from sitegraph.llm.packing import pack
from sitegraph.llm.simhash import near_dedup
from sitegraph.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    out = toxicity(docs, table(spark, sf_dir, "labels"), threshold=0.7)
    return out.where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later places of repeated runs of lines go from the texts; every document stays."""
    return line_dedup(docs, window=2, long_words=50).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return near_dedup(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"), n=10)
    return out.where(~F.col("contaminated")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 4096 tokens."""
    return pack(docs, end_id=1, capacity=4096)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Classifier, tokenizer and packing have no SQL; the tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, f in STAGES[:-1]:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
