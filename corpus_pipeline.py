"""From raw documents to packed training sequences, as stages that each take and give a table.

Every stage works on all that its predecessor kept, and its decisions take effect: rejected, copied
and leaking documents are gone from the next one's input. All but the last return the columns of
``documents``. ``run`` stores each stage's result in the shared folder and reads it again, so a lost
executor costs at most the stage that was running.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns: as the
operators' docstrings define them; extra columns pass through all stages but the last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import decontamination, exact_dedup, near_dedup, packing, quality
from tallyhouse.llm.common import read
from tallyhouse.llm.queries import tokenizer_path
from tallyhouse.storage import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the ranking learned from the labels of ``docs`` rejects."""
    return quality.drop_low_quality(docs, read(spark, sf_dir, "labels"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text: the one with the largest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 per cent of five-word shingles: the smallest id."""
    return near_dedup.drop_near_copies(docs, n=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that leak an item of the benchmark."""
    return decontamination.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of at most 4,096 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# A learned ranking and a tokenizer are beyond SQL; tests compare run() with a plain computation.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
