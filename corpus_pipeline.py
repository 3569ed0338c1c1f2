"""Corpus pipeline: toxicity, exact dedup, near-dedup, source mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``:

* ``toxicity`` drops documents that the classifier rejects (score 0.5 or more);
* ``exact_dedup`` keeps the row with the largest id of each group of equal texts;
* ``near_dedup`` keeps the row with the smallest id of each component of
  documents linked by five-word shingle sets at a similarity of 0.8;
* ``mix_sources`` repeats or leaves out whole documents until each source is
  near its target number of words;
* ``pack`` returns the pieces of sequences of at most 2048 tokens.

A null text counts as empty; empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockmap.llm.common import table
from stockmap.llm.exact_dedup import drop_copies
from stockmap.llm.mix_sources import mix_documents
from stockmap.llm.near_dedup import drop_near
from stockmap.llm.pack_windows import pack
from stockmap.llm.toxicity import keep_clean
from stockmap.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs, table(spark, sf_dir, "labels"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack_sequences),
]

#: The classifier and the packing by tokens are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
