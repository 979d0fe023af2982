"""A document pipeline over ``documents``; each stage is one operator of ``tessera.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next one's docs. All but the last return the
columns of documents.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tessera.llm import bag_minhash, bpe, mixing, radix_dedup, toxicity  # noqa: E402
from tessera.llm.queries import vocabulary_path  # noqa: E402
from tessera.llm.scratch import Scratch  # noqa: E402
from tessera.sources.tables import table  # noqa: E402


def clean_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject stay; its labels are those of ``sf_dir``."""
    return toxicity.clean_rows(spark, docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text stays, that of the smallest doc_id."""
    return radix_dedup.distinct_rows(spark, docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that of the smallest doc_id."""
    return bag_minhash.distinct_rows(spark, docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the proportion of their weights; a document taken twice is two rows."""
    return mixing.mixed_rows(spark, docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the decoded text."""
    return bpe.encode_documents(docs, vocabulary_path(), ("doc_id", "source", "lang"))


STAGES = [
    ("toxicity", clean_texts),
    ("exact_dedup", distinct_texts),
    ("minhash_near_dedup", without_near_copies),
    ("mixing", mixed_sources),
    ("bpe", encoded),
]

#: the stages' model fitting, component search and tokens can't be said in SQL; tests hold each stage
#: against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return done
        written = scratch.keep(done)
        scratch.drop(docs)
        docs = written
    return docs
