"""The corpus pipeline over the ``documents`` table.

Five stages, each one operator of ``cohortml.llm`` with its production parameters. A stage takes
what its predecessor kept, written as Parquet and read again; all but the last return the columns
of ``documents``. Rows that a stage drops are gone for the later ones; the secret scan changes texts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortml.llm.common import remove_path
from cohortml.llm.exact_dedup import drop_exact_copies
from cohortml.llm.packing import pack
from cohortml.llm.quality import clean
from cohortml.llm.secret_scan import redact
from cohortml.llm.simhash import drop_near_copies
from cohortml.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are too frequent on their host. Null and empty texts go."""
    return clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the document with the smallest id."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of SimHash neighbours (3-word shingles, 3 bits), the document with the smallest id."""
    return drop_near_copies(docs, width=3, radius=3)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality_rules", quality), ("exact_dedup", exact_dedup), ("simhash_near_dedup", near_dedup),
          ("secret_scan", secrets), ("mixture_packing", packing)]

#: Fingerprints, tokens and the packing order have no SQL; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's files are removed when the next stage is written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
