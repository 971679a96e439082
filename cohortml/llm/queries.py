"""Registered queries of the corpus operators: each runs over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortml.llm import (centroids, exact_dedup, line_dedup, packing, passages, pii, quality, secret_scan, simhash,
                          sp_codec, template, token_counts, whitening)


#: The key of the registered query only; a user passes a secret of their own.
PII_KEY = "registered query"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet")


def _whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(embeddings(spark, sf_dir))
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_bk_trees": lambda s, d: simhash.simhash_dedup(documents(s, d), 3, 3),
    "op2_mixture_packing": lambda s, d: packing.pack(documents(s, d)),
    "op3_sentencepiece": lambda s, d: sp_codec.encode_decode(documents(s, d)),
    "op4_exact_dedup": lambda s, d: exact_dedup.exact_dedup(documents(s, d)),
    "op10_passage_automata": lambda s, d: passages.cut_repeats(documents(s, d)),
    "op5_fuzzy_lines": lambda s, d: line_dedup.line_dedup(documents(s, d), radius=24, bands=24),
    "op6_entropy_secrets": lambda s, d: secret_scan.secret_spans(documents(s, d)),
    "op7_feistel_pseudonyms": lambda s, d: pii.pseudonymise(documents(s, d), PII_KEY),
    "op8_token_counts": lambda s, d: token_counts.token_counts(documents(s, d)),
    "op9_line_quality": lambda s, d: quality.quality(documents(s, d)),
    "op11_template_extraction": lambda s, d: template.extract_main_text(s.read.parquet(f"{d.rstrip('/')}/pages.parquet")),
    "op12_shallot_centroids": lambda s, d: centroids.cluster(embeddings(s, d)),
    "op13_jacobi_davidson_whitening": _whitened,
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": exact_dedup.SQL,
    "op6_entropy_secrets": secret_scan.SQL,
    "op10_passage_automata": passages.SQL,
}
