"""The minimum end-to-end slice: raw table to a selected-feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortml.operators import folds, prep, select, univariate
from cohortml.sources import tables as T


def flagship(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    labels = T.label_five(spark, sf_dir)
    split = folds.stratified_split(labels)
    long = T.labelled_long(spark, sf_dir, split)
    train = long.where("split = 'train'")
    scaled = prep.standard_scale(train, train)
    scores = univariate.score_kruskal(scaled)
    return select.select_k_best(scores.select("feature", "score", "pvalue"), k)
