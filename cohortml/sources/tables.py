"""Input tables and the fixtures the operators are checked on.

Every fixture is a DataFrame derived from the driver's parquet tables, so
its size grows with the scale factor. The SQL text of each fixture lives
next to it (``*_SQL``) and is used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortml.functions.hashing import hash_int, sql_hash_int

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------ matrix_long
def matrix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as LONG: ``(row_id bigint, feature int, value double)``."""
    e = read_table(spark, sf_dir, "embeddings")
    return (e.select(F.col("vec_id").alias("row_id"), F.posexplode("embedding").alias("feature", "v"))
            .select("row_id", F.col("feature").cast("int"), F.col("v").cast("double").alias("value")))


MATRIX_LONG_SQL = """(SELECT vec_id AS row_id, CAST(u.i - 1 AS INTEGER) AS feature,
       CAST(embedding[u.i] AS DOUBLE) AS value
  FROM embeddings, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i) u)"""


def label_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imbalanced binary label: ``label < 3``."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"), (F.col("label") < 3).cast("int").alias("label"))


LABEL_BINARY_SQL = "(SELECT vec_id AS row_id, CAST(label < 3 AS INTEGER) AS label FROM embeddings)"


def label_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five classes, ``label % 5`` (chi-square with 4 df has a closed-form tail)."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"), (F.col("label") % 5).cast("int").alias("label"))


LABEL_FIVE_SQL = "(SELECT vec_id AS row_id, CAST(label % 5 AS INTEGER) AS label FROM embeddings)"


def labelled_long(spark: SparkSession, sf_dir: str, labels: DataFrame) -> DataFrame:
    """``matrix_long`` with the columns of ``labels(row_id, ...)``: joined by sample first, then exploded."""
    e = read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding")
    return (e.join(labels, "row_id", "inner")
            .select("row_id", F.posexplode("embedding").alias("feature", "v"), *[c for c in labels.columns if c != "row_id"])
            .withColumn("value", F.col("v").cast("double")).drop("v"))


# ------------------------------------------------------------ clinical
def clinical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` with nulls made by key modulus (the tables have none)."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("row_id"),
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("c_acctbal")).alias("acctbal"),
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("segment"))


CLINICAL_SQL = """(SELECT c_custkey AS row_id,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS acctbal,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment
  FROM customer)"""


# ------------------------------------------------------------ nonneg_matrix
NONNEG_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def nonneg_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` numeric columns as LONG with a 3-class label (no row key)."""
    li = read_table(spark, sf_dir, "lineitem")
    wide = li.select(*[F.col(c).cast("double") for c in NONNEG_FEATURES],
                     F.col("l_returnflag").alias("label"))
    return wide.unpivot("label", list(NONNEG_FEATURES), "feature", "value")


NONNEG_MATRIX_SQL = ("(" + " UNION ALL ".join(
    f"SELECT l_returnflag AS label, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM lineitem"
    for c in NONNEG_FEATURES) + ")")


# ------------------------------------------------------------ scored
def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a scored binary table: ``(row_id, label, prob)``; prob in [0, 1), with ties."""
    ev = read_table(spark, sf_dir, "events")
    mx = ev.select(F.max("value")).scalar()  # scalar subquery, evaluated once
    return ev.select(F.col("event_id").alias("row_id"),
                     (F.col("event_type") == "purchase").cast("int").alias("label"),
                     (F.col("value") / (mx + F.lit(1.0))).alias("prob"))


SCORED_SQL = """(SELECT event_id AS row_id, CAST(event_type = 'purchase' AS INTEGER) AS label,
       value / ((SELECT max(value) FROM events) + 1.0) AS prob
  FROM events)"""

N_MODELS = 3
N_MODEL_FOLDS = 5


def scored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models (prob, prob^2, prob^3) on disjoint hash folds: ``(model, fold, row_id, label, prob)``."""
    s = scored(spark, sf_dir)
    models = F.explode(F.sequence(F.lit(0), F.lit(N_MODELS - 1))).alias("model")
    return (s.select("*", models)
            .select(F.col("model").cast("int"),
                    F.pmod(hash_int("fold", "row_id"), F.lit(N_MODEL_FOLDS)).cast("int").alias("fold"),
                    "row_id", "label",
                    F.pow(F.col("prob"), F.col("model") + F.lit(1)).alias("prob")))


SCORED_MODELS_SQL = f"""(SELECT CAST(m.model AS INTEGER) AS model,
       CAST({sql_hash_int('fold', 's.row_id')} % {N_MODEL_FOLDS} AS INTEGER) AS fold,
       s.row_id, s.label, pow(s.prob, m.model + 1) AS prob
  FROM {SCORED_SQL} s, (SELECT unnest(range(0, {N_MODELS})) AS model) m)"""


# ------------------------------------------------------------ imbalanced_docs
def imbalanced_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` x ``documents``: three text-size features and the ``toxic`` label."""
    lab = read_table(spark, sf_dir, "labels")
    doc = read_table(spark, sf_dir, "documents")
    j = lab.join(doc, "doc_id", "inner")
    return j.select(
        F.col("doc_id").alias("row_id"),
        F.col("n_chars").cast("double").alias("f1"),
        F.regexp_count(F.col("text"), F.lit(r"\S+")).cast("double").alias("f2"),
        F.size(F.split(F.col("text"), "\n")).cast("double").alias("f3"),
        F.col("toxic").cast("int").alias("label"))


IMBALANCED_DOCS_SQL = r"""(SELECT l.doc_id AS row_id, CAST(d.n_chars AS DOUBLE) AS f1,
       CAST(len(regexp_extract_all(d.text, '\S+')) AS DOUBLE) AS f2,
       CAST(len(string_split(d.text, chr(10))) AS DOUBLE) AS f3,
       CAST(l.toxic AS INTEGER) AS label
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def vector_table(long: DataFrame, labels: DataFrame | None = None, n_features: int | None = None) -> DataFrame:
    """LONG ``(row_id, feature:int, value)`` to VECTOR ``(row_id, features[, label])``.

    Features are gathered per row (one row's values only), ordered by index.
    """
    from pyspark.ml.functions import array_to_vector
    arr = (long.groupBy("row_id")
           .agg(F.sort_array(F.collect_list(F.struct("feature", "value"))).alias("fv"))
           .select("row_id", array_to_vector(F.transform("fv", lambda s: s["value"])).alias("features")))
    if labels is not None:
        arr = arr.join(labels, "row_id", "inner")
    return arr


def embeddings_vectors(spark: SparkSession, sf_dir: str, label: str = "binary") -> DataFrame:
    """``embeddings`` straight to VECTOR layout (no LONG round trip)."""
    from pyspark.ml.functions import array_to_vector
    e = read_table(spark, sf_dir, "embeddings")
    lab = (F.col("label") < 3).cast("int") if label == "binary" else (F.col("label") % 5).cast("int")
    return e.select(F.col("vec_id").alias("row_id"),
                    array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
                    lab.alias("label"))
