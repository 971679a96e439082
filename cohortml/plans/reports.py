"""Report drivers: feature retrieval and the visual report, as dictionaries of tables."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortml.functions.arrays import fold_sum, list_matrix
from cohortml.operators import evaluate as E
from cohortml.operators import explain as X
from cohortml.operators.project import fit_kernel_pca, fit_pca
from cohortml.plans.pipeline import FittedPipeline


def retrieve_features(fp: FittedPipeline, train: DataFrame, test: DataFrame, names: list[str] | None = None,
                      n_perm: int = 4, n_background: int = 100) -> dict:
    """Univariate report, embedded report, learner report, then explanations of train and test.

    ``names``: feature names (by default their positions). Explanations name the selected features,
    or the components if there is a learner. They are exact for a logistic final model
    (phi = w (z - mean) in log-odds space); any other model is explained by permutation attributions
    of its class-1 probability with ``n_perm`` orders and ``n_background`` training rows."""
    spark = train.sparkSession
    out = {}
    width = int(train.select(F.size("x")).first()[0])
    names = [str(n) for n in (names or range(width))]
    if fp.scores1 is not None:
        out["first_filter"] = spark.createDataFrame(
            [(names[int(r["feature"])], float(r["score"]), r["pvalue"]) for r in fp.scores1 if r["selected"]],
            "feature_name string, score double, pvalue double")
    if fp.importances2 is not None:
        base = fp.keep1 if fp.keep1 is not None else list(range(len(fp.importances2)))
        out["second_filter"] = spark.createDataFrame(
            [(names[int(base[i])], float(fp.importances2[i])) for i in fp.keep2],
            "feature_name string, feature_importance double")
    chosen = [names[i] for i in fp.selected(width)]
    if fp.pca is not None:
        out["learner"] = fp.pca.report(spark, chosen) if hasattr(fp.pca, "report") else fp.pca.loadings(spark, chosen)
    both = train.select("row_id", "x", "label").unionByName(test.select("row_id", "x", "label"))
    inp = fp.transform(both)
    if fp.model.family == "logistic":
        w = [float(v) for v in fp.model.model.coefficients.toArray()]
        long = inp.select("row_id", F.posexplode("x").alias("feature", "value"))
        wl = F.element_at(F.array(*[F.lit(v) for v in w]), F.col("feature") + 1)
        phi = X.linear_attributions(long, wl, float(fp.model.model.intercept))
    else:
        phi = X.permutation_attributions(fp.model.predict, inp, fp.transform(train), n_perm, n_background)
    labels = F.array(*[F.lit(n) for n in fp.input_names(names)])
    phi = phi.withColumn("feature", F.element_at(labels, F.col("feature") + 1))
    out["shap"] = phi
    out["shap_mean_abs"] = X.shap_mean_abs(phi)
    return out


def projection_report(data: DataFrame, features: list[int], kernel: str = "rbf", **options) -> DataFrame:
    """``row_id, label, method, c1, c2``: two-dimensional PCA and kernel PCA of the listed features.

    The features are scaled to zero mean and unit (population) deviation over ``data`` itself."""
    d = data.select("row_id", "label", F.array(*[F.element_at("x", int(i) + 1) for i in features]).alias("x"))
    width = len(features)
    stats = fold_sum(d.select("x"), lambda b: np.append(list_matrix(b.column(0)).sum(axis=0), b.num_rows))
    mean = stats[:width] / stats[width]
    centred = d.withColumn("x", F.transform("x", lambda v, i: v - F.element_at(F.array(*[F.lit(float(m)) for m in mean]), i + 1)))
    second = fold_sum(centred.select("x"), lambda b: (list_matrix(b.column(0)) ** 2).sum(axis=0)) / stats[width]
    scale = F.array(*[F.lit(float(s) if s > 0 else 1.0) for s in np.sqrt(second)])
    scaled = centred.withColumn("x", F.transform("x", lambda v, i: v / F.element_at(scale, i + 1)))
    parts = [("pca", fit_pca(scaled, 2)), ("kpca", fit_kernel_pca(scaled, 2, kernel, **options))]
    tables = [p.transform(scaled).select("row_id", "label", F.lit(name).alias("method"), F.get("x", F.lit(0)).alias("c1"),
                                         F.get("x", F.lit(1)).alias("c2")) for name, p in parts]
    return tables[0].unionByName(tables[1])


def visual_report(fp: FittedPipeline, train: DataFrame, test: DataFrame) -> dict:
    """The tables behind the evaluation plots, for train and test predictions, and the projections of the selected features."""
    preds = (fp.predict(train).withColumn("split", F.lit("train"))
             .unionByName(fp.predict(test).withColumn("split", F.lit("test"))))
    preds = preds.checkpoint(eager=True)  # eleven tables read it
    width = int(train.select(F.size("x")).first()[0])
    both = train.select("row_id", "x", "label").unionByName(test.select("row_id", "x", "label"))
    gain = E.gain_curve(preds)
    return {
        "confusion": E.confusion_matrix(preds, ["split"]),
        "report": E.classification_report(preds, ["split"]),
        "roc": E.roc_curve(preds, ["split"]),
        "pr": E.pr_curve(preds, ["split"]),
        "average_precision": E.m_average_precision(preds, ["split"]),
        "gain": gain.drop("lift"),
        "lift": gain.drop("gain"),
        "calibration": E.calibration_curve(preds),
        "histogram": E.probability_histogram(preds),
        "ks_curve": E.ks_curve(preds),
        "ks": E.m_ks(preds),
        "projection": projection_report(both, fp.selected(width)),
    }


def one_table(tables: dict) -> DataFrame:
    """All rows of all tables, with the table's name as ``report`` and null for columns it does not have."""
    parts = [df.select(F.lit(name).alias("report"), "*") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
