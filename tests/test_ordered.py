"""Block-wise running totals: exact against pandas, with one key holding a third of the rows."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohortml.functions.ordered import mid_ranks, row_numbers, running_totals


def _skewed(spark, n=3000):
    rng = np.random.default_rng(1)
    key = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 40, n))  # key 0 holds a third
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": rng.integers(0, 50, n).astype(float)})
    return pdf, spark.createDataFrame(pdf)


def test_running_sum_matches_pandas(spark):
    pdf, df = _skewed(spark)
    out = running_totals(df, ["k"], ["v", "id"], {"cs": F.col("v")}, n_blocks=16).toPandas()
    exp = pdf.sort_values(["k", "v", "id"]).assign(cs=lambda d: d.groupby("k")["v"].cumsum())
    m = out.merge(exp[["id", "cs"]], on="id", suffixes=("", "_e"))
    assert len(m) == len(pdf)
    assert np.allclose(m["cs"], m["cs_e"])


def test_hot_key_spreads_over_blocks(spark):
    _, df = _skewed(spark)
    from pyspark.sql import functions as F2
    blocks = (df.repartitionByRange(16, "k", "v", "id").withColumn("b", F2.spark_partition_id())
              .where("k = 0").select("b").distinct().count())
    assert blocks > 2


def test_row_numbers_and_mid_ranks(spark):
    pdf, df = _skewed(spark)
    rn = row_numbers(df, ["k"], ["v", "id"], "rn", n_blocks=8).toPandas()
    exp = pdf.sort_values(["k", "v", "id"]).assign(rn=lambda d: d.groupby("k").cumcount() + 1)
    m = rn.merge(exp[["id", "rn"]], on="id", suffixes=("", "_e"))
    assert (m["rn"] == m["rn_e"]).all()
    counts = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("cnt"))
    mr = mid_ranks(counts, ["k"], "v", "cnt", "rank", n_blocks=8).toPandas()
    pdf["r"] = pdf.groupby("k")["v"].rank(method="average")
    e = pdf.groupby(["k", "v"])["r"].first().reset_index()
    m2 = mr.merge(e, on=["k", "v"])
    assert len(m2) == len(e) and np.allclose(m2["rank"], m2["r"])
