"""Registered queries: exact kNN join, resamplers and the kNN classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortml.functions.hashing import sql_hash_int, sql_hash_uniform
from cohortml.operators import folds
from cohortml.operators import neighbors as N
from cohortml.queries import register
from cohortml.sources import tables as T

M, LB, ID = T.MATRIX_LONG_SQL, T.LABEL_BINARY_SQL, T.IMBALANCED_DOCS_SQL


def emb(spark, sf):
    e = T.read_table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("row_id"), F.transform("embedding", lambda v: v.cast("double")).alias("x"),
                    (F.col("label") < 3).cast("int").alias("label"))


def docs(spark, sf):
    d = T.imbalanced_docs(spark, sf)
    return d.select("row_id", F.array("f1", "f2", "f3").alias("x"), "label")


@register("knn_join", rounded=("dist",), sql=f"""
WITH m AS (SELECT * FROM {M} _m),
p AS (SELECT a.row_id, b.row_id AS nn_key, sum((a.value - b.value) * (a.value - b.value)) AS d2
        FROM m a JOIN m b ON a.feature = b.feature AND a.row_id <> b.row_id GROUP BY a.row_id, b.row_id),
r AS (SELECT row_id, nn_key, sqrt(d2) AS dist,
             CAST(row_number() OVER (PARTITION BY row_id ORDER BY d2, nn_key) AS INTEGER) AS nn_rank FROM p)
SELECT * FROM r WHERE nn_rank <= 5""")
def q_knn_join(spark, sf):
    e = emb(spark, sf)
    return N.knn_join(e, e, 5, exclude_self=True)


def _long(df):
    return df.select("row_id", "replica", "label", F.posexplode("x").alias("feature", "value"))


_D = f"(SELECT row_id, f1, f2, f3, label FROM {ID} _d)"
_D2 = "(a.f1 - b.f1) * (a.f1 - b.f1) + (a.f2 - b.f2) * (a.f2 - b.f2) + (a.f3 - b.f3) * (a.f3 - b.f3)"
_CLASSES = f"""
d AS (SELECT * FROM {_D} _x),
cnt AS (SELECT label, count(*) AS n FROM d GROUP BY label),
mino AS (SELECT label FROM cnt ORDER BY n, label LIMIT 1),
majo AS (SELECT max(n) AS n FROM cnt),
mi AS (SELECT * FROM d WHERE label = (SELECT label FROM mino))"""


def _synth_sql(base: str) -> str:
    h = sql_hash_int(42, "base.row_id")
    return f"""
nb AS (SELECT count(*) AS n FROM {base}),
need AS (SELECT (SELECT n FROM majo) - (SELECT count(*) FROM mi) AS n),
pos AS (SELECT row_id, f1, f2, f3, row_number() OVER (ORDER BY {h}, row_id) AS p FROM {base} base),
reps AS (SELECT pos.*, CAST(r.replica AS INTEGER) AS replica
           FROM pos, LATERAL (SELECT unnest(range(0, (SELECT n FROM need) // (SELECT n FROM nb)
                   + CASE WHEN pos.p <= (SELECT n FROM need) % (SELECT n FROM nb) THEN 1 ELSE 0 END)) AS replica) r),
nn AS (SELECT a.row_id, b.f1 AS nf1, b.f2 AS nf2, b.f3 AS nf3,
              row_number() OVER (PARTITION BY a.row_id ORDER BY {_D2}, b.row_id) AS nn_rank
         FROM {base} a JOIN mi b ON a.row_id <> b.row_id),
syn AS (SELECT r.row_id, r.replica, (SELECT label FROM mino) AS label,
               r.f1 + {sql_hash_uniform('42:gap', 'r.row_id', 'r.replica')} * (nn.nf1 - r.f1) AS f1,
               r.f2 + {sql_hash_uniform('42:gap', 'r.row_id', 'r.replica')} * (nn.nf2 - r.f2) AS f2,
               r.f3 + {sql_hash_uniform('42:gap', 'r.row_id', 'r.replica')} * (nn.nf3 - r.f3) AS f3
          FROM reps r JOIN nn ON r.row_id = nn.row_id
           AND nn.nn_rank = {sql_hash_int(42, 'r.row_id', 'r.replica')} % 5 + 1),
allr AS (SELECT row_id, -1 AS replica, label, f1, f2, f3 FROM d UNION ALL SELECT * FROM syn)
SELECT row_id, replica, label, 0 AS feature, f1 AS value FROM allr
UNION ALL SELECT row_id, replica, label, 1, f2 FROM allr
UNION ALL SELECT row_id, replica, label, 2, f3 FROM allr"""


@register("rs_smote", rounded=("value",), sql=f"WITH {_CLASSES}," + _synth_sql("mi"))
def q_rs_smote(spark, sf):
    return _long(N.rs_smote(docs(spark, sf)))


_DANGER = f"""
nnall AS (SELECT a.row_id, b.label AS nl,
                 row_number() OVER (PARTITION BY a.row_id ORDER BY {_D2}, b.row_id) AS rk
            FROM mi a JOIN d b ON a.row_id <> b.row_id),
dg AS (SELECT row_id FROM nnall WHERE rk <= 10 GROUP BY row_id
        HAVING sum(CASE WHEN nl <> (SELECT label FROM mino) THEN 1 ELSE 0 END) >= 5
           AND sum(CASE WHEN nl <> (SELECT label FROM mino) THEN 1 ELSE 0 END) < 10),
dmi AS (SELECT * FROM mi WHERE row_id IN (SELECT row_id FROM dg))"""


@register("rs_borderline", rounded=("value",), sql=f"WITH {_CLASSES}, {_DANGER}," + _synth_sql("dmi"))
def q_rs_borderline(spark, sf):
    return _long(N.rs_borderline(docs(spark, sf)))


_TOMEK = f"""
nn1 AS (SELECT a.row_id, b.row_id AS nn_key, a.label AS l, b.label AS nl,
               row_number() OVER (PARTITION BY a.row_id ORDER BY {_D2}, b.row_id) AS rk
          FROM d a JOIN d b ON a.row_id <> b.row_id),
f AS (SELECT row_id, nn_key, l, nl FROM nn1 WHERE rk = 1),
links AS (SELECT x.row_id, x.l FROM f x JOIN f y ON x.row_id = y.nn_key AND x.nn_key = y.row_id WHERE x.l <> x.nl)"""


@register("rs_tomek", sql=f"""WITH {_CLASSES}, {_TOMEK}
SELECT row_id, label FROM d
 WHERE row_id NOT IN (SELECT row_id FROM links WHERE l <> (SELECT label FROM mino))""")
def q_rs_tomek(spark, sf):
    return N.rs_tomek(docs(spark, sf)).select("row_id", "label")


@register("tomek_links", sql=f"""WITH {_CLASSES}, {_TOMEK}
SELECT x.row_id, x.nn_key FROM f x JOIN f y ON x.row_id = y.nn_key AND x.nn_key = y.row_id WHERE x.l <> x.nl""")
def q_tomek_links(spark, sf):
    return N.tomek_links(docs(spark, sf))


@register("rs_smotetomek")
def q_rs_smotetomek(spark, sf):
    return _long(N.rs_smotetomek(docs(spark, sf)))


@register("rs_centroids")
def q_rs_centroids(spark, sf):
    out = N.rs_centroids(docs(spark, sf))
    return out.select("row_id", "label", F.posexplode("x").alias("feature", "value"))


_SPLIT = folds.split_sql(LB)


@register("fam_knn", rounded=("prob",), sql=f"""
WITH s AS (SELECT * FROM {_SPLIT} _s), m AS (SELECT * FROM {M} _m),
te AS (SELECT m.* FROM m JOIN s ON m.row_id = s.row_id WHERE s.split = 'test'),
tr AS (SELECT m.*, s.label FROM m JOIN s ON m.row_id = s.row_id WHERE s.split = 'train'),
p AS (SELECT a.row_id, b.row_id AS nn_key, any_value(b.label) AS nl,
             sum((a.value - b.value) * (a.value - b.value)) AS d2
        FROM te a JOIN tr b ON a.feature = b.feature GROUP BY a.row_id, b.row_id),
r AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d2, nn_key) AS rk FROM p)
SELECT r.row_id, any_value(s.label) AS label, avg(CAST(nl = 1 AS DOUBLE)) AS prob
  FROM r JOIN s ON r.row_id = s.row_id WHERE rk <= 5 GROUP BY r.row_id""")
def q_fam_knn(spark, sf):
    e = folds.stratified_split(emb(spark, sf))
    return N.knn_predict(e.where("split = 'test'"), e.where("split = 'train'"), 5)
