"""Queries for class rebalancing (F6, F7) on the embeddings fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import balance as B
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

_PAIRS_MIN = """SELECT a.vec_id, b.vec_id AS nb, list_distance(a.e, b.e) AS d
FROM m a JOIN m b ON a.vec_id <> b.vec_id"""


@query("smote_neighbors", final_sql(V.with_(("vec", V.VEC), ("m", """
SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM vec WHERE y = 1"""), ("p", _PAIRS_MIN)) + """
SELECT vec_id, rank, nb AS neighbor_id, d AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, nb) AS rank FROM p) r WHERE rank <= 5""",
                                    doubles=["distance"], ints=["rank"]))
def q_smote_neighbors(spark, sf):
    v = TV.vec(spark, sf)
    mino = v.where(F.col("y") == 1).withColumn("embedding", F.col("embedding").cast("array<double>"))
    return finish(B.knn_long(B.knn(mino, mino, 5)))


@query("smote_counts", final_sql(V.with_(("vec", V.VEC)) + """
SELECT y, max(n) OVER () AS n FROM (SELECT y, count(*) AS n FROM vec GROUP BY y) c""", ints=["y", "n"]))
def q_smote_counts(spark, sf):
    return finish(B.smote(TV.vec(spark, sf)).groupBy("y").agg(F.count("*").alias("n")))


def _digest(df):
    """Rows of a sampler with their vector as its first component and its sum."""
    e = F.col("embedding")
    return finish(df.select("vec_id", "y", "synthetic", "seed_id", "nb_id", "copy", "u", e[0].alias("v_first"),
                            F.aggregate(e, F.lit(0.0), lambda a, x: a + x).alias("v_sum")))


def _draw_sql(seed: int, *cols: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"CAST({c} AS VARCHAR)" for c in cols]])
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


def _synthetic_sql(*ctes: tuple[str, str]) -> str:
    """Originals and synthetic rows; the last CTE is ``seeds`` (vec_id, n): copies per row."""
    return final_sql(V.with_(("vec", V.VEC), ("a", "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, y FROM vec"),
                             ("m", "SELECT * FROM a WHERE y = 1"), ("near", f"""
SELECT vec_id, list(nb ORDER BY d, nb)[1:5] AS nbs FROM ({_PAIRS_MIN}) p GROUP BY vec_id"""), *ctes, ("c", f"""
SELECT s.vec_id, s.copy, nbs[1 + {_draw_sql(42, 's.vec_id', 's.copy')} % len(nbs)] AS nb_id,
  {_draw_sql(43, 's.vec_id', 's.copy')} / 4503599627370496.0 AS u
FROM (SELECT vec_id, unnest(range(n)) AS copy FROM seeds) s JOIN near USING (vec_id)"""), ("r", """
SELECT CAST(NULL AS BIGINT) AS vec_id, 1 AS y, 1 AS synthetic, c.vec_id AS seed_id, c.nb_id, c.copy, c.u,
  list_transform(range(1, len(x.e) + 1), lambda i: x.e[i] + c.u * (z.e[i] - x.e[i])) AS e
FROM c JOIN m x ON x.vec_id = c.vec_id JOIN m z ON z.vec_id = c.nb_id
UNION ALL SELECT vec_id, y, 0, NULL, NULL, NULL, NULL, e FROM a""")) + """
SELECT vec_id, y, synthetic, seed_id, nb_id, copy, u, e[1] AS v_first, list_sum(e) AS v_sum FROM r""",
                     doubles=["u", "v_first", "v_sum"], ints=["vec_id", "y", "synthetic", "seed_id", "nb_id", "copy"])


@query("smote", _synthetic_sql(("seeds", f"""
SELECT vec_id, (SELECT count(*) FILTER (WHERE y = 0) - count(*) FILTER (WHERE y = 1) FROM a) // count(*) OVER ()
  + CASE WHEN row_number() OVER (ORDER BY {_draw_sql(42, 'vec_id')})
      <= (SELECT count(*) FILTER (WHERE y = 0) - count(*) FILTER (WHERE y = 1) FROM a) % count(*) OVER () THEN 1 ELSE 0 END AS n
FROM m""")))
def q_smote(spark, sf):
    return _digest(B.smote(TV.vec(spark, sf)))


@query("adasyn_weights", final_sql(V.with_(("vec", V.VEC), ("a", """
SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, y FROM vec"""), ("p", """
SELECT m.vec_id, o.vec_id AS nb, o.y AS nby, list_distance(m.e, o.e) AS d
FROM a m JOIN a o ON m.vec_id <> o.vec_id WHERE m.y = 1"""), ("t", """
SELECT vec_id, count(*) FILTER (WHERE nby <> 1) AS n_majority_nb FROM (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, nb) AS rk FROM p) r WHERE rk <= 5 GROUP BY vec_id"""),
    ("s", "SELECT sum(n_majority_nb) AS tot FROM t"), ("g", """
SELECT (SELECT count(*) FROM vec WHERE y = 0) - (SELECT count(*) FROM vec WHERE y = 1) AS gap""")) + """
SELECT vec_id, n_majority_nb, n_majority_nb / tot AS ratio,
  CAST(round_even(n_majority_nb * gap / tot, 0) AS BIGINT) AS n_generate FROM t, s, g""",
                                   doubles=["ratio"], ints=["n_majority_nb", "n_generate"]))
def q_adasyn_weights(spark, sf):
    return finish(B.adasyn_weights(TV.vec(spark, sf), minority=1))


@query("adasyn", _synthetic_sql(("t", """
SELECT vec_id, count(*) FILTER (WHERE nby <> 1) AS k FROM (
  SELECT m.vec_id, o.y AS nby, row_number() OVER (PARTITION BY m.vec_id ORDER BY list_distance(m.e, o.e), o.vec_id) AS rk
  FROM m JOIN a o ON m.vec_id <> o.vec_id) q WHERE rk <= 5 GROUP BY vec_id"""), ("seeds", """
SELECT vec_id, CAST(round_even(k * (SELECT count(*) FILTER (WHERE y = 0) - count(*) FILTER (WHERE y = 1) FROM a)
  / (SELECT sum(k) FROM t), 0) AS BIGINT) AS n FROM t""")))
def q_adasyn(spark, sf):
    return _digest(B.adasyn(TV.vec(spark, sf)))
