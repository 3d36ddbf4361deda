"""Queries for data profiling."""

from __future__ import annotations

from kestrel.operators import profile as PF
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

TX_COLS = ("event_id", "user_id", "signup_time", "purchase_time", "purchase_value", "device_id",
           "source", "browser", "sex", "age", "ip_int", "class")
TX_NUM = ("event_id", "user_id", "purchase_value", "age", "ip_int", "class")
TX_TEXT = ("device_id", "source", "browser", "sex")
_W = V.with_(*V.tx_ctes())


# G1 ---------------------------------------------------------------------------
@query("overview", final_sql(_W + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {i} AS ordinal, count(*) AS n_rows, count({c}) AS n_non_null FROM tx"
    for i, c in enumerate(TX_COLS)), ints=["ordinal", "n_rows", "n_non_null"]))
def q_overview(spark, sf):
    return finish(PF.overview(TV.tx(spark, sf)))


# G2 ---------------------------------------------------------------------------
_DESC = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


@query("describe_numeric", final_sql(_W + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
  CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
  quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM tx""" for c in TX_NUM),
    doubles=_DESC[1:], ints=["count"]))
def q_describe_numeric(spark, sf):
    return finish(PF.describe_numeric(TV.tx(spark, sf), list(TX_NUM)))


@query("describe_text", final_sql(_W + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, count(DISTINCT {c}) AS "unique",
  (SELECT {c} FROM tx WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
  (SELECT count(*) FROM tx WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq
  FROM tx""" for c in TX_TEXT), ints=["count", "unique", "freq"]))
def q_describe_text(spark, sf):
    return finish(PF.describe_text(TV.tx(spark, sf), list(TX_TEXT)))


# G3 ---------------------------------------------------------------------------
@query("missing_report", final_sql(_W + "SELECT * FROM (" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing,
  (count(*) - count({c})) / count(*) AS share_missing FROM tx""" for c in TX_COLS)
    + ") m WHERE n_missing > 0", doubles=["share_missing"], ints=["n_missing"]))
def q_missing_report(spark, sf):
    return finish(PF.missing_report(TV.tx(spark, sf)))


# G5 / G6 ----------------------------------------------------------------------
@query("histogram", final_sql(V.with_(*V.tx_ctes(), ("st", """
SELECT min(purchase_value) AS lo, max(purchase_value) AS hi FROM tx"""), ("b", """
SELECT least(floor((purchase_value - lo) * (50 / (hi - lo))), 49) AS bin, count(*) AS c
FROM tx, st WHERE purchase_value IS NOT NULL GROUP BY 1""")) + """
SELECT g.range AS bin, lo + g.range * ((hi - lo) / 50) AS lower, lo + (g.range + 1) * ((hi - lo) / 50) AS upper,
  COALESCE(b.c, 0) AS count
FROM range(50) g CROSS JOIN st LEFT JOIN b ON b.bin = g.range""",
                             doubles=["lower", "upper"], ints=["bin", "count"]))
def q_histogram(spark, sf):
    return finish(PF.histogram(TV.tx(spark, sf), "purchase_value", bins=50))


@query("kde", final_sql(V.with_(*V.tx_ctes(), ("st", """
SELECT count(purchase_value) AS n, stddev_samp(purchase_value) * pow(count(purchase_value), -0.2) AS bw,
  min(purchase_value) AS lo, (max(purchase_value) - min(purchase_value)) / 199 AS step FROM tx"""), ("v", """
SELECT purchase_value AS v, count(*) AS c FROM tx WHERE purchase_value IS NOT NULL GROUP BY 1""")) + """
SELECT g.range AS point, lo + g.range * step AS x,
  sum(c * exp(-0.5 * pow((lo + g.range * step - v) / bw, 2))) / (n * bw * sqrt(2 * pi())) AS density
FROM range(200) g CROSS JOIN st CROSS JOIN v GROUP BY g.range, lo, step, n, bw""",
                       doubles=["x", "density"], ints=["point"]))
def q_kde(spark, sf):
    return finish(PF.kde(TV.tx(spark, sf), "purchase_value", points=200))


# G7 / G8 ----------------------------------------------------------------------
@query("count_by_class", final_sql(_W + "SELECT source, class, count(*) AS n FROM tx GROUP BY 1, 2",
                                   ints=["class", "n"]))
def q_count_by_class(spark, sf):
    return finish(PF.count_by_class(TV.tx(spark, sf), "source"))


@query("box_stats", final_sql(V.with_(*V.tx_ctes(), ("q", """
SELECT class, quantile_cont(purchase_value, 0.25) AS q1, quantile_cont(purchase_value, 0.5) AS median,
  quantile_cont(purchase_value, 0.75) AS q3 FROM tx WHERE purchase_value IS NOT NULL GROUP BY class""")) + """
SELECT q.class, q1, median, q3,
  min(purchase_value) FILTER (WHERE purchase_value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS lower_whisker,
  max(purchase_value) FILTER (WHERE purchase_value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS upper_whisker,
  count(*) FILTER (WHERE NOT purchase_value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM tx JOIN q USING (class) WHERE purchase_value IS NOT NULL GROUP BY q.class, q1, median, q3""",
                              doubles=["q1", "median", "q3", "lower_whisker", "upper_whisker"],
                              ints=["class", "n_outliers"]))
def q_box_stats(spark, sf):
    return finish(PF.box_stats(TV.tx(spark, sf), "purchase_value", "class"))


# G10 / G11 ----------------------------------------------------------------------
_CORR = ("purchase_value", "age", "ip_int", "class")


@query("correlation", final_sql(_W + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM tx"
    for a in _CORR for b in _CORR), doubles=["corr"]))
def q_correlation(spark, sf):
    return finish(PF.correlation(TV.tx(spark, sf), list(_CORR)))


@query("kruskal_h", final_sql(V.with_(*V.tx_ctes(), ("r", """
SELECT class AS g, rank() OVER (ORDER BY purchase_value)
  + (count(*) OVER (PARTITION BY purchase_value) - 1) / 2.0 AS rk
FROM tx WHERE purchase_value IS NOT NULL"""), ("t", """
SELECT sum(pow(c, 3) - c) AS T FROM (SELECT count(*) AS c FROM tx WHERE purchase_value IS NOT NULL
GROUP BY purchase_value)"""), ("gs", "SELECT g, count(*) AS n, sum(rk) AS rs FROM r GROUP BY g"), ("a", """
SELECT CAST(sum(n) AS DOUBLE) AS N, sum(rs * rs / n) AS S, count(*) AS k, min(n) AS min_n FROM gs""")) + """
SELECT (12.0 / (N * (N + 1)) * S - 3 * (N + 1)) / (1 - T / (N * N * N - N)) AS h, k - 1 AS dof,
  N AS n_total, CASE WHEN k >= 2 AND min_n > 1 THEN 1 ELSE 0 END AS groups_ok FROM a, t""",
                              doubles=["h"], ints=["dof", "n_total", "groups_ok"]))
def q_kruskal_h(spark, sf):
    return finish(PF.kruskal_table(TV.tx(spark, sf), "purchase_value", "class"))
