"""Queries for evaluation, contributions and scoring with fixed weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import metrics as M
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

_S = V.with_(*V.scored_ctes())
T = M.DEFAULT_THRESHOLD


def _cm_sql(score="score", src="scored"):
    return f"""count(*) FILTER (WHERE NOT {score} >= {T} AND class <> 1) AS tn,
  count(*) FILTER (WHERE {score} >= {T} AND class <> 1) AS fp,
  count(*) FILTER (WHERE NOT {score} >= {T} AND class = 1) AS fn,
  count(*) FILTER (WHERE {score} >= {T} AND class = 1) AS tp"""


_RATES = """*, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
  COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall,
  COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0) AS f1,
  COALESCE(CAST(tp + tn AS DOUBLE) / NULLIF(tp + tn + fp + fn, 0), 0) AS accuracy,
  COALESCE(CAST(fp AS DOUBLE) / NULLIF(fp + tn, 0), 0) AS false_positive_rate"""
_RATE_COLS = ["precision", "recall", "f1", "accuracy", "false_positive_rate"]
_CM_COLS = ["tn", "fp", "fn", "tp"]


@query("confusion_matrix", final_sql(_S + f"SELECT {_cm_sql()} FROM scored", ints=_CM_COLS))
def q_confusion_matrix(spark, sf):
    return finish(M.confusion_matrix(TV.scored(spark, sf)))


@query("classification_metrics", final_sql(_S + f"SELECT {_RATES} FROM (SELECT {_cm_sql()} FROM scored)",
                                           doubles=_RATE_COLS, ints=_CM_COLS))
def q_classification_metrics(spark, sf):
    return finish(M.classification_metrics(TV.scored(spark, sf)))


def _curve_sql(score, src="scored"):
    return f"""SELECT {score} AS threshold,
  count(*) FILTER (WHERE class = 1) AS tp_at, count(*) FILTER (WHERE class <> 1) AS fp_at
FROM {src} WHERE {score} IS NOT NULL GROUP BY 1"""


def _ap_sql(score, src="scored", name="ap"):
    return f"""SELECT sum(tp_at * CAST(tp AS DOUBLE) / (tp + fp)) / max(pos) AS average_precision FROM (
  SELECT tp_at, sum(tp_at) OVER (ORDER BY threshold DESC) AS tp, sum(fp_at) OVER (ORDER BY threshold DESC) AS fp,
    (SELECT count(*) FROM {src} WHERE {score} IS NOT NULL AND class = 1) AS pos
  FROM ({_curve_sql(score, src)}) c) {name}"""


@query("average_precision", final_sql(_S + _ap_sql("score"), doubles=["average_precision"]))
def q_average_precision(spark, sf):
    return finish(M.average_precision(TV.scored(spark, sf)))


@query("optimal_threshold", final_sql(_S + f"""
SELECT max_by(threshold, (f1, threshold)) AS best_f1_threshold, max(f1) AS best_f1,
  min_by(threshold, (cost, -threshold)) AS min_cost_threshold, min(cost) AS min_cost
FROM (SELECT threshold, COALESCE(2.0 * tp / NULLIF(2.0 * tp + fp + (pos - tp), 0), 0) AS f1,
        fp * 5.0 + (pos - tp) * 250.0 AS cost
      FROM (SELECT threshold, sum(tp_at) OVER (ORDER BY threshold DESC) AS tp,
              sum(fp_at) OVER (ORDER BY threshold DESC) AS fp,
              (SELECT count(*) FROM scored WHERE score IS NOT NULL AND class = 1) AS pos
            FROM ({_curve_sql('score')}) c) c2) c3""",
                                      doubles=["best_f1_threshold", "best_f1", "min_cost_threshold",
                                               "min_cost"]))
def q_optimal_threshold(spark, sf):
    return finish(M.optimal_threshold(TV.scored(spark, sf)))


# Three fixed scoring rules over the same rows stand in for three models.
def _models_cols():
    return {"k_and_value": F.col("score"),
            "k_only": F.round(F.col("k") / 99.0, 4),
            "value_only": F.round(F.least(F.lit(1.0), F.col("purchase_value") / 300.0), 4)}


_MODELS_SQL = {"k_and_value": "score", "k_only": "round(k / 99.0, 4)",
               "value_only": "round(least(1.0, purchase_value / 300.0), 4)"}


def _compare_sql():
    src = ("sm", "SELECT *, " + ", ".join(f"{e} AS s_{n}" for n, e in _MODELS_SQL.items()) + " FROM scored")
    parts = []
    for n in _MODELS_SQL:
        parts.append(f"""SELECT {_RATES}, (SELECT average_precision FROM ({_ap_sql(f's_{n}', 'sm', 'a')})) AS average_precision,
  '{n}' AS model FROM (SELECT {_cm_sql(f's_{n}')} FROM sm)""")
    return final_sql(V.with_(*V.scored_ctes(), src) + "\nUNION ALL\n".join(parts),
                     doubles=_RATE_COLS + ["average_precision"], ints=_CM_COLS)


@query("compare_models", _compare_sql())
def q_compare_models(spark, sf):
    s = TV.scored(spark, sf)
    cols = _models_cols()
    s = s.withColumns({f"s_{n}": c for n, c in cols.items()})
    return finish(M.compare_models(s, {n: f"s_{n}" for n in cols}))


# Fixed weights of a linear stand-in model over three inputs.
COEF = {"purchase_value": 0.012, "age": -0.03, "k": 0.045}
INTERCEPT = -4.0


def _means_sql():
    return "SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in COEF) + " FROM scored"


def _contrib_items_sql():
    return [(c, f"{w} * (COALESCE({c}, m_{c}) - m_{c})") for c, w in COEF.items()]


@query("linear_contributions", final_sql(V.with_(*V.scored_ctes(), ("mm", _means_sql()), ("u", "\nUNION ALL\n".join(
    f"SELECT event_id, '{c}' AS feature, {e} AS contribution FROM scored, mm" for c, e in _contrib_items_sql())))
    + f"""
SELECT event_id, rank, feature, contribution, base_value FROM (
  SELECT event_id, feature, contribution,
    row_number() OVER (PARTITION BY event_id ORDER BY abs(contribution) DESC, feature DESC) AS rank
  FROM u) r, (SELECT {INTERCEPT} + {' + '.join(f'{w} * m_{c}' for c, w in COEF.items())} AS base_value FROM mm) b
WHERE rank <= 5""", doubles=["contribution", "base_value"], ints=["rank"]))
def q_linear_contributions(spark, sf):
    s = TV.scored(spark, sf)
    means = M.feature_means(s, list(COEF))
    return finish(M.linear_contributions(s, COEF, INTERCEPT, means, top=5))


@query("global_importance", final_sql(V.with_(*V.scored_ctes(), ("mm", _means_sql())) + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, avg(abs({e})) AS importance FROM scored, mm" for c, e in _contrib_items_sql()),
    doubles=["importance"]))
def q_global_importance(spark, sf):
    s = TV.scored(spark, sf)
    return finish(M.global_importance(s, COEF, M.feature_means(s, list(COEF))))


@query("score_threshold", final_sql(V.with_(*V.scored_ctes(), ("mm", _means_sql())) + f"""
SELECT event_id, p AS fraud_probability, CASE WHEN p >= {T} THEN 1 ELSE 0 END AS is_fraud FROM (
  SELECT event_id, 1.0 / (1.0 + exp(-({INTERCEPT} + {' + '.join(f'{w} * COALESCE({c}, m_{c})' for c, w in COEF.items())}))) AS p
  FROM scored, mm)""", doubles=["fraud_probability"], ints=["is_fraud"]))
def q_score_threshold(spark, sf):
    s = TV.scored(spark, sf)
    return finish(M.score_with_threshold(s, COEF, INTERCEPT, means=M.feature_means(s, list(COEF))))
