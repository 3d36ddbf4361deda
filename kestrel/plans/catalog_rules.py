"""Queries for decision rules, costs and fraud patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.joins import attach_country_codes
from kestrel.operators import features as FE
from kestrel.operators import geo
from kestrel.operators import patterns as P
from kestrel.operators import rules as R
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.catalog_features import tss_ctes
from kestrel.plans.catalog_geo import COUNTRY_CTE
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

VELOCITY_SQL = """count(*) OVER (PARTITION BY user_id ORDER BY purchase_time
  RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)"""


def decision_inputs(spark, sf):
    """Scored rows with every field the rules read: fraud_probability,
    country (code), time_since_signup (hours), purchase_value, txn_velocity."""
    s = TV.scored(spark, sf)
    ranges = geo.clean_ranges(TV.ip_ranges(spark, sf))
    s = geo.map_ips_to_countries(s, ranges, ip_col="ip_int", out_col="country_name")
    s = attach_country_codes(s, TV.country_codes(spark, sf), "country_name", "country")
    s = FE.add_time_since_signup(s, out_col="time_since_signup")
    s = P.velocity(s)
    return s.withColumn("fraud_probability", F.col("score"))


def _inputs_ctes():
    return [*V.scored_ctes(), ("r0", V.ranges("nation")), ("r", V.RANGES_DEDUP), ("sc", """
SELECT s.*, CASE WHEN s.ip_int <= r.up THEN r.country ELSE 'Unknown' END AS country_name
FROM scored s ASOF LEFT JOIN r ON s.ip_int >= r.lo"""), ("cc", V.CODES), ("sc2", """
SELECT sc.*, cc.code AS country FROM sc LEFT JOIN cc ON sc.country_name = cc.country"""),
            *tss_ctes("sc2"), ("di", f"""
SELECT * EXCLUDE (time_since_signup_hours), time_since_signup_hours AS time_since_signup,
  score AS fraud_probability, {VELOCITY_SQL} AS txn_velocity FROM h1""")]


def _conds():
    fw = R.DEFAULT_RULES["decision_framework"]
    return [(g, i, c) for g in R.DECISION_ORDER for i, c in enumerate(fw[g]["conditions"])]


def _cond_sql(c):
    f, op, v = c["field"], c["operator"], c["value"]
    if op == "in":
        return f"COALESCE({f} IN ({', '.join(repr(x) for x in v)}), false)"
    return f"COALESCE({f} {op} {v}, false)"


@query("rule_conditions", final_sql(V.with_(*_inputs_ctes()) + "SELECT event_id, " + ", ".join(
    f"CASE WHEN {_cond_sql(c)} THEN 1 ELSE 0 END AS {g}_{i}" for g, i, c in _conds()) + " FROM di",
    ints=[f"{g}_{i}" for g, i, _ in _conds()]))
def q_rule_conditions(spark, sf):
    d = decision_inputs(spark, sf)
    return finish(d.select("event_id", *[R.condition(c, d.columns).cast("int").alias(f"{g}_{i}")
                                         for g, i, c in _conds()]))


def _decision_sql():
    fw = R.DEFAULT_RULES["decision_framework"]
    whens = " ".join(
        f"WHEN {' OR '.join(_cond_sql(c) for c in fw[g]['conditions'])} THEN '{g}'" for g in R.DECISION_ORDER)
    fired = ", ".join(f"CASE WHEN {_cond_sql(c)} THEN '{g}:{R.rule_name(c)}' END" for g, _, c in _conds())
    return f"CASE {whens} ELSE 'approve' END AS decision, concat_ws(',', {fired}) AS fired_rules"


_DECIDED = ("dd", f"SELECT *, {_decision_sql()} FROM di")


@query("decisions", V.with_(*_inputs_ctes()) + f"SELECT event_id, {_decision_sql()} FROM di")
def q_decisions(spark, sf):
    return finish(R.decide(decision_inputs(spark, sf)).select("event_id", "decision", "fired_rules"))


_COST = R.DEFAULT_RULES["cost_parameters"]


@query("decision_cost", final_sql(V.with_(*_inputs_ctes(), _DECIDED) + f"""
SELECT n_false_positive, n_false_negative, n_review,
  n_false_positive * {_COST['false_positive_cost']} AS cost_false_positive,
  n_false_negative * {_COST['false_negative_cost']} AS cost_false_negative,
  n_review * {_COST['review_cost']} AS cost_review,
  n_false_positive * {_COST['false_positive_cost']} + n_false_negative * {_COST['false_negative_cost']}
    + n_review * {_COST['review_cost']} AS total_cost
FROM (SELECT count(*) FILTER (WHERE decision = 'auto_decline' AND class <> 1) AS n_false_positive,
  count(*) FILTER (WHERE decision = 'approve' AND class = 1) AS n_false_negative,
  count(*) FILTER (WHERE decision = 'manual_review') AS n_review FROM dd)""",
                                  doubles=["cost_false_positive", "cost_false_negative", "cost_review",
                                           "total_cost"],
                                  ints=["n_false_positive", "n_false_negative", "n_review"]))
def q_decision_cost(spark, sf):
    return finish(R.decision_cost(R.decide(decision_inputs(spark, sf))))


_RP = R.DEFAULT_RULES["risk_parameters"]


@query("risk_flags", final_sql(V.with_(*_inputs_ctes()) + f"""
SELECT event_id,
  CASE WHEN COALESCE(country IN ({', '.join(repr(x) for x in _RP['high_risk_countries'])}), false) THEN 1 ELSE 0 END
    AS high_risk_country,
  CASE WHEN COALESCE(time_since_signup < {_RP['new_account_threshold']}, false) THEN 1 ELSE 0 END AS new_account,
  CASE WHEN COALESCE(purchase_value > {_RP['high_value_threshold']}, false) THEN 1 ELSE 0 END AS high_value
FROM di""", ints=["high_risk_country", "new_account", "high_value"]))
def q_risk_flags(spark, sf):
    out = R.risk_flags(decision_inputs(spark, sf))
    return finish(out.select("event_id", "high_risk_country", "new_account", "high_value"))


@query("net_saving", final_sql(V.with_(*_inputs_ctes(), _DECIDED) + f"""
SELECT *, n_fraud_stopped * {_COST['false_negative_cost']} AS loss_avoided,
  n_false_positive * {_COST['false_positive_cost']} AS false_positive_cost,
  n_transactions * {R.PREVENTION_COST} AS prevention_cost,
  n_fraud_stopped * {_COST['false_negative_cost']} - n_false_positive * {_COST['false_positive_cost']}
    - n_transactions * {R.PREVENTION_COST} AS net_saving
FROM (SELECT count(*) FILTER (WHERE decision <> 'approve' AND class = 1) AS n_fraud_stopped,
  count(*) FILTER (WHERE decision = 'auto_decline' AND class <> 1) AS n_false_positive,
  count(*) AS n_transactions FROM dd)""",
                               doubles=["loss_avoided", "false_positive_cost", "prevention_cost", "net_saving"],
                               ints=["n_fraud_stopped", "n_false_positive", "n_transactions"]))
def q_net_saving(spark, sf):
    return finish(R.net_saving(R.decide(decision_inputs(spark, sf))))


# Patterns -----------------------------------------------------------------------
@query("pattern_new_account", final_sql(V.with_(*V.tx_ctes(), *tss_ctes("tx")) + """
SELECT *, CAST(n_new_fraud AS DOUBLE) / NULLIF(n_new, 0) AS fraud_rate_new,
  CAST(n_new_fraud AS DOUBLE) / NULLIF(n_fraud, 0) AS share_of_fraud_new
FROM (SELECT count(*) FILTER (WHERE time_since_signup_hours < 2) AS n_new,
  count(*) FILTER (WHERE time_since_signup_hours < 2 AND class = 1) AS n_new_fraud,
  count(*) FILTER (WHERE class = 1) AS n_fraud FROM h1)""",
                                        doubles=["fraud_rate_new", "share_of_fraud_new"],
                                        ints=["n_new", "n_new_fraud", "n_fraud"]))
def q_pattern_new_account(spark, sf):
    return finish(P.new_account_pattern(FE.add_time_since_signup(TV.tx(spark, sf))))


@query("pattern_geo_mismatch", final_sql(COUNTRY_CTE + """
SELECT event_id, CASE WHEN row_number() OVER (PARTITION BY user_id, country ORDER BY purchase_time, event_id) = 1
  AND row_number() OVER (PARTITION BY user_id ORDER BY purchase_time, event_id) > 1 THEN 1 ELSE 0 END AS geo_mismatch
FROM txc""", ints=["geo_mismatch"]))
def q_pattern_geo_mismatch(spark, sf):
    from kestrel.plans.catalog_geo import tx_with_country
    return finish(P.geo_mismatch(tx_with_country(spark, sf)).select("event_id", "geo_mismatch"))


@query("pattern_device_change", final_sql(V.with_(*V.tx_ctes(), ("l", """
SELECT *, lag(device_id) OVER (PARTITION BY user_id ORDER BY purchase_time, event_id) AS pd,
  lag(purchase_time) OVER (PARTITION BY user_id ORDER BY purchase_time, event_id) AS pt FROM tx"""), ("c", """
SELECT *, CASE WHEN pd IS NOT NULL AND pd <> device_id AND epoch_us(purchase_time) - epoch_us(pt) <= 86400000000
  THEN 1 ELSE 0 END AS chg FROM l""")) + """
SELECT event_id, sum(chg) OVER (PARTITION BY user_id ORDER BY purchase_time
  RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS device_changes_24h FROM c""",
                                          ints=["device_changes_24h"]))
def q_pattern_device_change(spark, sf):
    return finish(P.device_changes(TV.tx(spark, sf)).select("event_id", "device_changes_24h"))


# The test tables hold at most 2-3 purchases per user-hour, so the velocity
# limit is a parameter set to 1 here to exercise the flag (rule default: 5).
VELOCITY_TEST_LIMIT = 1


@query("pattern_velocity", final_sql(V.with_(*V.tx_ctes()) + f"""
SELECT event_id, txn_velocity, CASE WHEN txn_velocity > {VELOCITY_TEST_LIMIT} THEN 1 ELSE 0 END AS high_velocity
FROM (SELECT event_id, {VELOCITY_SQL} AS txn_velocity FROM tx)""", ints=["txn_velocity", "high_velocity"]))
def q_pattern_velocity(spark, sf):
    out = P.velocity(TV.tx(spark, sf), limit=VELOCITY_TEST_LIMIT)
    return finish(out.select("event_id", "txn_velocity", "high_velocity"))


@query("pattern_micro_test", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, m AS min_prev_amount_24h,
  CASE WHEN m <= 5.0 AND purchase_value >= 10.0 * m THEN 1 ELSE 0 END AS micro_test
FROM (SELECT event_id, purchase_value, min(purchase_value) OVER (PARTITION BY user_id ORDER BY purchase_time
  RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS m FROM tx)""",
                                       doubles=["min_prev_amount_24h"], ints=["micro_test"]))
def q_pattern_micro_test(spark, sf):
    return finish(P.micro_test(TV.tx(spark, sf)).select("event_id", "min_prev_amount_24h", "micro_test"))


@query("pattern_off_hours", final_sql(V.with_(*V.tx_ctes()) + """
SELECT *, CAST(n_off_hours_fraud AS DOUBLE) / NULLIF(n_off_hours, 0) AS fraud_rate_off_hours,
  CAST(n_off_hours_fraud AS DOUBLE) / NULLIF(n_fraud, 0) AS share_of_fraud_off_hours
FROM (SELECT count(*) FILTER (WHERE hour(purchase_time) >= 1 AND hour(purchase_time) < 5) AS n_off_hours,
  count(*) FILTER (WHERE hour(purchase_time) >= 1 AND hour(purchase_time) < 5 AND class = 1) AS n_off_hours_fraud,
  count(*) FILTER (WHERE class = 1) AS n_fraud FROM tx)""",
                                      doubles=["fraud_rate_off_hours", "share_of_fraud_off_hours"],
                                      ints=["n_off_hours", "n_off_hours_fraud", "n_fraud"]))
def q_pattern_off_hours(spark, sf):
    return finish(P.off_hours(TV.tx(spark, sf)))


_VCOLS = ("V1", "V2", "V4")


@query("pattern_v_anomaly", final_sql(V.with_(("bank_tx", V.BANK), ("st", "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _VCOLS) + " FROM bank_tx"), ("f", "SELECT l_orderkey, "
    "l_linenumber, l_partkey, l_suppkey, " + ", ".join(
        f"CASE WHEN abs(({c} - m_{c}) / s_{c}) > 3 THEN 1 ELSE 0 END AS {c}_anomaly" for c in _VCOLS)
    + " FROM bank_tx, st")) + f"SELECT *, greatest({', '.join(f'{c}_anomaly' for c in _VCOLS)}) AS any_v_anomaly FROM f",
    ints=["l_linenumber", "any_v_anomaly"] + [f"{c}_anomaly" for c in _VCOLS]))
def q_pattern_v_anomaly(spark, sf):
    out = P.v_anomaly(TV.bank_tx(spark, sf), cols=_VCOLS)
    return finish(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             *[f"{c}_anomaly" for c in _VCOLS], "any_v_anomaly"))
