"""Declarative business rules (I1-I6): conditions, decisions, flags and costs.

A rule set is plain data (the JSON layout of the decision configuration);
it is compiled once on the driver into Column expressions, so deciding is a
single projection over the scored table.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The decision configuration (thresholds, country codes, costs).
DEFAULT_RULES = {
    "decision_framework": {
        "auto_decline": {
            "conditions": [
                {"field": "fraud_probability", "operator": ">", "value": 0.9},
                {"field": "country", "operator": "in", "value": ["NG", "RU", "BY"]},
                {"field": "time_since_signup", "operator": "<", "value": 2},
            ],
            "any_match": True,
        },
        "manual_review": {
            "conditions": [
                {"field": "fraud_probability", "operator": ">", "value": 0.7},
                {"field": "purchase_value", "operator": ">", "value": 500},
                {"field": "txn_velocity", "operator": ">", "value": 5},
            ],
            "any_match": True,
        },
    },
    "cost_parameters": {"false_positive_cost": 5.00, "false_negative_cost": 250.00,
                        "review_cost": 3.50},
    "risk_parameters": {"high_risk_countries": ["NG", "RU", "BY", "KP"],
                        "new_account_threshold": 2, "high_value_threshold": 500},
}
PREVENTION_COST = 0.02
DECISION_ORDER = ("auto_decline", "manual_review")
APPROVE = "approve"

_OPS = {
    ">": lambda c, v: c > F.lit(v), "<": lambda c, v: c < F.lit(v),
    ">=": lambda c, v: c >= F.lit(v), "<=": lambda c, v: c <= F.lit(v),
    "==": lambda c, v: c == F.lit(v), "!=": lambda c, v: c != F.lit(v),
    "in": lambda c, v: c.isin(list(v)),
}


class RuleError(ValueError):
    pass


def load_rules(path: str | None = None, spark: SparkSession | None = None) -> dict:
    """Read a rule file (JSON); default: the built-in set. The file is read by
    Spark, so it may lie in any store the session reads."""
    if path is None:
        return DEFAULT_RULES
    spark = spark or SparkSession.getActiveSession()
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def condition(cond: dict, columns=None) -> Column:
    """``{field, operator, value}`` -> boolean Column; NULL counts as false."""
    field, op = cond.get("field"), cond.get("operator")
    if op not in _OPS:
        raise RuleError(f"unknown operator {op!r}")
    if columns is not None and field not in columns:
        raise RuleError(f"unknown field {field!r}")
    return F.coalesce(_OPS[op](F.col(field), cond.get("value")), F.lit(False))


def rule_name(cond: dict) -> str:
    v = cond["value"]
    v = "|".join(map(str, v)) if isinstance(v, (list, tuple)) else v
    return f"{cond['field']}{cond['operator']}{v}"


def group(conds: list, any_match: bool = True, columns=None) -> Column:
    """Any / all of a list of conditions."""
    cols = [condition(c, columns) for c in conds]
    if not cols:
        return F.lit(False)
    return reduce((lambda a, b: a | b) if any_match else (lambda a, b: a & b), cols)


def decide(df: DataFrame, rules: dict | None = None, out_col: str = "decision",
           fired_col: str = "fired_rules") -> DataFrame:
    """auto_decline, else manual_review, else approve; plus the names of
    the conditions that fired ('<group>:<field><op><value>', comma-separated)."""
    rules = rules or DEFAULT_RULES
    fw = rules["decision_framework"]
    cols = set(df.columns)
    decision = None
    fired = []
    for name in DECISION_ORDER:
        if name not in fw:
            continue
        g = fw[name]
        hit = group(g["conditions"], g.get("any_match", True), cols)
        decision = (F.when(hit, F.lit(name)) if decision is None
                    else decision.when(hit, F.lit(name)))
        fired += [F.when(condition(c, cols), F.lit(f"{name}:{rule_name(c)}"))
                  for c in g["conditions"]]
    decision = F.lit(APPROVE) if decision is None else decision.otherwise(F.lit(APPROVE))
    return df.withColumns({out_col: decision, fired_col: F.concat_ws(",", *fired)})


def risk_flags(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """high_risk_country, new_account (< threshold hours), high_value."""
    rp = (rules or DEFAULT_RULES)["risk_parameters"]
    return df.withColumns({
        "high_risk_country": F.coalesce(F.col("country").isin(rp["high_risk_countries"]),
                                        F.lit(False)).cast("int"),
        "new_account": F.coalesce(F.col("time_since_signup") < F.lit(rp["new_account_threshold"]),
                                  F.lit(False)).cast("int"),
        "high_value": F.coalesce(F.col("purchase_value") > F.lit(rp["high_value_threshold"]),
                                 F.lit(False)).cast("int"),
    })


def decision_cost(df: DataFrame, label_col: str = "class", decision_col: str = "decision",
                  rules: dict | None = None) -> DataFrame:
    """I4: declined legitimate rows cost the false-positive price, approved
    fraud the false-negative price, every review the review price."""
    cp = (rules or DEFAULT_RULES)["cost_parameters"]
    d, y = F.col(decision_col), F.col(label_col) == 1
    fp = F.count_if((d == "auto_decline") & ~y)
    fn = F.count_if((d == APPROVE) & y)
    rv = F.count_if(d == "manual_review")
    out = df.agg(fp.alias("n_false_positive"), fn.alias("n_false_negative"), rv.alias("n_review"))
    return out.withColumns({
        "cost_false_positive": F.col("n_false_positive") * F.lit(cp["false_positive_cost"]),
        "cost_false_negative": F.col("n_false_negative") * F.lit(cp["false_negative_cost"]),
        "cost_review": F.col("n_review") * F.lit(cp["review_cost"]),
    }).withColumn("total_cost", F.col("cost_false_positive") + F.col("cost_false_negative")
                  + F.col("cost_review"))


def net_saving(df: DataFrame, label_col: str = "class", decision_col: str = "decision",
               rules: dict | None = None, prevention_cost: float = PREVENTION_COST) -> DataFrame:
    """Fraud stopped (declined or reviewed) times the false-negative price,
    minus declined legitimate rows times the false-positive price, minus the
    per-transaction prevention cost."""
    cp = (rules or DEFAULT_RULES)["cost_parameters"]
    d, y = F.col(decision_col), F.col(label_col) == 1
    agg = df.agg(F.count_if((d != APPROVE) & y).alias("n_fraud_stopped"),
                 F.count_if((d == "auto_decline") & ~y).alias("n_false_positive"),
                 F.count("*").alias("n_transactions"))
    saved = F.col("n_fraud_stopped") * F.lit(cp["false_negative_cost"])
    fp = F.col("n_false_positive") * F.lit(cp["false_positive_cost"])
    prev = F.col("n_transactions") * F.lit(prevention_cost)
    return agg.withColumns({"loss_avoided": saved, "false_positive_cost": fp,
                            "prevention_cost": prev, "net_saving": saved - fp - prev})
