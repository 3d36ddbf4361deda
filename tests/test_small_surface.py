"""Small surfaces: type report, ordered head, rule file and rule errors."""

import json

import pytest
from pyspark.sql import functions as F

from kestrel.operators import cleaning as CL
from kestrel.operators import profile as PF
from kestrel.operators import rules as R


def test_type_report_counts_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "a", "b")], "a bigint, b double, c string, d string")
    got = {r.dtype: r.n_columns for r in CL.type_report(df).collect()}
    assert got == {"bigint": 1, "double": 1, "string": 2}


def test_head_is_ordered(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "k int")
    assert [r.k for r in PF.head(df, 2).collect()] == [1, 2]


def test_rules_from_file_and_errors(spark, tmp_dir):
    path = f"{tmp_dir}/rules.json"
    with open(path, "w") as fh:
        json.dump(R.DEFAULT_RULES, fh)
    rules = R.load_rules(path)
    df = spark.createDataFrame([(0.95, "NG", 10.0, 100.0, 1), (0.1, "US", 10.0, 600.0, 1),
                                (0.1, "US", 10.0, 10.0, None)],
                               "fraud_probability double, country string, time_since_signup double, "
                               "purchase_value double, txn_velocity int")
    got = [r.decision for r in R.decide(df, rules).orderBy(F.desc("fraud_probability"),
                                                           F.desc("purchase_value")).collect()]
    assert got == ["auto_decline", "manual_review", "approve"]
    with pytest.raises(R.RuleError):
        R.condition({"field": "fraud_probability", "operator": "~", "value": 1}, df.columns)
    with pytest.raises(R.RuleError):
        R.condition({"field": "nope", "operator": ">", "value": 1}, df.columns)
