"""Streaming queries (J1-J3, J5): the stream runs to completion over the rows of
the test tables (written as JSON files into the shared scratch folder) and
the query returns what the sink received."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import geo
from kestrel.operators.cleaning import SKEW_LIMIT
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.finish import final_sql, finish
from kestrel.session import scratch_path
from kestrel.sources import testviews as TV
from kestrel.streaming import scoring as SS

# Fixed weights of the stand-in model used by the scoring stream.
COEF = {"purchase_value": 0.01, "age": -0.02, "time_since_signup_hours": -0.001}


def _as_json_files(df, path, n=4):
    SS.write_in_time_order(df, path, n)


def _scoring_sql():
    from kestrel.plans.catalog_features import features_sql
    from kestrel.plans.catalog_rules import _decision_sql
    p = " + ".join(f"{w} * COALESCE({c}, 0.0)" for c, w in COEF.items())
    base = [*V.tx_ctes("tx0"), ("fl", f"""SELECT CASE WHEN abs(skewness(age)) > {SKEW_LIMIT} THEN median(age) ELSE avg(age) END AS age_f,
  make_timestamp(CAST(floor(quantile_cont(epoch_us(signup_time), 0.5)) AS BIGINT)) AS su_f FROM tx0"""), ("tx", """
SELECT tx0.* REPLACE (COALESCE(age, age_f) AS age, COALESCE(signup_time, su_f) AS signup_time,
  COALESCE(browser, 'Unknown') AS browser) FROM tx0, fl""")]
    body = features_sql(base).rstrip() + ",\n" + ",\n".join(f"{n} AS ({b})" for n, b in [
        ("cc", V.CODES),
        ("sc", f"""SELECT feat.* EXCLUDE (country), cc.code AS country,
  1.0 / (1.0 + exp(-(-1.0 + {p}))) AS fraud_probability,
  time_since_signup_hours AS time_since_signup, CAST(NULL AS BIGINT) AS txn_velocity
FROM feat LEFT JOIN cc ON feat.country = cc.country""")])
    return final_sql(body + f"""
SELECT event_id, user_id, class, country, fraud_probability, CAST(fraud_probability >= 0.6 AS BIGINT) AS is_fraud,
  0.6 AS threshold, {_decision_sql()} FROM sc""",
                     doubles=["fraud_probability", "threshold"], ints=["class"])


@query("stream_scoring_ecommerce", _scoring_sql())
def q_stream_scoring_ecommerce(spark, sf):
    tx = TV.tx(spark, sf)
    ranges = geo.clean_ranges(TV.ip_ranges(spark, sf))
    base = scratch_path(spark, "stream-scoring")
    _as_json_files(tx, f"{base}/in")
    st = SS.fit_ecommerce_state(tx, ranges)
    q = SS.start_ecommerce_scoring(spark, f"{base}/in", f"{base}/out", f"{base}/rej", st, ranges,
                                   SS.linear_scorer(COEF, -1.0, {c: 0.0 for c in COEF}),
                                   TV.country_codes(spark, sf), checkpoint=f"{base}/ck")
    q.awaitTermination()
    return finish(spark.read.parquet(f"{base}/out").drop("batch_id"))


_VELOCITY_SQL = V.with_(*V.tx_ctes(), ("w", """
SELECT user_id, time_bucket(INTERVAL 5 MINUTE, purchase_time) - r.range * INTERVAL 5 MINUTE AS ws
FROM tx, range(0, 12) r""")) + """
SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS n FROM w
WHERE ws + INTERVAL 1 HOUR <= (SELECT max(purchase_time) FROM tx) - INTERVAL 10 MINUTE
GROUP BY ws, user_id HAVING count(*) > 1"""


@query("stream_scoring_payload", V.with_(*V.tx_ctes(), ("tx_raw", V.TX_RAW), ("m", """
SELECT median(CAST(age AS DOUBLE)) AS med, avg(CAST(age AS DOUBLE)) AS mn, skewness(CAST(age AS DOUBLE)) AS sk FROM tx""")) + f"""
SELECT r.event_id, CAST(1.0 / (1.0 + exp(-(-1.0 + 0.05 * COALESCE(CAST(r.age AS DOUBLE),
  CASE WHEN abs(m.sk) > {SKEW_LIMIT} THEN m.med ELSE m.mn END)))) * 1e6 AS BIGINT) AS probability_ppm FROM tx_raw r, m""")
def q_stream_scoring_payload(spark, sf):
    """J1 on the documented record: every row is scored, with stored fills for what
    is missing or does not parse."""
    ranges = geo.clean_ranges(TV.ip_ranges(spark, sf))
    base = scratch_path(spark, "stream-payload")
    raw = TV.tx_raw(spark, sf)   # datetimes, numbers and addresses as text
    raw.withColumn("age", F.col("age").cast("double")).withColumn("purchase_value", F.col("purchase_value").try_cast("double")) \
        .write.json(f"{base}/in")
    st = SS.fit_ecommerce_state(TV.tx(spark, sf), ranges)
    q = SS.start_ecommerce_scoring(spark, f"{base}/in", f"{base}/out", f"{base}/rej", st, ranges,
                                   SS.linear_scorer({"age": 0.05}, -1.0), TV.country_codes(spark, sf),
                                   checkpoint=f"{base}/ck", max_files_per_trigger=100)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", F.expr("cast(round(fraud_probability * 1e6) as bigint)").alias("probability_ppm"))


@query("stream_scoring_bank", final_sql(V.with_(("bank_tx", V.BANK), ("s", """
SELECT avg("Amount") AS ma, stddev_pop("Amount") AS sa, avg("V1") AS mv, stddev_pop("V1") AS sv FROM bank_tx"""), ("p", """
SELECT b.*, 1.0 / (1.0 + exp(-(-1.0 + 0.8 * ("Amount" - ma) / sa + 0.5 * ("V1" - mv) / sv))) AS fraud_probability FROM bank_tx b, s""")) + """
SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS transaction_id, "Class", fraud_probability,
  CAST(fraud_probability >= 0.6 AS BIGINT) AS is_fraud FROM p""", doubles=["fraud_probability"], ints=["Class"]))
def q_stream_scoring_bank(spark, sf):
    from kestrel.operators import prep as PR
    b = TV.bank_tx(spark, sf)
    base = scratch_path(spark, "stream-bank")
    names = ["Time", "V1", "V2", "V3", "V4", "Amount"]
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("transaction_id")
    b.select(key, *names, "Class").write.json(f"{base}/in")
    model = PR.fit_standard_scaler(b, names)
    q = SS.start_bank_scoring(spark, f"{base}/in", f"{base}/out", f"{base}/rej", {}, _Scaled(model),
                              SS.linear_scorer({"Amount": 0.8, "V1": 0.5}, -1.0), checkpoint=f"{base}/ck")
    q.awaitTermination()
    return finish(spark.read.parquet(f"{base}/out").select("transaction_id", "Class", "fraud_probability", "is_fraud"))


class _Scaled:
    """A fitted scaler with the interface of the stored preprocessor."""

    def __init__(self, model):
        self.model = model

    def transform(self, df, keep):
        return self.model.transform(df).select(*keep, *self.model.means)


@query("stream_rejects", """
SELECT CASE event_id % 3 WHEN 0 THEN 'not json ' || event_id WHEN 1 THEN '' ELSE '{}' END AS raw_record, count(*) AS n
FROM events WHERE event_type = 'purchase' AND event_id % 3 < 3 AND event_id % 5 = 0 GROUP BY 1""")
def q_stream_rejects(spark, sf):
    """Records that are not JSON, empty or without a known field; the others
    of the stream are scored."""
    tx = TV.tx(spark, sf)
    base = scratch_path(spark, "stream-rejects")
    eid = F.col("event_id")
    bad = (F.when(eid % 3 == 0, F.concat(F.lit("not json "), eid.cast("string")))
           .when(eid % 3 == 1, F.lit("")).otherwise(F.lit("{}")))
    lines = tx.select(F.when(eid % 5 == 0, bad).otherwise(F.to_json(F.struct("event_id", "user_id", "age"))).alias("value"))
    lines.write.text(f"{base}/in")
    st = SS.fit_ecommerce_state(tx, None)
    q = SS.start_ecommerce_scoring(spark, f"{base}/in", f"{base}/out", f"{base}/rej", st, None,
                                   SS.linear_scorer({"age": 0.05}, -1.0), checkpoint=f"{base}/ck", max_files_per_trigger=100)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/rej").groupBy("raw_record").agg(F.count("*").alias("n"))


@query("stream_velocity", final_sql(_VELOCITY_SQL, ints=["n"], ts=["window_start", "window_end"]))
def q_stream_velocity(spark, sf):
    tx = TV.tx(spark, sf)
    base = scratch_path(spark, "stream-velocity")
    _as_json_files(tx, f"{base}/in")
    q = SS.start_velocity_stream(spark, f"{base}/in", f"{base}/out", limit=1, checkpoint=f"{base}/ck")
    q.awaitTermination()
    return finish(spark.read.parquet(f"{base}/out"))


def _refresh_sql(windows=(1, 7, 30)) -> str:
    cols = ["user_id", "count(*) AS user_transaction_count", "avg(purchase_value) AS user_avg"]
    for n in windows:
        recent = f"FILTER (WHERE epoch_us(purchase_time) >= m - {n} * 86400000000)"
        cols += [f"count(*) {recent} AS user_id_count_last_{n}d", f"sum(purchase_value) {recent} AS user_id_sum_amount_last_{n}d",
                 f"avg(purchase_value) {recent} AS user_id_mean_amount_last_{n}d"]
    return V.with_(*V.tx_ctes()) + f"SELECT {', '.join(cols)} FROM tx, (SELECT max(epoch_us(purchase_time)) AS m FROM tx) WHERE user_id IS NOT NULL GROUP BY user_id"


@query("stream_entity_refresh", final_sql(_refresh_sql(), doubles=["user_avg"] + [f"user_id_{c}_amount_last_{n}d" for c in ("sum", "mean") for n in (1, 7, 30)],
                                          ints=["user_transaction_count"] + [f"user_id_count_last_{n}d" for n in (1, 7, 30)]))
def q_stream_entity_refresh(spark, sf):
    """The activity table after all rows came in as micro-batches."""
    base = scratch_path(spark, "stream-refresh")
    _as_json_files(TV.tx(spark, sf), f"{base}/in", 6)
    SS.start_entity_refresh(spark, f"{base}/in", f"{base}/data", f"{base}/versions", checkpoint=f"{base}/ck", with_user_stats=True).awaitTermination()
    return finish(SS.latest_table(spark, f"{base}/versions").withColumnRenamed("__user_avg", "user_avg"))
