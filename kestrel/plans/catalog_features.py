"""Queries for the feature operators (E1-E9), including the flagship E8."""

from __future__ import annotations

from kestrel.operators import features as FE
from kestrel.operators import geo
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

WINDOWS = FE.DEFAULT_WINDOWS


def _tx(spark, sf, **kw):
    return TV.tx(spark, sf, **kw)


# E1 -----------------------------------------------------------------------
TIME_PARTS_SQL = """hour(purchase_time) AS purchase_hour, isodow(purchase_time) - 1 AS purchase_dayofweek,
  month(purchase_time) AS purchase_month"""


@query("time_parts", final_sql(V.with_(*V.tx_ctes()) + f"SELECT event_id, {TIME_PARTS_SQL} FROM tx",
                               ints=["purchase_hour", "purchase_dayofweek", "purchase_month"]))
def q_time_parts(spark, sf):
    out = FE.add_time_parts(_tx(spark, sf))
    return finish(out.select("event_id", "purchase_hour", "purchase_dayofweek", "purchase_month"))


# E2 -----------------------------------------------------------------------
def tss_ctes(src: str):
    return [("h0", f"""SELECT *, CASE WHEN epoch_us(purchase_time) - epoch_us(signup_time) >= 0
  THEN (epoch_us(purchase_time) - epoch_us(signup_time)) / 3600000000.0 END AS time_since_signup_hours
  FROM {src}"""),
            ("h1", """SELECT * REPLACE (COALESCE(time_since_signup_hours,
  (SELECT quantile_cont(time_since_signup_hours, 0.5) FROM h0)) AS time_since_signup_hours) FROM h0""")]


@query("time_since_signup", final_sql(V.with_(*V.tx_ctes(null_signup="impute"), *tss_ctes("tx"))
                                      + "SELECT event_id, time_since_signup_hours FROM h1",
                                      doubles=["time_since_signup_hours"]))
def q_time_since_signup(spark, sf):
    out = FE.add_time_since_signup(_tx(spark, sf, null_signup="impute"))
    return finish(out.select("event_id", "time_since_signup_hours"))


# E3-E5 ----------------------------------------------------------------------
@query("user_txn_count", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS user_transaction_count FROM tx""",
                                   ints=["user_transaction_count"]))
def q_user_txn_count(spark, sf):
    out = FE.add_user_transaction_count(_tx(spark, sf))
    return finish(out.select("event_id", "user_id", "user_transaction_count"))


@query("amount_log", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, CASE WHEN purchase_value > -1 THEN ln(1 + purchase_value) END AS transaction_amount_log
FROM tx""", doubles=["transaction_amount_log"]))
def q_amount_log(spark, sf):
    return finish(FE.add_amount_log(_tx(spark, sf)).select("event_id", "transaction_amount_log"))


def ratio_ctes(src: str):
    return [("ra0", f"""SELECT *, purchase_value / (avg(purchase_value) OVER (PARTITION BY user_id) + 1e-6)
  AS transaction_amount_per_user_avg FROM {src}"""),
            ("ra1", """SELECT * REPLACE (COALESCE(CASE WHEN transaction_amount_per_user_avg >
    (SELECT quantile_cont(transaction_amount_per_user_avg, 0.99) FROM ra0)
  THEN (SELECT quantile_cont(transaction_amount_per_user_avg, 0.99) FROM ra0)
  ELSE transaction_amount_per_user_avg END, 1.0) AS transaction_amount_per_user_avg) FROM ra0""")]


@query("amount_ratio", final_sql(V.with_(*V.tx_ctes(), *ratio_ctes("tx"))
                                 + "SELECT event_id, transaction_amount_per_user_avg FROM ra1",
                                 doubles=["transaction_amount_per_user_avg"]))
def q_amount_ratio(spark, sf):
    out = FE.add_amount_ratio(_tx(spark, sf))
    return finish(out.select("event_id", "transaction_amount_per_user_avg"))


# E6 -------------------------------------------------------------------------
def window_ctes(src: str, ent: str, name: str):
    aggs = []
    for n in WINDOWS:
        cond = f"purchase_time >= (SELECT max(purchase_time) FROM {src}) - INTERVAL {n} DAY"
        aggs += [f"count(*) FILTER (WHERE {cond}) AS {ent}_count_last_{n}d",
                 f"sum(purchase_value) FILTER (WHERE {cond}) AS {ent}_sum_amount_last_{n}d",
                 f"avg(purchase_value) FILTER (WHERE {cond}) AS {ent}_mean_amount_last_{n}d"]
    names = FE.window_feature_names(ent, WINDOWS)
    cols = ", ".join(f"COALESCE(a.{c}, 0) AS {c}" for c in names)
    return [(f"{name}_a", f"SELECT {ent}, {', '.join(aggs)} FROM {src} WHERE {ent} IS NOT NULL GROUP BY {ent}"),
            (name, f"SELECT {src}.*, {cols} FROM {src} LEFT JOIN {name}_a AS a USING ({ent})")]


def _window_query(ent):
    names = FE.window_feature_names(ent, WINDOWS)
    sql = V.with_(*V.tx_ctes(), *window_ctes("tx", ent, "w")) + f"SELECT event_id, {', '.join(names)} FROM w"
    return final_sql(sql, doubles=[n for n in names if "_count_" not in n],
                     ints=[n for n in names if "_count_" in n])


def _window_spark(spark, sf, ent):
    out = FE.add_time_window_features(_tx(spark, sf), "purchase_time", ent, "purchase_value", WINDOWS)
    return finish(out.select("event_id", *FE.window_feature_names(ent, WINDOWS)))


@query("window_user", _window_query("user_id"))
def q_window_user(spark, sf):
    return _window_spark(spark, sf, "user_id")


@query("window_device", _window_query("device_id"))
def q_window_device(spark, sf):
    return _window_spark(spark, sf, "device_id")


@query("window_ip", _window_query("ip_int"))
def q_window_ip(spark, sf):
    return _window_spark(spark, sf, "ip_int")


# E7 -------------------------------------------------------------------------
_TRAIL = ["user_id_trailing_7d_count", "user_id_trailing_7d_sum", "user_id_trailing_7d_mean"]


@query("trailing_user", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, count(*) OVER w AS user_id_trailing_7d_count,
  COALESCE(sum(purchase_value) OVER w, 0) AS user_id_trailing_7d_sum,
  COALESCE(avg(purchase_value) OVER w, 0) AS user_id_trailing_7d_mean
FROM tx WINDOW w AS (PARTITION BY user_id ORDER BY purchase_time
                     RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""",
                                  doubles=_TRAIL[1:], ints=_TRAIL[:1]))
def q_trailing_user(spark, sf):
    out = FE.add_trailing_activity(_tx(spark, sf), days=7)
    return finish(out.select("event_id", *_TRAIL))


# E9 -------------------------------------------------------------------------
@query("amount_per_time", final_sql(V.with_(("bank_tx", V.BANK)) + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "Amount" / NULLIF("Time", 0) AS "Amount_per_Time"
FROM bank_tx""", doubles=["Amount_per_Time"], ints=["l_linenumber"]))
def q_amount_per_time(spark, sf):
    out = FE.add_amount_per_time(TV.bank_tx(spark, sf))
    return finish(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "Amount_per_Time"))


# E8 (flagship) ----------------------------------------------------------------
ENTITIES = ("user_id", "device_id", "ip_int")


def features_ctes():
    """CTE chain of the whole e-commerce feature table, ending in view ``feat``."""
    parts = [("tp", f"SELECT *, {TIME_PARTS_SQL} FROM txc")]
    parts += tss_ctes("tp")
    parts += [("uc", """SELECT *, count(*) OVER (PARTITION BY user_id) AS user_transaction_count,
  CASE WHEN purchase_value > -1 THEN ln(1 + purchase_value) END AS transaction_amount_log FROM h1""")]
    parts += ratio_ctes("uc")
    src = "ra1"
    for i, ent in enumerate(ENTITIES):
        parts += window_ctes(src, ent, f"w{i}")
        src = f"w{i}"
    parts += [("feat", f"SELECT * FROM {src}")]
    return parts


FEATURE_DOUBLES = (["purchase_value", "age", "time_since_signup_hours", "transaction_amount_log",
                    "transaction_amount_per_user_avg"]
                   + [n for e in ENTITIES for n in FE.window_feature_names(e, WINDOWS)
                      if "_count_" not in n])
FEATURE_INTS = (["class", "purchase_hour", "purchase_dayofweek", "purchase_month",
                 "user_transaction_count"]
                + [n for e in ENTITIES for n in FE.window_feature_names(e, WINDOWS) if "_count_" in n])
FEATURE_TS = ("signup_time", "purchase_time")


def features_sql(base_ctes=None, src: str = "tx"):
    """WITH clause ending in view ``feat``: ``base_ctes`` (default: the tx
    fixture) -> country -> the feature chain."""
    from kestrel.plans.catalog_geo import country_ctes
    base = base_ctes if base_ctes is not None else V.tx_ctes()
    return V.with_(*base, *country_ctes(src), *features_ctes())


def ecommerce_features(spark, sf):
    t = _tx(spark, sf)
    ranges = geo.clean_ranges(TV.ip_ranges(spark, sf))
    return FE.engineer_ecommerce_features(t, ranges, ip_col="ip_int")


@query("features_ecommerce", final_sql(features_sql() + "SELECT * FROM feat",
                                       doubles=FEATURE_DOUBLES, ints=FEATURE_INTS, ts=FEATURE_TS))
def q_features_ecommerce(spark, sf):
    return finish(ecommerce_features(spark, sf))

