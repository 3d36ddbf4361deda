"""Queries for IP parsing, the range table and the IP-to-country join."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.casts import ip_to_int
from kestrel.operators import geo
from kestrel.operators.profile import fraud_rate_by_country
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

_IP_TO_INT_SQL = """
SELECT event_id, ip_address,
  CASE WHEN s IS NULL THEN NULL
       WHEN contains(s, '.') THEN
         CASE WHEN len(p) = 4
                AND TRY_CAST(p[1] AS INTEGER) BETWEEN 0 AND 255 AND TRY_CAST(p[2] AS INTEGER) BETWEEN 0 AND 255
                AND TRY_CAST(p[3] AS INTEGER) BETWEEN 0 AND 255 AND TRY_CAST(p[4] AS INTEGER) BETWEEN 0 AND 255
              THEN TRY_CAST(p[1] AS BIGINT)*16777216 + TRY_CAST(p[2] AS BIGINT)*65536
                   + TRY_CAST(p[3] AS BIGINT)*256 + TRY_CAST(p[4] AS BIGINT) END
       ELSE TRY_CAST(s AS BIGINT) END AS ip_num
FROM (SELECT event_id, ip_address, trim(ip_address) AS s, string_split(trim(ip_address), '.') AS p
      FROM tx_raw) t"""


@query("ip_to_int", V.with_(*V.tx_ctes(), ("tx_raw", V.TX_RAW)) + _IP_TO_INT_SQL)
def q_ip_to_int(spark, sf):
    raw = TV.tx_raw(spark, sf)
    return finish(raw.select("event_id", "ip_address",
                             ip_to_int(F.col("ip_address"), raw.schema["ip_address"].dataType)
                             .alias("ip_num")))


@query("ip_ranges_clean", V.with_(("raw", V.RANGES_RAW)) + """
SELECT CAST(TRY_CAST(trim(lower_bound_ip_address) AS DOUBLE) AS BIGINT) AS lower_bound_ip_address,
       CAST(TRY_CAST(trim(upper_bound_ip_address) AS DOUBLE) AS BIGINT) AS upper_bound_ip_address, country
FROM raw
WHERE TRY_CAST(trim(lower_bound_ip_address) AS DOUBLE) = floor(TRY_CAST(trim(lower_bound_ip_address) AS DOUBLE))
  AND TRY_CAST(trim(upper_bound_ip_address) AS DOUBLE) = floor(TRY_CAST(trim(upper_bound_ip_address) AS DOUBLE))""")
def q_ip_ranges_clean(spark, sf):
    return finish(geo.clean_ranges(TV.ip_ranges_raw(spark, sf)))


def _asof_sql(variant: str) -> str:
    return V.with_(*V.tx_ctes(), ("r0", V.ranges(variant)), ("r", """
SELECT lower_bound_ip_address AS lo, upper_bound_ip_address AS up, country FROM r0
QUALIFY row_number() OVER (PARTITION BY lower_bound_ip_address
                           ORDER BY upper_bound_ip_address DESC, country DESC) = 1""")) + """
SELECT tx.event_id, tx.ip_int, CASE WHEN tx.ip_int <= r.up THEN r.country ELSE 'Unknown' END AS country
FROM tx ASOF LEFT JOIN r ON tx.ip_int >= r.lo"""


def _ip_country(spark, sf, variant):
    t = TV.tx(spark, sf).select("event_id", "ip_int")
    ranges = geo.clean_ranges(TV.ip_ranges(spark, sf, variant))
    return finish(geo.map_ips_to_countries(t, ranges, ip_col="ip_int"))


@query("ip_country", _asof_sql("nation"))
def q_ip_country(spark, sf):
    return _ip_country(spark, sf, "nation")


@query("ip_country_overlap", _asof_sql("overlap"))
def q_ip_country_overlap(spark, sf):
    return _ip_country(spark, sf, "overlap")


@query("ip_country_scale", _asof_sql("customer"))
def q_ip_country_scale(spark, sf):
    return _ip_country(spark, sf, "customer")


@query("ip_country_open", _asof_sql("open"))
def q_ip_country_open(spark, sf):
    return _ip_country(spark, sf, "open")


def country_ctes(src: str = "tx", name: str = "txc"):
    """CTEs adding the nation-range country to view ``src`` as view ``name``."""
    return [("r0", V.ranges("nation")), ("r", V.RANGES_DEDUP), (name, f"""
SELECT s.*, CASE WHEN s.ip_int <= r.up THEN r.country ELSE 'Unknown' END AS country
FROM {src} s ASOF LEFT JOIN r ON s.ip_int >= r.lo""")]


COUNTRY_CTE = V.with_(*V.tx_ctes(), *country_ctes())


def tx_with_country(spark, sf):
    t = TV.tx(spark, sf)
    return geo.map_ips_to_countries(t, geo.clean_ranges(TV.ip_ranges(spark, sf)), ip_col="ip_int")


@query("fraud_rate_by_country", final_sql(COUNTRY_CTE + """
SELECT country, avg(class) AS fraud_rate, count(*) AS n_transactions FROM txc
GROUP BY country ORDER BY fraud_rate DESC, country LIMIT 20""", doubles=["fraud_rate"],
                                          ints=["n_transactions"]))
def q_fraud_rate_by_country(spark, sf):
    return finish(fraud_rate_by_country(tx_with_country(spark, sf), top=20))
