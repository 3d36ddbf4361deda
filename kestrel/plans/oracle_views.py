"""DuckDB text of the fixture views, for the SQL oracles of ``queries()``.

Each function returns one common-table-expression body; ``with_`` joins them
into a ``WITH`` clause. These mirror ``kestrel.sources.testviews`` row for row.
"""

from __future__ import annotations

E = """SELECT event_id, ts, user_id, event_type, value,
  CAST(regexp_extract(props,'([0-9]+)',1) AS INT) AS k FROM events"""

SU = """SELECT user_id, min(ts) AS signup_time FROM e WHERE event_type='signup' GROUP BY user_id"""


def tx(keep_k: bool = False, null_signup: str | None = None) -> str:
    signup = "su.signup_time"
    if null_signup == "impute":
        signup = "CASE WHEN e.event_id % 29 = 0 THEN NULL ELSE su.signup_time END"
    elif null_signup == "drop":
        signup = "CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE su.signup_time END"
    extra = ", e.k" if keep_k else ""
    return f"""SELECT e.event_id, e.user_id, {signup} AS signup_time, e.ts AS purchase_time,
  e.value AS purchase_value,
  concat('D', CAST(e.k % 40 AS VARCHAR)) AS device_id,
  CASE e.k % 3 WHEN 0 THEN 'SEO' WHEN 1 THEN 'Ads' ELSE 'Direct' END AS source,
  CASE WHEN e.event_id % 19 = 0 THEN NULL WHEN e.k % 4 = 0 THEN 'Chrome'
       WHEN e.k % 4 = 1 THEN 'Firefox' WHEN e.k % 4 = 2 THEN 'Safari' ELSE 'Edge' END AS browser,
  CASE WHEN e.user_id % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
  CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE CAST(18 + e.user_id % 50 AS DOUBLE) END AS age,
  (e.event_id * 2654435761) % 4294967296 AS ip_int,
  CASE WHEN e.k >= 90 OR e.value > 150 THEN 1 ELSE 0 END AS class{extra}
  FROM e LEFT JOIN su ON e.user_id = su.user_id WHERE e.event_type='purchase'"""


DOTTED = """concat_ws('.', CAST((ip_int >> 24) & 255 AS VARCHAR), CAST((ip_int >> 16) & 255 AS VARCHAR),
  CAST((ip_int >> 8) & 255 AS VARCHAR), CAST(ip_int & 255 AS VARCHAR))"""

TX_RAW = f"""SELECT event_id, user_id,
  CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'not a date'
       WHEN event_id % 2 = 0 THEN strftime(signup_time, '%Y-%m-%d %H:%M:%S')
       ELSE strftime(signup_time, '%Y-%m-%d') END AS signup_time,
  strftime(purchase_time, '%Y-%m-%d %H:%M:%S') AS purchase_time,
  CASE WHEN event_id % 37 = 0 THEN 'n/a' ELSE CAST(purchase_value AS VARCHAR) END AS purchase_value,
  device_id, source, browser, sex, CAST(CAST(age AS BIGINT) AS VARCHAR) AS age,
  CASE WHEN event_id % 13 = 0 THEN CAST(ip_int AS VARCHAR) WHEN event_id % 13 = 1 THEN 'bad.ip.addr'
       WHEN event_id % 13 = 2 THEN NULL ELSE {DOTTED} END AS ip_address,
  class FROM tx"""


def ranges(variant: str = "nation") -> str:
    if variant == "customer":
        return """SELECT CAST(c_custkey AS BIGINT)*286331 AS lower_bound_ip_address,
  CAST(c_custkey AS BIGINT)*286331 + 200000 AS upper_bound_ip_address, c_name AS country FROM customer"""
    if variant == "open":
        return """SELECT CAST(n_nationkey AS BIGINT) % 6 * 600000000 AS lower_bound_ip_address,
  4294968000 - CAST(n_nationkey AS BIGINT) AS upper_bound_ip_address, n_name AS country FROM nation"""
    base = """SELECT CAST(n_nationkey AS BIGINT)*171798691 AS lower_bound_ip_address,
  CAST(n_nationkey AS BIGINT)*171798691 + 120000000 AS upper_bound_ip_address, n_name AS country FROM nation"""
    if variant == "overlap":
        base += "\n  UNION ALL SELECT 0, 4294967295, 'WIDE'"
    return base


RANGES_RAW = """SELECT CASE WHEN n_nationkey % 7 = 3 THEN CAST(CAST(n_nationkey AS BIGINT)*171798691 AS VARCHAR) || '.5'
            WHEN n_nationkey % 11 = 5 THEN 'abc'
            ELSE CAST(CAST(n_nationkey AS BIGINT)*171798691 AS VARCHAR) END AS lower_bound_ip_address,
  CASE WHEN n_nationkey % 13 = 4 THEN NULL
       ELSE CAST(CAST(n_nationkey AS BIGINT)*171798691 + 120000000 AS VARCHAR) END AS upper_bound_ip_address,
  n_name AS country FROM nation"""

BANK = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(epoch(l_shipdate) - epoch(TIMESTAMP '1995-01-01 00:00:00') AS DOUBLE) AS "Time",
  CAST(l_quantity AS DOUBLE) AS V1, CAST(l_discount AS DOUBLE) AS V2, CAST(l_tax AS DOUBLE) AS V3,
  CAST(l_linenumber AS DOUBLE) AS V4, CAST(l_extendedprice AS DOUBLE) AS "Amount",
  CASE WHEN l_returnflag='R' AND l_quantity>40 THEN 1 ELSE 0 END AS "Class" FROM lineitem"""

BANK_RAW = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_orderkey % 43 = 0 THEN NULL ELSE CAST("Time" AS VARCHAR) END AS "Time",
  CAST(V1 AS VARCHAR) AS V1, CAST(V2 AS VARCHAR) AS V2, CAST(V3 AS VARCHAR) AS V3, CAST(V4 AS VARCHAR) AS V4,
  CASE WHEN l_orderkey % 41 = 0 THEN 'n/a' ELSE CAST("Amount" AS VARCHAR) END AS "Amount",
  "Class" FROM bank_tx"""

VEC = """SELECT vec_id, embedding, CASE WHEN label = 0 THEN 1 ELSE 0 END AS y FROM embeddings"""

SCORED = """SELECT *, round(least(1.0, greatest(0.0, (k + purchase_value/10) / 150)), 4) AS score FROM txk"""


def with_(*parts: tuple[str, str]) -> str:
    """``WITH name AS (body), ...`` from (name, body) pairs."""
    return "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in parts) + "\n"


def tx_ctes(name: str = "tx", keep_k: bool = False, null_signup: str | None = None):
    return [("e", E), ("su", SU), (name, tx(keep_k, null_signup))]


def scored_ctes():
    return [("e", E), ("su", SU), ("txk", tx(keep_k=True)), ("scored", SCORED)]

CODES = """SELECT n_name AS country, CASE n_nationkey WHEN 0 THEN 'NG' WHEN 1 THEN 'RU' WHEN 2 THEN 'BY'
  WHEN 3 THEN 'KP' ELSE 'N' || CAST(n_nationkey AS VARCHAR) END AS code FROM nation"""

RANGES_DEDUP = """SELECT lower_bound_ip_address AS lo, upper_bound_ip_address AS up, country FROM r0
QUALIFY row_number() OVER (PARTITION BY lower_bound_ip_address
                           ORDER BY upper_bound_ip_address DESC, country DESC) = 1"""
